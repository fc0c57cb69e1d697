"""Personal data by bootstrapped contextual extraction.

1. Seeds: e-mail addresses, IP addresses, payment cards and phone numbers in strict
   forms, found in every whole text. Tokens that look like identifiers but match no strict
   form (a number without its country code, an address without a domain's dot or with
   ``[at]``, an IPv6 address, digits that fail the check sum) are candidates.
2. Both induce lexical patterns from the words and marks around them in their line: the
   word and cue (``:``, ``=``, ``#`` ...) before, three words or marks before, two
   before and one after.
3. Spark scores the graph of patterns and instances in rounds. A pattern's confidence in a kind is
   the scores of its distinct instances over their number plus ``DOUBT``, so a
   pattern needs many different instances and hardly any of other kinds; an
   instance that is no seed scores by noisy-or over the confident patterns it stands in, if its
   form suits the kind. Newly scored instances vouch for further patterns in the next round.
4. Candidates that stand in a confident pattern become spans of its kind. They never
   overlap seeds.

Defined cases: null and empty texts have no spans; repeated rows are rows of their own;
equal confidence goes to the kind listed first; an empty table gives no rows; a null
id is kept. Columns to keep travel as one struct, so their names don't matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from .common import map_batches, reliable, text_or_empty

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
ROUNDS = 3
CONFIDENT = 0.8
SUPPORT = 5
DOUBT = 2
#: Code points of the line looked at on either side; a word cut by this border counts for nothing.
AROUND = 96

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_ANY = re.compile(r"[0-9@]|[\[(] ?at ?[\])]")

_CHAIN = re.compile(r"[0-9](?:[ ()./-]{0,3}[0-9])+")
_AT = re.compile(r"@[^\W_](?:[\w-]*[^\W_])?(?:\.[^\W_](?:[\w-]*[^\W_])?)*")
_SPELLED = re.compile(r"(?<![\w.+-])[\w.+-]{1,64} ?[\[(] ?at ?[\])] ?[\w-]{1,64}(?: ?(?:\.|[\[(] ?dot ?[\])]) ?[\w-]{1,64}){0,8}")
_SIXES = re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){2,7}(?::?[0-9A-Fa-f]{1,4})(?![0-9A-Fa-f:])")
_TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]")
_CUES = frozenset(":=#<([{\"'/|")


def _luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2]) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def strict_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all strict forms, in order; each kind leftmost and without overlaps of its own."""
    out = []
    end = 0
    for m in _DOMAIN.finditer(text):
        low = m.start()
        while low > end and text[low - 1] in _LOCAL:
            low -= 1
        if low < m.start():
            end = m.end()
            out.append((low, EMAIL, end))
    for m in _IP.finditer(text):
        if all(len(p) < 4 and int(p) < 256 for p in (x.lstrip("0") or "0" for x in m[0].split("."))):
            out.append((m.start(), IP, m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and _luhn(digits):
            out.append((m.start(), CARD, m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((m.start(), PHONE, m.end()))
    return sorted(out)


def _loose(text: str) -> Iterator[tuple[int, int, int]]:
    """(start, end, kinds it could be, as bits) of tokens that look like identifiers."""
    low = 0
    for m in _AT.finditer(text):
        start = m.start()
        while start > low and (text[start - 1] in "._%+-" or text[start - 1].isalnum()):
            start -= 1
        if start < m.start():
            yield start, m.end(), 1 << EMAIL
        low = m.end()
    if "at" in text:
        for m in _SPELLED.finditer(text):
            yield m.start(), m.end(), 1 << EMAIL
    if ":" in text:
        for m in _SIXES.finditer(text):
            yield m.start(), m.end(), 1 << IP
    for m in _CHAIN.finditer(text):
        parts = [(m.start(), m[0])]
        if sum(c.isdigit() for c in m[0]) > 19:  # several numbers in a row
            parts = [(m.start() + p.start(), p[0]) for p in re.finditer(r"[^ ]+", m[0])]
        for at, part in parts:
            n = sum(c.isdigit() for c in part)
            kinds = (7 <= n <= 15) << PHONE | (12 <= n <= 19) << CARD | (re.fullmatch(r"[0-9]+(?:\.[0-9]+){3}", part) is not None) << IP
            if kinds:
                left = at - 1 if at and text[at - 1] in "+(" else at
                yield left, at + len(part), kinds


def loose_spans(text: str, strict: Sequence[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Candidates that overlap neither a strict form nor an earlier candidate."""
    out: list[tuple[int, int, int]] = []
    taken = [(a, b) for a, _, b in strict]
    at, reach, end = 0, 0, 0
    for a, b, kinds in sorted(_loose(text), key=lambda x: (x[0], -x[1])):
        while at < len(taken) and taken[at][0] < b:
            reach = max(reach, taken[at][1])
            at += 1
        if a >= end and a >= reach:
            out.append((a, b, kinds))
            end = b
    return out


def _tokens(text: str) -> list[str]:
    return ["0" if t.isdigit() else t.lower() for t in _TOKEN.findall(text)]


def patterns(text: str, start: int, end: int) -> list[int]:
    """Hashes of the lexical patterns around a span."""
    low = max(0, start - AROUND)
    left = text[low:start].rpartition("\n")[2]
    if low and len(left) == start - low:
        left = left.partition(" ")[2]
    right = text[end:end + AROUND].partition("\n")[0]
    before, after = _tokens(left)[-3:], _tokens(right)[:1]
    words = sum(t.isalpha() for t in before)
    out = []
    if len(before) > 1 and before[-1] in _CUES and before[-2].isalpha():
        out.append(("cue", *before[-2:]))
    if len(before) == 3 and words > 1:
        out.append(("before", *before))
    if len(before) > 1 and after and sum(t.isalpha() for t in (*before[-2:], *after)) > 1:
        out.append(("around", *before[-2:], *after))
    return [xxhash.xxh64_intdigest("\0".join(p)) - (1 << 63) for p in out]


def _instance(text: str, start: int, end: int) -> int:
    """The same for all ways to write an identifier."""
    return xxhash.xxh64_intdigest(re.sub(r"[\s()-]", "", text[start:end].lower())) - (1 << 63)


_SPANS = "array<struct<start: int, kind: int, end: int>>"
_MARKS = "array<struct<start: int, end: int, kinds: int, seed: boolean, instance: bigint, patterns: array<bigint>>>"


def _scan(docs: DataFrame, keep: Sequence[str], text_col: str) -> DataFrame:
    """(row, strict, marks) of every text: strict spans, and all seeds and candidates with their patterns."""
    arrow = {"strict": pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])),
             "marks": pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kinds", pa.int32()), ("seed", pa.bool_()),
                                          ("instance", pa.int64()), ("patterns", pa.list_(pa.int64()))]))}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            strict, marks = [], []
            for text in batch.column(1).to_pylist():
                spans = strict_spans(text) if _ANY.search(text) else []
                strict.append([dict(start=a, kind=k, end=b) for a, k, b in spans])
                loose = loose_spans(text, spans) if spans or _ANY.search(text) else []
                marks.append([dict(start=a, end=b, kinds=kinds, seed=seed, instance=_instance(text, a, b), patterns=patterns(text, a, b))
                              for seed, found in ((True, ((a, b, 1 << k) for a, k, b in spans)), (False, loose)) for a, b, kinds in found])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(strict, arrow["strict"]), pa.array(marks, arrow["marks"])],
                                             ["row", "strict", "marks"])

    rows = docs.select(F.struct(*[F.col(c) for c in keep]).alias("row"), text_or_empty(F.col(text_col)).alias("text"))
    schema = StructType([rows.schema["row"], StructField("strict", _parse_datatype_string(_SPANS)),
                         StructField("marks", _parse_datatype_string(_MARKS))])
    return map_batches(rows, run, schema)


def _kinds(mask: Column) -> Column:
    """The kinds of a mask, one a row."""
    return F.explode(F.filter(F.array(*[F.lit(k) for k in range(len(KINDS))]), lambda k: F.getbit(mask, k) == 1))


def confident_patterns(edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(pattern, kind, confidence) from ``edges`` (pattern, instance, seeds, kinds), one a pair; masks of kinds.

    Scores go between instances and patterns in rounds of joins and aggregates; nothing comes to the driver but the
    number of patterns, to stop when no further one is found.
    """
    sizes = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("instances"))
    seeds = edges.where("seeds > 0").select("pattern", _kinds(F.col("seeds")).alias("kind"), F.lit(1.0).alias("score"))
    scored, known, found = seeds, -1, None
    for turn in range(rounds):
        found = reliable(scored.groupBy("pattern", "kind").agg(F.sum("score").alias("support"))
                         .where(F.col("support") >= SUPPORT).join(sizes, "pattern")
                         .withColumn("confidence", F.col("support") / (F.col("instances") + DOUBT))
                         .where(F.col("confidence") >= CONFIDENT).select("pattern", "kind", "confidence"))
        n = found.count()
        if n == known or turn == rounds - 1:
            break
        known = n
        new = (edges.where("seeds = 0").join(found, "pattern").where("getbit(kinds, kind) = 1").groupBy("instance", "kind")
               .agg((1 - F.exp(F.sum(F.log1p(-F.col("confidence"))))).alias("score")).where(F.col("score") >= CONFIDENT))
        scored = seeds.unionByName(edges.where("seeds = 0").join(new, "instance").select("pattern", "kind", "score"))
    return found


def extract(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """One row per document: ``row`` (the columns kept), ``strict`` and ``found``: arrays of (start, kind, end), in order.

    Kinds are numbers by their place in ``KINDS``; places are code points, the end exclusive.
    """
    scanned = reliable(_scan(docs, keep, text_col)).withColumn("uid", F.monotonically_increasing_id())
    marks = scanned.select("uid", F.explode("marks").alias("m")).select("uid", "m.*")
    edges = reliable(marks.select("instance", "kinds", "seed", F.explode("patterns").alias("pattern")).groupBy("pattern", "instance")
                     .agg(F.bit_or(F.when(F.col("seed"), F.col("kinds")).otherwise(0)).alias("seeds"), F.bit_or("kinds").alias("kinds")))
    trusted = confident_patterns(edges, rounds)
    found = (marks.where("not seed").select("uid", "start", "end", "kinds", F.explode("patterns").alias("pattern")).join(trusted, "pattern")
             .where("getbit(kinds, kind) = 1").groupBy("uid", "start", "end")
             .agg(F.max(F.struct("confidence", (-F.col("kind")).alias("kind"))).alias("best"))
             .groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("start", (-F.col("best.kind")).alias("kind"), "end"))).alias("found")))
    empty = F.array().cast(_SPANS)
    return (scanned.select("uid", "row", "strict").join(found, "uid", "left")
            .select("row", "strict", F.coalesce(F.col("found"), empty).alias("found")))


def spelled(spans: Column) -> Column:
    """``kind:start:end`` of spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by ``[KIND]``, its columns unchanged; overlapping spans become one, named by the first."""
    cols = docs.columns
    out = extract(docs, cols, text_col)
    spans = F.sort_array(F.concat("strict", "found"))
    text = F.col("row").getField(text_col)
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    # (text so far, where it goes on)
    start = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))
    folded = F.aggregate(spans, start, lambda acc, s: F.when(s["start"] < acc["at"], F.struct(
        acc["done"].alias("done"), F.greatest(acc["at"], s["end"]).alias("at"))).otherwise(F.struct(
            F.concat(acc["done"], F.substr(text, acc["at"] + 1, s["start"] - acc["at"]), F.get(names, s["kind"])).alias("done"),
            s["end"].alias("at"))))
    clean = F.when(F.size(spans) == 0, text).otherwise(F.concat(folded["done"], F.substr(text, folded["at"] + 1)))
    return out.select(*[(clean if c == text_col else F.col("row").getField(c)).alias(c) for c in cols])
