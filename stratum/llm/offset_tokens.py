"""Token counts by field or section, from one encoding of the whole document.

A document is encoded once. Every token's span, known exactly from the byte
lengths of a lossless vocabulary, is joined to the sections' intervals by binary
search. A token that crosses a boundary is allocated by ``rule``:

* ``first``: to the section of its first byte,
* ``last``: to the section of its last byte,
* ``majority``: to the section that holds most of its bytes, ties to the earlier,
* ``split``: to each section in proportion to its bytes (counts are then fractions).

Bytes outside every section count as section -1, so a document's counts always
add up to its tokens. Sections must not overlap.

Defined cases: a null or empty text has one empty section with 0 tokens (none, if
sections are given); empty sections have 0 tokens; null fields are empty; repeated
rows give repeated counts; an empty table gives no rows; null section bounds or
bounds outside the text are clipped to it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches
from .tokens import byte_tokenizer

RULES = ("first", "last", "majority", "split")


def allocate(ends: np.ndarray, start: np.ndarray, stop: np.ndarray, rule: str) -> tuple[np.ndarray, float]:
    """Tokens of each section (sorted, disjoint byte intervals), and those outside; ``ends``: where each token ends."""
    begins = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    n = len(start)
    # the line cut at every bound: pieces 0 .. 2n, odd ones are sections
    cuts = np.stack([start, stop], axis=1).ravel()
    out = np.zeros(2 * n + 1)
    if not len(ends):
        return np.zeros(n), 0.0
    a = np.searchsorted(cuts, begins, side="right")
    b = np.searchsorted(cuts, ends - 1, side="right")
    if rule == "last":
        np.add.at(out, b, 1.0)
    elif rule == "first":
        np.add.at(out, a, 1.0)
    else:
        whole = a == b
        out += np.bincount(a[whole], minlength=len(out))
        edge = np.concatenate([[0], cuts, [ends[-1]]])
        for t in np.flatnonzero(~whole):
            k = np.arange(a[t], b[t] + 1)
            part = np.minimum(edge[k + 1], ends[t]) - np.maximum(edge[k], begins[t])
            if rule == "split":
                out[k] += part / (ends[t] - begins[t])
            else:
                out[k[part.argmax()]] += 1.0
    return out[1::2], float(out[0::2].sum())


def _lines(text: str) -> list[tuple[int, int]]:
    """Character bounds of the lines, each with its line end."""
    out, a = [], 0
    while (b := text.find("\n", a)) >= 0:
        out.append((a, b + 1))
        a = b + 1
    if a < len(text) or not out:
        out.append((a, len(text)))
    return out


def _byte_places(text: str) -> np.ndarray | None:
    """Byte at which each character begins (and the end); None where that is the character's number."""
    if text.isascii():
        return None
    data = np.frombuffer(text.encode(), np.uint8)
    return np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))


def _count(tok, text: str, spans: list[tuple[int, int]], rule: str) -> tuple[list[float], float, int]:
    places = _byte_places(text)
    bounds = np.array(spans, dtype=np.int64).reshape(-1, 2)
    start, stop = bounds[:, 0], bounds[:, 1]
    if places is not None:
        start, stop = places[start], places[stop]
    ids, ends = tok.encode(text)
    inside, outside = allocate(ends, start, stop, rule)
    return inside.tolist(), outside, len(ids)


def attribute(docs: DataFrame, tokenizer: str, pattern: str, id_cols: list[str], text_col: str = "text",
              sections: Column | None = None, rule: str = "majority") -> DataFrame:
    """One row per document and section: ``id_cols``, section, start, end (characters), tokens, doc_tokens.

    ``sections`` is an array of structs (start, end) of each row, ordered or not; by default the lines. A row with
    section -1 stands for text outside the given sections, where that holds tokens.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    kind, by_line = "double" if rule == "split" else "long", sections is None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = byte_tokenizer(tokenizer, pattern)
        for b in batches:
            texts, given = b.column(b.num_columns - 2).to_pylist(), b.column(b.num_columns - 1).to_pylist()
            cols: list[list] = [[], [], [], [], [], []]
            for i, (text, own) in enumerate(zip(texts, given)):
                text = text or ""
                if by_line:
                    spans = _lines(text)
                else:
                    n = len(text)
                    spans = [(min(max(0, s["start"] or 0), n), min(max(0, n if s["end"] is None else s["end"]), n))
                             for s in own or [] if s is not None]
                    spans = [(a, max(a, e)) for a, e in spans]
                order = sorted(range(len(spans)), key=lambda k: spans[k])
                counts, outside, total = _count(tok, text, [spans[k] for k in order], rule)
                rows = [(k, *spans[k], c) for k, c in zip(order, counts)]
                if outside:
                    rows.append((-1, None, None, outside))
                for k, a, e, c in sorted(rows):
                    for col, v in zip(cols, (i, k, a, e, c if rule == "split" else int(c), total)):
                        col.append(v)
            rows_of = pa.array(cols[0], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(c.take(rows_of) for c in b.columns[:-2]), *(pa.array(c, pa.int64()) for c in cols[1:4]),
                 pa.array(cols[4], pa.float64() if rule == "split" else pa.int64()), pa.array(cols[5], pa.int64())],
                names=[*b.schema.names[:-2], "section", "start", "end", "tokens", "doc_tokens"])

    given = F.lit(None).cast("array<struct<start:long,end:long>>") if sections is None else sections.cast(
        "array<struct<start:long,end:long>>")
    src = docs.select(*[F.col(c) for c in id_cols], F.col(text_col).cast("string").alias("__text"), given.alias("__spans"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-2])
    return map_batches(src, run, f"{fields}, section long, start long, end long, tokens {kind}, doc_tokens long", tokenizes=True)


def attribute_fields(rows: DataFrame, tokenizer: str, pattern: str, id_cols: list[str], fields: list[str],
                     between: str = "\n", rule: str = "majority") -> DataFrame:
    """The same for the fields of a row, encoded once as one text with ``between`` after each; ``field`` names them."""
    text = F.concat(*[F.concat(F.coalesce(F.col(f).cast("string"), F.lit("")), F.lit(between)) for f in fields])
    size = [F.length(F.coalesce(F.col(f).cast("string"), F.lit(""))) + len(between) for f in fields]
    spans, at = [], F.lit(0)
    for s in size:
        spans.append(F.struct(at.cast("long").alias("start"), (at + s).cast("long").alias("end")))
        at = at + s
    src = rows.select(*[F.col(c) for c in id_cols], text.alias("__joined"), F.array(*spans).alias("__fields"))
    got = attribute(src, tokenizer, pattern, id_cols, "__joined", F.col("__fields"), rule)
    return got.withColumn("field", F.element_at(F.array(*[F.lit(f) for f in fields]), (F.col("section") + 1).cast("int")))
