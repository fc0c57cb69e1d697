"""Near duplicates: improved consistent weighted sampling over TF-IDF word shingles.

1. Document frequencies of all shingles (five words, lower case) are counted over
   all documents in a table of ``2 ** SKETCH_BITS`` counters; the median counter,
   what unrelated shingles add, is taken off. A shingle in many documents weighs
   least, all that are rare weigh nearly the same, at any size of the corpus.
2. Each text gets ``BANDS * ROWS`` consistent samples: two texts agree on one with
   a probability equal to their weighted Jaccard similarity. ``ROWS`` of them make a
   band; texts that agree on a band are candidates.
3. In each bucket of a band the member that collides most leads. Leader and
   members are verified by weighted Jaccard similarity on whole texts, and the links
   joined to classes. Members outside their bucket's largest class are then compared
   with all those of other classes: pair by pair in buckets of up to ``SMALL``; in larger ones
   in blocks, by what they share of their rarest shingles, which passes over no pair that reaches the similarity.
   So no large bucket is ever listed pair by pair or held by one task.
4. Links make components; equal texts are one node from the start.

Defined cases: equal texts, empty ones too, are one class; null counts as empty;
texts of one to four words are one shingle; a text without words has no other
duplicates; repeated rows are copies; an empty table gives no rows. A class is
named by its smallest id (null ids come last).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .common import broadcast_value, chunked, map_batches, reliable, text_or_empty
from .components import connected_components

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 10, 4
SKETCH_BITS = 20
#: A shingle weighs 1 - IDF_SHARE + IDF_SHARE * log(1 + n / df) / log(1 + n). With the full inverse document frequency, what
#: the members of a large group of near copies share would weigh next to nothing, and the group fall apart.
IDF_SHARE = 0.25
SMALL = 48
BLOCK = 2048
#: Shingles of either side of a block that are opened at once.
SHINGLES = 1 << 20
#: Characters handled at once; arrays of this size stay in a core's cache.
CHARS = 1 << 18
_BLOCKS = 64  # parts of the counter table, for its sum
_SLACK = 1e-6  # share of a weight by which bounds give way to rounding


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text in turn, how often each occurs, and where each text begins (and the end)."""
    cp, bounds = tk.code_points(texts)
    flags = tk.classes()[cp]
    start, _, word = tk.words(tk.lower_table()[cp], flags)
    first = np.searchsorted(start, bounds)
    p = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
    if len(word) >= WORDS:
        two = word[:-1] + word[1:] * p[0]
        four = two[:-2] + two[2:] * p[1]
        five = tk.mix(four[:-1] + word[4:] * p[2])
    hashes, times, at = [], [], [0]
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= WORDS:
            h, n = np.unique(five[a:b - WORDS + 1], return_counts=True)
        elif b > a:
            few = word[a:b] * (np.uint64(2) * np.arange(b - a, dtype=np.uint64) + np.uint64(1))
            h, n = tk.mix(few.sum(keepdims=True)), np.ones(1, np.int64)
        else:
            h, n = word[:0], np.zeros(0, np.int64)
        hashes.append(h)
        times.append(n)
        at.append(at[-1] + len(h))
    return np.concatenate(hashes), np.concatenate(times), np.array(at)


def document_frequencies(docs: DataFrame, text_col: str) -> np.ndarray:
    """Weight of each counter: the smoothed inverse document frequency. 2 ** SKETCH_BITS numbers, whatever the corpus."""
    part = (1 << SKETCH_BITS) // _BLOCKS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, docs = np.zeros(1 << SKETCH_BITS, np.int64), 0
        for b in batches:
            texts = [t or "" for t in b.column(0).to_pylist()]
            docs += len(texts)
            for i, j in chunked(texts, CHARS):
                h, _, _ = shingles(texts[i:j])
                np.add.at(total, (h >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), 1)
        if docs:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(_BLOCKS), pa.int32()), pa.array([docs] * _BLOCKS, pa.int64()),
                 pa.array([total[k * part:(k + 1) * part].astype("<i4").tobytes() for k in range(_BLOCKS)], pa.binary())],
                names=["block", "docs", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(part, np.int64)
        for c in table.column("counts"):
            total += np.frombuffer(c.as_buffer(), "<i8" if len(c.as_buffer()) == 8 * part else "<i4")
        return pa.table({"block": table.column("block")[:1], "docs": pa.array([sum(table.column("docs").to_pylist())], pa.int64()),
                         "counts": pa.array([total.astype("<i8").tobytes()], pa.binary())})

    kind = "block int, docs long, counts binary"
    counted = map_batches(docs.select(F.col(text_col).cast("string")), run, kind)
    # sums of sums: about 32 tables meet in one task first, then their sums
    some = counted.withColumn("salt", F.floor(F.spark_partition_id() / 32))
    tables = some.groupBy("block", "salt").applyInArrow(lambda t: add(t), kind).groupBy("block").applyInArrow(lambda t: add(t), kind)
    got = sorted((r["block"], r["docs"], bytes(r["counts"])) for r in tables.collect())  # 8 MB
    if not got:
        return np.ones(1 << SKETCH_BITS, np.float32)
    count = np.concatenate([np.frombuffer(c, "<i8") for _, _, c in got]).astype(float)
    df = np.maximum(1.0, count - np.median(count))
    n = got[0][1]
    idf = np.log1p(n / np.minimum(df, n)) / np.log1p(n)
    return (1 - IDF_SHARE + IDF_SHARE * idf).astype(np.float32)


@cache
def _draws() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tables of random draws: r ~ Gamma(2, 1), 1 / r, and log c with c ~ Gamma(2, 1)."""
    rng = np.random.default_rng(20)
    r = rng.gamma(2.0, 1.0, 1 << 16).astype(np.float32)
    return r, (1 / r).astype(np.float32), np.log(rng.gamma(2.0, 1.0, 1 << 16)).astype(np.float32)


@cache
def _factors(n: int) -> np.ndarray:
    return np.random.default_rng(21).integers(1 << 62, 1 << 63, n).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def samples(hashes: np.ndarray, weight: np.ndarray, at: np.ndarray, n: int = BANDS * ROWS) -> np.ndarray:
    """``n`` consistent weighted samples of each text that has shingles, as 64-bit values (texts x samples).

    Of each shingle: t = floor(log w / r + beta), log a = log c - r (t + 1 - beta), with r, c, beta drawn by shingle and
    sample; the smallest log a wins. Its bits and the shingle's make the value.
    """
    has = np.flatnonzero(np.diff(at))
    out = np.zeros((len(at) - 1, n), np.uint64)
    if not len(has):
        return out
    begin = at[:-1][has]
    r_of, inv_of, c_of = _draws()
    log_w = np.log(weight).astype(np.float32)
    low = hashes & np.uint64(0xFFFFFFFF)
    for k, f in enumerate(_factors(n)):
        z = hashes * f
        z ^= z >> np.uint64(32)
        z *= np.uint64(0xD6E8FEB86659FD93)
        i = (z >> np.uint64(48)).astype(np.uint16)
        beta = ((z >> np.uint64(32)) & np.uint64(0xFFFF)).astype(np.float32) * np.float32(1 / 65536)
        t = np.floor(log_w * inv_of[i] + beta)
        log_a = c_of[((z >> np.uint64(16)) & np.uint64(0xFFFF)).astype(np.uint16)] - r_of[i] * (t + np.float32(1) - beta)
        key = np.clip((log_a + np.float32(64)) * np.float32(1 << 25), 0, 4294967040).astype(np.uint64)
        out[has, k] = np.minimum.reduceat((key << np.uint64(32)) | low, begin)
    return out


def _weights(idf: np.ndarray, hashes: np.ndarray, times: np.ndarray) -> np.ndarray:
    return idf[(hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)] * times.astype(np.float32)


def _profile(h: np.ndarray, times: np.ndarray) -> bytes:
    """A text's shingles in few bytes: the leading 40 bits of each hash, in order, and the counts above one."""
    more = np.flatnonzero(times > 1)
    parts = (np.array([len(h), len(more)], "<u4"), (h >> np.uint64(32)).astype("<u4"), ((h >> np.uint64(24)) & np.uint64(255)).astype("u1"),
             more.astype("<u4"), times[more].astype("<u4"))
    return b"".join(x.tobytes() for x in parts)


def _opened(p: bytes, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and weights of a profile."""
    n, m = np.frombuffer(p, "<u4", 2)
    h = (np.frombuffer(p, "<u4", n, 8).astype(np.uint64) << np.uint64(8)) | np.frombuffer(p, "u1", n, 8 + 4 * n)
    w = idf[(h >> np.uint64(40 - SKETCH_BITS)).astype(np.int64)].astype(float)
    w[np.frombuffer(p, "<u4", m, 8 + 5 * n)] *= np.frombuffer(p, "<u4", m, 8 + 5 * n + 4 * m)
    return h, w


def _similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two opened profiles."""
    (x, u), (y, v) = (a, b) if len(a[0]) <= len(b[0]) else (b, a)
    if not len(x):
        return 0.0
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    both = y[at] == x
    least = np.minimum(u[both], v[at[both]]).sum()
    return float(least / (u.sum() + v.sum() - least))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """(rows, links): for each row of ``docs`` its id, text key, class_id and class_size; verified links of texts by key, enough to
    join their classes."""
    key = F.unhex(F.md5(text_or_empty(F.col(text_col)).cast("binary")))
    src = docs.select(F.col(id_col).alias("id"), key.alias("key"), text_or_empty(F.col(text_col)).alias("text"))
    idf = broadcast_value(docs.sparkSession, document_frequencies(src, "text"))
    id_type = src.schema["id"].dataType.simpleString()
    seed = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, signed = b.column(2).to_pylist(), []
            for i, j in chunked(texts, CHARS):
                h, n, at = shingles(texts[i:j])
                s = samples(h, _weights(idf.value, h, n), at)
                signed += [x.tobytes() if e else None for x, e in zip(s, np.diff(at))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(signed, pa.binary())],
                                             names=["id", "key", "samples"])

    rows = reliable(map_batches(src, sign, f"id {id_type}, key binary, samples binary"))
    nodes = reliable(rows.groupBy("key").agg(F.min("id").alias("id"), F.count("*").alias("n"), F.first("samples").alias("samples")))

    def banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint64).reshape(-1, BANDS, ROWS)
            band = tk.mix(sum(s[:, :, i] * seed[i] for i in range(ROWS)) + np.arange(BANDS, dtype=np.uint64))
            who = pa.array(np.repeat(np.arange(len(s)), BANDS))
            yield pa.RecordBatch.from_arrays([pa.array(band.ravel().view(np.int64)), b.column(0).take(who)], names=["band", "key"])

    entries = map_batches(nodes.where("samples is not null").select("key", "samples"), banded, "band long, key binary")
    size = entries.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    members = reliable(entries.join(size, "band"))
    seen = members.groupBy("key").agg(F.sum("n").alias("seen"))
    leads = (members.join(seen, "key").groupBy("band").agg(F.max(F.struct("seen", "key")).alias("l"))
             .select("band", F.col("l.key").alias("lead")))
    members = reliable(members.join(leads, "band"))
    profiles = _profiles(src, members.select("key").distinct(), idf)
    stars = members.where("key <> lead").select(F.col("lead").alias("a"), F.col("key").alias("b")).distinct()
    first = reliable(_verified(stars, profiles, idf, similarity))

    # members that no chain of leaders joins yet, against the rest of their bucket
    joined = reliable(connected_components(first, "a", "b"))
    members = members.join(joined.withColumnRenamed("node", "key"), "key", "left").withColumn("class", F.coalesce("component", "key"))
    main = (members.groupBy("band", "class").agg(F.count("*").alias("c")).groupBy("band")
            .agg(F.max(F.struct("c", "class")).alias("m"), F.count("*").alias("classes")).where("classes > 1")
            .select("band", F.col("m.class").alias("main")))
    mixed = reliable(members.join(main, "band").select("band", "key", "n", "class", "main"))
    outside = mixed.where("class <> main")
    few = mixed.where(F.col("n") <= SMALL)
    small = (outside.where(F.col("n") <= SMALL).select("band", F.col("key").alias("a"), F.col("class").alias("ca"))
             .join(few.select("band", F.col("key").alias("b"), F.col("class").alias("cb")), "band").where("ca <> cb"))
    more = small.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    large = _compared(outside.where(F.col("n") > SMALL), mixed.where(F.col("n") > SMALL), profiles, idf, similarity)
    links = reliable(first.unionAll(_verified(more, profiles, idf, similarity)).unionAll(large))

    named = connected_components(links, "a", "b")
    classes = nodes.select("key", "id", "n").join(named.withColumnRenamed("node", "key"), "key", "left").withColumn(
        "component", F.coalesce("component", "key"))
    heads = classes.groupBy("component").agg(F.min("id").alias("class_id"), F.sum("n").alias("class_size"))
    classes = classes.select("key", "component").join(heads, "component").select("key", "component", "class_id", "class_size")
    return rows.select("id", "key").join(classes, "key").withColumnRenamed("id", id_col), links


class _Bitmap:
    """A broadcast bitmap of keys, of at most 16 MB: says no for most keys that aren't among the wanted, never for one that is."""

    def __init__(self, wanted: DataFrame):
        size = 1 << min(27, max(16, int(np.ceil(np.log2(16 * max(1, wanted.count()))))))
        self.place = F.pmod(F.xxhash64("key"), F.lit(size))
        # at most 4 million words, as Arrow columns
        words = (wanted.select(self.place.alias("bit")).groupBy(F.shiftright("bit", 5).cast("int").alias("w"))
                 .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 31 as int))")).alias("v")).toArrow())
        table = np.zeros(size >> 5, np.int64)
        table[words.column("w").to_numpy()] = words.column("v").to_numpy()
        self.shared = broadcast_value(wanted.sparkSession, table.astype(np.uint32))


def _maybe(shared, places: pa.Array) -> np.ndarray:
    bits = places.to_numpy(zero_copy_only=False)
    return ((shared.value[bits >> 5] >> (bits & 31).astype(np.uint32)) & 1).astype(bool)


def _profiles(src: DataFrame, wanted: DataFrame, idf) -> DataFrame:
    """(key, profile) of the wanted texts, made where the text is read.

    A bitmap of the wanted keys lets each task pass over most other texts; a join removes the rest.
    """
    wanted = reliable(wanted)
    bitmap = _Bitmap(wanted)
    shared = bitmap.shared

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[bytes] = set()  # copies of one text give one profile a task
        for b in batches:
            some = b.filter(pa.array(_maybe(shared, b.column(2))))
            keys, texts = [], []
            for k, t in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
                if k not in done:
                    done.add(k)
                    keys.append(k)
                    texts.append(t)
            out = []
            for i, j in chunked(texts, CHARS):
                h, n, at = shingles(texts[i:j])
                out += [_profile(h[a:e], n[a:e]) for a, e in zip(at[:-1], at[1:])]
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(out, pa.binary())], names=["key", "profile"])

    made = map_batches(src.select("key", "text", bitmap.place.alias("bit")), run, "key binary, profile binary")
    return reliable(made.groupBy("key").agg(F.first("profile").alias("profile")).join(wanted, "key", "left_semi"))


def _verified(pairs: DataFrame, profiles: DataFrame, idf, similarity: float) -> DataFrame:
    """The pairs (a, b) that reach the weighted Jaccard similarity, with it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, opened = None, None
        for b in batches:
            s = np.zeros(b.num_rows)
            for i, (x, y) in enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist())):
                if x != last:  # a leader's pairs come one after the other
                    last, opened = x, _opened(x, idf.value)
                s[i] = _similarity(opened, _opened(y, idf.value))
            keep = s >= similarity
            yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(keep)), b.column(1).filter(pa.array(keep)),
                                              pa.array(s[keep], pa.float64())], names=["a", "b", "similarity"])

    p = profiles.select(F.col("key").alias("a"), F.col("profile").alias("pa"))
    q = profiles.select(F.col("key").alias("b"), F.col("profile").alias("pb"))
    return map_batches(pairs.join(q, "b").join(p, "a").select("a", "b", "pa", "pb"), run, "a binary, b binary, similarity double")


def _ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The numbers from each low to before its high, in turn."""
    size = high - low
    return np.arange(size.sum()) + np.repeat(low - (np.cumsum(size) - size), size)


def _linked(left: list[tuple[np.ndarray, np.ndarray]], right: list[tuple[np.ndarray, np.ndarray]], left_class: np.ndarray,
            right_class: np.ndarray, similarity: float) -> list[tuple[int, int, float]]:
    """(i, j, similarity) of opened profiles of different classes that reach it, as many as join their classes.

    With a text's shingles put in order, the rarest first, those from which on less than ``similarity`` of its weight is left
    can't be all that it shares with one that reaches it: only pairs that share one of the shingles before, in both
    texts, are compared, and all of them.
    """
    n, both = len(left), [*left, *right]
    size = np.array([len(h) for h, _ in both])
    at = np.concatenate([[0], np.cumsum(size)])
    owner = np.repeat(np.arange(len(both)), size)
    _, token, times = np.unique(np.concatenate([h for h, _ in both]), return_inverse=True, return_counts=True)
    place = np.empty(len(times), np.int64)
    place[np.argsort(times, kind="stable")] = np.arange(len(times))
    order = np.argsort(owner << 32 | place[token], kind="stable")
    token, w = place[token][order].astype(np.int32), np.concatenate([w for _, w in both])[order]
    total = np.bincount(owner, w, len(both))
    whole = np.concatenate([[0.0], np.cumsum(w)])
    rare = total[owner] - (whole[:-1] - whole[at[owner]]) >= (similarity - _SLACK) * total[owner]
    rare_end = at[:-1] + np.bincount(owner, rare, len(both)).astype(np.int64)
    mine = np.flatnonzero(rare & (owner >= n))
    mine = mine[np.argsort(token[mine], kind="stable")]
    begins = np.concatenate([[0], np.cumsum(np.bincount(token[mine], minlength=len(times)))])
    mine = owner[mine] - n  # of the right that have a shingle among their rarest, shingle by shingle
    found, classes, others, weight = [], left_class.copy(), right_class.copy(), np.zeros(len(times))
    for i in range(n):
        t = token[at[i]:rare_end[i]]
        near = np.zeros(len(right), bool)
        near[mine[_ranges(begins[t], begins[t + 1])]] = True
        bound = (similarity - _SLACK) * np.maximum(total[i], total[n:]) <= np.minimum(total[i], total[n:])
        js = np.flatnonzero(near & bound & (others != classes[i]))
        own = slice(at[i], at[i + 1])
        weight[token[own]] = w[own]
        shared = np.zeros(len(js))
        ends = np.concatenate([[0], np.cumsum(size[n + js])])
        for a, b in _stretches(ends, 2 * SHINGLES):
            those = _ranges(at[n + js[a:b]], at[n + js[a:b] + 1])
            shared[a:b] = np.add.reduceat(np.minimum(weight[token[those]], w[those]), ends[a:b] - ends[a])
        weight[token[own]] = 0
        s = shared / (total[i] + total[n + js] - shared)
        for k in np.argsort(-s, kind="stable"):
            if s[k] < similarity - _SLACK:
                break
            j = js[k]
            if others[j] != classes[i] and (exact := _similarity(left[i], right[j])) >= similarity:
                found.append((i, int(j), exact))
                old, new = others[j], classes[i]
                classes[classes == old] = new
                others[others == old] = new
    return found


def _stretches(ends: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Index ranges of consecutive texts of about ``limit`` shingles together, from where their shingles begin (and the end)."""
    a = 0
    while a < len(ends) - 1:
        b = max(a + 1, int(np.searchsorted(ends, ends[a] + limit, "right")) - 1)
        yield a, b
        a = b


def _compared(outside: DataFrame, members: DataFrame, profiles: DataFrame, idf, similarity: float) -> DataFrame:
    """Verified links (a, b, similarity) between outsiders and members of large buckets, as many as join their classes.

    Outsiders and members of a bucket are dealt into blocks of about ``BLOCK`` by a hash; each pair of blocks is one
    group, whose links ``_linked`` finds, some ``SHINGLES`` of either side at a time.
    """
    most = SHINGLES
    parts = F.ceil(F.col("n") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("key"), parts).cast("int")
    every = F.explode(F.sequence(F.lit(0), parts - 1))
    cols = ["band", "i", "j", "key", "class", "profile"]
    left = outside.withColumn("i", block).withColumn("j", every).join(profiles, "key").select(*cols)
    right = members.withColumn("j", block).withColumn("i", every).join(profiles, "key").select(*[F.col(c).alias(f"r_{c}") for c in cols])

    def agree(x: pa.Table, y: pa.Table) -> pa.Table:
        found = []
        if x.num_rows and y.num_rows:
            (ku, cu, pu), (kv, cv, pv) = ([t.column(k).to_pylist() for k in (3, 4, 5)] for t in (x, y))
            number = {c: i for i, c in enumerate(dict.fromkeys([*cu, *cv]))}
            cu, cv = (np.array([number[c] for c in side]) for side in (cu, cv))
            ends_u, ends_v = (np.cumsum([0, *(int(np.frombuffer(p, "<u4", 1)[0]) for p in side)]) for side in (pu, pv))
            for a, b in _stretches(ends_u, most):
                some = [_opened(p, idf.value) for p in pu[a:b]]
                for c, d in _stretches(ends_v, most):
                    for i, j, s in _linked(some, [_opened(p, idf.value) for p in pv[c:d]], cu[a:b], cv[c:d], similarity):
                        found.append((min(ku[a + i], kv[c + j]), max(ku[a + i], kv[c + j]), s))
                        old, new = cv[c + j], cu[a + i]
                        cu[cu == old] = new
                        cv[cv == old] = new
        a, b, s = zip(*found) if found else ((), (), ())
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary()), "similarity": pa.array(s, pa.float64())})

    return left.groupBy("band", "i", "j").cogroup(right.groupBy("r_band", "r_i", "r_j")).applyInArrow(
        lambda x, y: agree(x, y), "a binary, b binary, similarity double")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row of each class, with all its columns: that of the smallest id; of several rows of that id and text, one.

    Rows of classes of one, most of them, are kept where they are read; only the others' rows are shuffled.
    """
    rows = reliable(near_duplicates(docs, id_col, text_col, similarity)[0])
    some = rows.where("class_size > 1")
    best = some.groupBy("component").agg(F.min(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), "key")).alias("k"))
    times = some.groupBy(F.col(id_col).alias("id"), "key").agg(F.count("*").alias("times"))
    kept = best.select("k.id", "k.key").alias("k").join(
        times.alias("t"), F.col("k.id").eqNullSafe(F.col("t.id")) & (F.col("k.key") == F.col("t.key"))).select(
        F.col("k.id").alias("kid"), F.col("k.key").alias("kkey"), "times")
    bitmap = _Bitmap(some.select("key").distinct())
    shared = bitmap.shared
    # the caller's columns go by position, so none can clash
    names = [f"c{i}" for i in range(len(docs.columns))]
    text = text_or_empty(F.col(text_col))
    src = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names)],
                      F.unhex(F.md5(text.cast("binary"))).alias("key")).withColumn("bit", bitmap.place)
    schema = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip([*names, "key", "bit"], src.schema.fields))

    def part(wanted: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield b.filter(pa.array(_maybe(shared, b.column(b.num_columns - 1)) == wanted))
        return map_batches(src, run, schema)

    # a key that is in the bitmap by chance alone is in no class of several
    grouped = some.select(F.col("key").alias("gkey")).distinct()
    hits = part(True)
    alone = hits.join(grouped, F.col("key") == F.col("gkey"), "left_anti").select(*names)
    at = names[docs.columns.index(id_col)]
    found = hits.join(kept, (F.col("key") == F.col("kkey")) & F.col(at).eqNullSafe(F.col("kid")))
    once = found.where("times = 1").select(*names)
    again = found.where("times > 1").groupBy("kid", "key").agg(F.first(F.struct(*names)).alias("row")).select("row.*")
    return part(False).select(*names).unionAll(alone).unionAll(once).unionAll(again).toDF(*docs.columns)
