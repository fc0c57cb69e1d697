"""Approximate nearest neighbours by inner product: probed lists, scanned dimension by dimension.

Vectors are extended by one component so that the largest inner product becomes
the smallest distance, and rotated at random. Centroids are fitted on a bounded
sample; every vector is put into its centroid's list. A query scans its
``probes`` nearest lists. Within a list, rotated vectors lie in column blocks: after
each block a hypothesis test compares the partial distance, scaled up, with the
best distances so far, and abandons the candidates that are too far with high
probability. What is left is scored exactly on the original vectors.

How many lists are probed is measured on the sample: as many as hold ``COVER`` of
the sample's own exact neighbours.

Lists are cut into blocks of about ``BLOCK_ROWS`` vectors and ``BLOCK_QUERIES``
queries by a hash of the id, so one list, or one vector repeated in a third of
all rows, never meets in one task.

Defined cases: vectors null, zero, with null or non-finite components, of another
dimension than most, or without id take no part; of rows with one id the smallest
vector counts; ties go to the smaller id; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_sample, broadcast_value, reliable, ship_package

#: Vectors that centroids and the number of probes are learned from (bounded sample; every vector is indexed).
SAMPLE = 12_000
CALIBRATION_QUERIES = 300
COVER = 0.975
MAX_LISTS = 1024
BLOCK_ROWS, BLOCK_QUERIES = 4096, 1024
#: Dimensions of a column block, vectors tested at a time, and the test's slack (larger: fewer wrong abandonments).
COLUMNS, CHUNK, SLACK = 16, 1024, 2.1
#: Share of pairs still alive under which they are followed one by one.
SPARSE = 0.04


@dataclass(frozen=True)
class Quantizer:
    rotation: np.ndarray
    top: float  # largest norm, squared
    centroids: np.ndarray
    probes: int

    def base(self, x: np.ndarray) -> np.ndarray:
        """Rotated vectors, extended so that all have the same norm."""
        rest = np.sqrt(np.maximum(0.0, self.top - (x * x).sum(axis=1)))
        return np.hstack([x, rest[:, None]]) @ self.rotation

    def queries(self, q: np.ndarray) -> np.ndarray:
        """Rotated queries of the common norm; a query's scale doesn't change its order of neighbours."""
        q = q * (np.sqrt(self.top) / np.linalg.norm(q, axis=1, keepdims=True))
        return np.hstack([q, np.zeros((len(q), 1))]) @ self.rotation

    def order(self, rotated: np.ndarray) -> np.ndarray:
        d = (self.centroids ** 2).sum(axis=1) - 2 * rotated @ self.centroids.T
        return np.argsort(d, axis=1, kind="stable")

    def nearest(self, rotated: np.ndarray) -> np.ndarray:
        return ((self.centroids ** 2).sum(axis=1) - 2 * rotated @ self.centroids.T).argmin(axis=1)


def fit(x: np.ndarray, top: float, lists: int, k: int, seed: int = 5, rounds: int = 10) -> Quantizer:
    rng = np.random.default_rng(seed)
    dim = x.shape[1] + 1
    rotation, _ = np.linalg.qr(rng.standard_normal((dim, dim)))
    q = Quantizer(rotation, top, np.zeros((1, dim)), 1)
    z = q.base(x)
    lists = max(1, min(lists, len(z) // 20))
    c = z[rng.choice(len(z), lists, replace=False)]
    for _ in range(rounds):
        own = Quantizer(rotation, top, c, 1).nearest(z)
        n = np.bincount(own, minlength=lists)
        total = np.zeros_like(c)
        np.add.at(total, own, z)
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], z[rng.choice(len(z), lists)])
    q = Quantizer(rotation, top, c, lists)
    pick = rng.choice(len(x), min(CALIBRATION_QUERIES, len(x)), replace=False)
    score = x[pick] @ x.T
    score[np.arange(len(pick)), pick] = -np.inf
    near = np.argsort(-score, axis=1)[:, :min(k, len(x) - 1)]
    if not near.size:
        return q
    place = np.argsort(q.order(q.queries(x[pick])), axis=1)  # of each list, in each query's order
    rank = np.take_along_axis(place, q.nearest(z)[near], axis=1)
    probes = int(np.quantile(rank, COVER, method="higher")) + 1
    return Quantizer(rotation, top, c, min(lists, probes))


def scan_block(ids: np.ndarray, x: np.ndarray, z: np.ndarray, qids: np.ndarray, q: np.ndarray, zq: np.ndarray,
               k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query's number, id, score) of the ``k`` best of a block for each query, abandoning candidates early.

    ``z`` and ``zq`` are rotated. Candidates come in chunks; within a chunk, distances grow one column block at a time for
    all pairs still alive, densely while most are, then pair by pair.
    """
    dim, n = z.shape[1], len(qids)
    # partial distances of a column block as one product: [-2 q, 1, |q|^2] . [z, |z|^2, 1]; single precision is enough to
    # test with, scores are computed from the originals
    blocks = []
    for d in range(0, dim, COLUMNS):
        zb, qb = z[:, d:d + COLUMNS], zq[:, d:d + COLUMNS]
        left = np.hstack([-2 * qb, np.ones((n, 1)), np.einsum("ij,ij->i", qb, qb)[:, None]]).astype(np.float32)
        right = np.vstack([zb.T, np.einsum("ij,ij->i", zb, zb)[None], np.ones((1, len(z)))]).astype(np.float32)
        blocks.append((min(dim, d + COLUMNS), left, right))
    open_end = np.float32(1e30)  # more than any distance, less than that of a query's own row
    limit = np.full(n, open_end, np.float32)  # each query's distance to its k-th best so far
    near = np.full((n, k), open_end, np.float32)
    who, got = [], []
    first = min(len(ids), max(8 * k, 128))
    for a, e in zip([0, *range(first, len(ids), CHUNK)], [first, *range(first + CHUNK, len(ids) + CHUNK, CHUNK)]):
        chunk = np.arange(a, min(e, len(ids)))
        far = np.zeros((n, len(chunk)), np.float32)
        far[qids[:, None] == ids[chunk][None, :]] = 3e38
        rows = cols = None
        for f, left, right in blocks:
            top = limit * np.float32(f / dim * (1 + SLACK / np.sqrt(f)) ** 2 if f < dim else 1 + 1e-5) + np.float32(1e-6)
            if rows is None:
                far += left @ right[:, chunk[0]:chunk[-1] + 1]
                if f < dim and limit[0] == open_end:
                    continue
                alive = far <= top[:, None]
                if f == dim or np.count_nonzero(alive) < SPARSE * alive.size:
                    rows, cols = np.nonzero(alive)
                    far = far[rows, cols]
            else:
                far = far + np.einsum("ij,ij->i", left[rows], right.T[chunk[cols]])
                keep = far <= top[rows]
                rows, cols, far = rows[keep], cols[keep], far[keep]
        who.append(rows)
        got.append(chunk[cols])
        # the k best distances of each query, with this chunk's
        counts = np.bincount(rows, minlength=n)
        wide = np.full((n, k + int(counts.max(initial=0))), open_end, np.float32)
        wide[:, :k] = near
        wide[rows, k + np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)] = far
        near = np.partition(wide, k - 1, axis=1)[:, :k]
        limit = np.minimum(near[:, k - 1], open_end)
    who, got = np.concatenate(who), np.concatenate(got)
    if not len(who):
        return who, ids[got], np.zeros(0)
    score = np.concatenate([np.einsum("ij,ij->i", x[got[i:i + 65536]], q[who[i:i + 65536]]) for i in range(0, len(who), 65536)])
    order = np.lexsort((ids[got], -score, who))
    who, got, score = who[order], got[order], score[order]
    begin = np.concatenate([[0], np.flatnonzero(np.diff(who)) + 1])
    place = np.arange(len(who)) - np.repeat(begin, np.diff(np.append(begin, len(who))))
    best = place < k
    return who[best], ids[got[best]], score[best]


def _packed(col: Column) -> Column:
    return col.cast("array<double>")


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v) of the vectors that take part, one row per id."""
    v = F.col("v")
    good = (v.isNotNull() & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
            & F.exists(v, lambda c: c != 0.0))
    rows = (vectors.select(F.col(id_col).cast("long").alias("vec_id"), _packed(F.col(vec_col)).alias("v"))
            .where(F.col("vec_id").isNotNull()).where(good).groupBy("vec_id").agg(F.min("v").alias("v")))
    dims = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("v") == (dims["d"] if dims else 0))


def _matrix(col: pd.Series) -> np.ndarray:
    return np.array(col.tolist(), dtype=np.float64)


def _unpacked(col: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(col.tolist()), np.float64).reshape(len(col), -1)


def search(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
           probes: int | None = None) -> DataFrame:
    """query_id, rank (from 1), vec_id and score: the ``k`` best found of every query, its own row left out.

    ``is_query`` is an expression on ``vec_id``. ``probes`` overrides the measured number of lists.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    out_schema = "query_id long, rank int, vec_id long, score double"
    rows = usable(vectors, id_col, vec_col)
    facts = rows.agg(F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda s, c: s + c * c)).alias("top")).first()
    if not facts["n"]:
        return spark.createDataFrame([], out_schema)
    sample = bounded_sample(rows, "vec_id", SAMPLE).collect()
    fitted = fit(_matrix(pd.Series([r["v"] for r in sorted(sample)])), facts["top"] * (1 + 1e-9),
                 min(MAX_LISTS, max(1, int(np.sqrt(facts["n"]) / 2))), k)
    if probes:
        fitted = Quantizer(fitted.rotation, fitted.top, fitted.centroids, min(probes, len(fitted.centroids)))
    shared = broadcast_value(spark, fitted)

    def listing(frames, probed: bool):
        for frame in frames:
            for i in range(0, len(frame), 1000):  # bounds what one query's lists multiply
                f = frame.iloc[i:i + 1000]
                x = _matrix(f["v"])
                if probed:
                    to = shared.value.order(shared.value.queries(x))[:, :shared.value.probes]
                else:
                    to = shared.value.nearest(shared.value.base(x))[:, None]
                row = np.repeat(np.arange(len(f)), to.shape[1])
                packed = np.array([v.tobytes() for v in x], dtype=object)
                yield pd.DataFrame({"vec_id": f["vec_id"].to_numpy()[row], "v": packed[row], "list": to.ravel().astype(np.int32)})

    # vectors travel as bytes from here on
    schema = "vec_id long, v binary, list int"
    listed = reliable(rows.mapInPandas(lambda frames: listing(frames, False), schema))
    asked = reliable(rows.where(is_query).mapInPandas(lambda frames: listing(frames, True), schema))
    # one row per list on each side: at most MAX_LISTS rows
    filled = listed.groupBy("list").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks"))
    wanted = asked.groupBy("list").agg(F.ceil(F.count("*") / BLOCK_QUERIES).cast("int").alias("parts"))
    plan = F.broadcast(filled.join(wanted, "list"))
    block = F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int")
    part = F.pmod(F.xxhash64("vec_id", F.lit(3)), F.col("parts")).cast("int")
    left = (listed.join(plan, "list").withColumn("block", block)
            .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("list", "block", "part", "vec_id", "v"))
    right = (asked.join(plan, "list").withColumn("part", part)
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("list", "block", "part", "vec_id", "v"))

    def scan(base: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(base) or not len(queries):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        base = base.sort_values("vec_id")
        ids, x = base["vec_id"].to_numpy(), _unpacked(base["v"])
        z = shared.value.base(x)
        parts = []
        for i in range(0, len(queries), 128):
            qid, q = queries["vec_id"].to_numpy()[i:i + 128], _unpacked(queries["v"].iloc[i:i + 128])
            who, got, score = scan_block(ids, x, z, qid, q, shared.value.queries(q), k)
            parts.append(pd.DataFrame({"query_id": qid[who], "vec_id": got, "score": score}))
        return pd.concat(parts)

    key = ["list", "block", "part"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(scan, "query_id long, vec_id long, score double")
    best = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", best).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
