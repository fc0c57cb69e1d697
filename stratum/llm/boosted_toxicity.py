"""Toxicity: gradient-boosted trees over a few dense measures, with isotonic calibration.

A lexicon (whole words and word beginnings, also read through look-alike
characters) is learned from one part of the labelled sample by smoothed log-odds;
the trees are boosted on another part and the calibration on a third, so none
sees its own evidence. Measures of a text: lexicon densities, nearness of
lexicon words to the second person, capitals, punctuation, obfuscation rate.

Defined cases: null and empty texts have all measures 0 and get the score the
model gives those; repeated rows score alike; with no labelled rows, or one
class only, every score is the share of label 1 (0 without labels).
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, broadcast_value, map_batches

#: Labelled documents that lexicon, trees and calibration are learned from (bounded training sample).
SAMPLE = 9000
#: Entries of the learned lexicon, at most: the bound of what is broadcast.
LEXICON = 4000
#: A lexicon entry stands in so many toxic documents of its part of the sample at least.
LEAST_SEEN = 4
MIN_LOG_ODDS = 2.0
#: Words within this distance of a second-person word count as directed at somebody.
NEAR = 4
MEMO_LIMIT = 500_000

# Second-person words of the languages at hand, and look-alike characters.
SECOND_PERSON = frozenset("""you your yours yourself yourselves u ur du dich dir dein deine deinen deiner euch euer
tu te toi ton ta tes vous votre vos tú ti usted ustedes vuestro vuestra""".split())
LOOK_ALIKES = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s",
                             "!": "i", "|": "l", "*": None, ".": None, "_": None, "-": None})

_CAPITAL = re.compile(r"[A-ZÀ-ÖØ-Þ]+")
_EDGE = ".,;:!?\"'()[]{}<>«»„“”‚‘’…*_~`|/\\-"


def entries(token: str) -> list[str]:
    """What a token can be found by in the lexicon: the word, its first 4, 5 and 6 letters, and the same undisguised."""
    out = []
    word = token.strip(_EDGE).lower()
    plain = word if word.isalpha() else token.lower().translate(LOOK_ALIKES).strip(_EDGE)
    for w in dict.fromkeys((word, plain)):
        if 2 < len(w) < 40 and any(map(str.isalpha, w)):
            out.append("=" + w)
            out += [f"{n}^{w[:n]}" for n in (4, 5, 6) if len(w) > n]
    return out


class Measures:
    """Measures of whole texts under a lexicon; tokens seen before are remembered."""

    NAMES = ("hits_per_word", "odds_per_word", "strongest", "kinds", "hits", "near_second", "second_per_word", "capitals",
             "shouted_words", "punctuation", "exclaimed", "disguised", "disguised_hits", "words")

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon
        self.memo: dict[str, int] = {}
        self.info: list[tuple[float, bool, bool, bool]] = [(0.0, False, False, False)]

    def _learn(self, token: str) -> int:
        odds = max((self.lexicon.get(e, 0.0) for e in entries(token)), default=0.0)
        word = token.strip(_EDGE)
        second = word.lower() in SECOND_PERSON
        shouted = len(word) > 2 and word.isupper()
        disguised = len(word) > 2 and any(map(str.isalpha, word)) and not word.isalpha() and any(
            c in "013457@$*" for c in word) and sum(map(str.isalpha, word)) * 2 >= len(word)
        code = 0
        if odds or second or shouted or disguised:
            code = len(self.info)
            self.info.append((odds, second, shouted, disguised))
        self.memo[token] = code
        return code

    def __call__(self, text: str) -> list[float]:
        if len(self.memo) > MEMO_LIMIT:
            self.memo.clear()
            del self.info[1:]
        tokens = text.split()
        n = max(1, len(tokens))
        get, learn = self.memo.get, self._learn
        codes = [c if (c := get(t)) is not None else learn(t) for t in tokens]
        hot = [i for i, c in enumerate(codes) if c] if any(codes) else []
        hits = [(i, self.info[codes[i]][0], codes[i]) for i in hot if self.info[codes[i]][0] > 0]
        second = [i for i in hot if self.info[codes[i]][1]]
        near = _near([i for i, _, _ in hits], second)
        size = max(1, len(text))
        letters = size - text.count(" ")
        odds = [o for _, o, _ in hits]
        return [len(hits) / n, sum(odds) / n, max(odds, default=0.0), math.log1p(len({c for _, _, c in hits})),
                math.log1p(len(hits)), near / max(1, len(hits)), len(second) / n,
                sum(map(len, _CAPITAL.findall(text))) / letters, sum(self.info[codes[i]][2] for i in hot) / n,
                sum(map(text.count, ".,;:?*#%&$")) / letters, text.count("!") / letters,
                sum(self.info[codes[i]][3] for i in hot) / n,
                sum(1 for _, _, c in hits if self.info[c][3]) / n, math.log1p(len(tokens))]


def _near(places: list[int], others: list[int]) -> int:
    """How many of the sorted places have one of the sorted others within ``NEAR``."""
    if not places or not others:
        return 0
    at, of = np.array(places), np.array(others)
    right = np.searchsorted(of, at)
    gap = np.minimum(np.abs(of[np.minimum(right, len(of) - 1)] - at), np.abs(of[np.maximum(right - 1, 0)] - at))
    return int((gap <= NEAR).sum())


@dataclass(frozen=True)
class Trees:
    """Boosted regression trees of depth ``depth``, as arrays; ``leaf`` holds log-odds."""

    base: float
    depth: int
    feature: np.ndarray  # trees x inner nodes
    cut: np.ndarray
    leaf: np.ndarray  # trees x leaves

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for f, c, v in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, f[node]] > c[node])
            out += v[node - (len(f))]
        return out


def boost(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.15, bins: int = 48,
          least: float = 2.0, penalty: float = 1.0) -> Trees:
    """Newton boosting of the logistic loss on binned measures."""
    cuts = [np.unique(np.quantile(col, np.linspace(0, 1, bins + 1)[1:-1])) for col in x.T]
    binned = np.stack([np.searchsorted(c, col, side="left") for c, col in zip(cuts, x.T)], axis=1)
    width = bins + 1
    share = np.clip(y.mean(), 1e-4, 1 - 1e-4)
    base = float(np.log(share / (1 - share)))
    f_all, c_all, v_all = [], [], []
    score = np.full(len(y), base)
    inner = 2 ** depth - 1
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, np.maximum(p * (1 - p), 1e-9)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first = 2 ** level - 1
            for k in range(first, 2 * first + 1):
                rows = np.flatnonzero(node == k)
                if len(rows) < 2:
                    continue
                best = 1e-9
                gt, ht = g[rows].sum(), h[rows].sum()
                for j, c in enumerate(cuts):
                    if not len(c):
                        continue
                    b = binned[rows, j]
                    gl = np.cumsum(np.bincount(b, g[rows], width))[:len(c)]
                    hl = np.cumsum(np.bincount(b, h[rows], width))[:len(c)]
                    gain = gl ** 2 / (hl + penalty) + (gt - gl) ** 2 / (ht - hl + penalty) - gt ** 2 / (ht + penalty)
                    gain[(hl < least * 0.02) | (ht - hl < least * 0.02)] = 0
                    i = int(gain.argmax())
                    if gain[i] > best:
                        best, feature[k], cut[k] = gain[i], j, c[i]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > cut[node])
        leaf = node - inner
        value = rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + penalty)
        score = score + value[leaf]
        f_all.append(feature)
        c_all.append(cut)
        v_all.append(value)
    return Trees(base, depth, np.array(f_all), np.array(c_all), np.array(v_all))


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators; knots of a non-decreasing map from score to probability."""
    order = np.argsort(score, kind="stable")
    blocks: list[list[float]] = []  # mean, weight, first score, last score
    xs, first = score[order], 0
    ys = y[order].astype(float)
    while first < len(xs):
        last = int(np.searchsorted(xs, xs[first], side="right"))
        blocks.append([ys[first:last].mean(), last - first, xs[first], xs[first]])
        first = last
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            b, a = blocks.pop(), blocks.pop()
            w = a[1] + b[1]
            blocks.append([(a[0] * a[1] + b[0] * b[1]) / w, w, a[2], b[3]])
    xk = np.array([v for b in blocks for v in (b[2], b[3])])
    yk = np.array([v for b in blocks for v in (b[0], b[0])])
    return xk, yk


@dataclass(frozen=True)
class Model:
    lexicon: dict[str, float]
    trees: Trees | None
    knots: tuple[np.ndarray, np.ndarray] | None
    share: float = 0.0

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None:
            return np.full(len(x), self.share)
        raw = self.trees.log_odds(x)
        p = 1 / (1 + np.exp(-raw))
        if self.knots is None or not len(self.knots[0]):
            return p
        # a hundredth of the trees' own probability keeps the order within a flat step
        return np.clip(0.99 * np.interp(raw, *self.knots) + 0.01 * p, 0.0, 1.0)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          sample: int = SAMPLE, lexicon_size: int = LEXICON) -> Model:
    """Learn from about ``sample`` labelled documents, picked by a hash of the id.

    Word counts are made by Spark; the driver gets at most ``lexicon_size`` entries and a few numbers per sampled document.
    """
    known = (labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("k"))
             .agg(F.avg(F.col(label_col).cast("double")).alias("y")).where("y <> 0.5"))
    few = F.broadcast(bounded_sample(known, "k", sample))  # at most about ``sample`` rows of two numbers
    # equal texts go to the same part, so copies don't vouch for each other
    part = F.pmod(F.xxhash64("t"), F.lit(10))
    src = (docs.select(F.col(id_col).alias("k"), F.col(text_col).cast("string").alias("t")).where("t <> ''").join(few, "k")
           .select((F.col("y") > 0.5).cast("int").alias("y"), part.cast("int").alias("part"), "t"))

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for y, text in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                names = sorted({e for t in set(text.split()) for e in entries(t)})
                yield pa.RecordBatch.from_arrays([pa.array([y] * len(names), pa.int32()), pa.array(names, pa.string())],
                                                 names=["y", "e"])

    sizes = {r["y"]: r["n"] for r in src.where("part < 5").groupBy("y").agg(F.count("*").alias("n")).collect()}
    bad, fine = sizes.get(1, 0), sizes.get(0, 0)
    if not bad or not fine:
        return Model({}, None, None, 1.0 if bad else 0.0)
    odds = F.log((F.col("bad") + 0.1) / F.lit(bad + 0.2)) - F.log((F.col("fine") + 0.1) / F.lit(fine + 0.2))
    found = (map_batches(src.where("part < 5"), listed, "y int, e string").groupBy("e")
             .agg(F.sum("y").alias("bad"), F.sum(1 - F.col("y")).alias("fine"))
             .where(F.col("bad") >= min(LEAST_SEEN, max(1, bad // 10))).withColumn("odds", odds)
             .where(F.col("odds") > MIN_LOG_ODDS).orderBy(F.desc(F.col("odds") * F.sqrt("bad")), "e").limit(lexicon_size).collect())
    lexicon = {r["e"]: float(r["odds"]) for r in found}
    shared = broadcast_value(docs.sparkSession, lexicon)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measure = Measures(shared.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([measure(t) for t in b.column(2).to_pylist()], pa.list_(pa.float64()))],
                names=["y", "part", "x"])

    rows = sorted((r["part"], r["y"], tuple(r["x"])) for r in
                  map_batches(src.where("part >= 5"), measured, "y int, part int, x array<double>").collect())
    if len({y for _, y, _ in rows}) < 2:
        return Model(lexicon, None, None, bad / (bad + fine))
    part_of, y = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    x = np.array([r[2] for r in rows])
    first = part_of < 8
    if len(set(y[first])) < 2 or len(set(y[~first])) < 2:
        first = np.ones(len(y), bool)
    trees = boost(x[first], y[first])
    rest = ~first if (~first).any() else first
    return Model(lexicon, trees, isotonic(trees.log_odds(x[rest]), y[rest]))


def classify(docs: DataFrame, model: Model, id_cols: list[str], text_col: str = "text") -> DataFrame:
    """``id_cols`` and score, one row per row of ``docs``. The broadcast holds the lexicon and the trees."""
    shared = broadcast_value(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        measure = Measures(model.lexicon)
        for b in batches:
            x = np.array([measure(t or "") for t in b.column(b.num_columns - 1).to_pylist()]).reshape(-1, len(Measures.NAMES))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(model.score(x))],
                                             names=[*b.schema.names[:-1], "score"])

    src = docs.select(*[F.col(c) for c in id_cols], F.col(text_col).cast("string").alias("__text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1])
    return map_batches(src, run, f"{fields}, score double")
