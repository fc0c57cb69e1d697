"""Quality classifier: a linear-chain conditional random field over lines.

Every line is good (1) or bad (0). A line is described by its own measures and
by its neighbours' (shares of letters, capitals, digits and symbols, word
lengths, repeated words, repeated lines); the chain adds a weight for each pair
of neighbouring labels. Training starts from the document's label on each of its
lines, then relabels the lines of bad documents by the fitted marginals and
fits again. A document's score is the mean of its lines' forward-backward
marginals, weighted by their length.

Defined cases: a null or empty text scores 0; repeated rows score alike; with
no labelled rows every other document scores 0.5.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .common import bounded_sample, broadcast_value, chunked, map_batches

#: Labelled documents, and stretches of their lines, that the model is fitted on (bounded training sample).
SAMPLE = 2500
#: Training documents are cut, whole, into stretches of so many lines, each a chain of its own; the fit takes about
#: ``SAMPLE`` stretches (all, if fewer), picked by a hash of document and place. Scoring chains whole texts.
STRETCH = 400
OWN = 11


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # of the line's measures, for "good"
    bias: float
    pair: np.ndarray  # 2 x 2, of neighbouring labels


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Measures of every line of the texts, the lines' lengths, and the number of lines of each text."""
    cp, bounds = tk.code_points(texts)
    flags = tk.classes()[cp]
    ends = np.flatnonzero(cp == 10) + 1
    starts = np.concatenate([[0], ends[:-1]])
    edges = np.concatenate([[0], ends])
    per_text = np.searchsorted(ends, bounds[1:], side="right") - np.searchsorted(ends, bounds[:-1], side="right")
    length = (ends - starts - 1).astype(float)
    n = np.maximum(length, 1.0)
    letters = tk.counts(flags & tk.LETTER > 0, edges)
    upper = tk.counts(flags & tk.UPPER > 0, edges)
    digits = tk.counts(flags & tk.DIGIT > 0, edges)
    spaces = tk.counts(flags & tk.SPACE > 0, edges) - 1  # without its line end
    symbols = n - letters - digits - spaces
    other = flags & tk.OTHER > 0
    drummed = tk.counts(other & np.concatenate([[False], cp[1:] == cp[:-1]]), edges)
    ws, we, wh = tk.words(cp, flags)
    first = np.searchsorted(ws, edges)
    words = np.diff(first).astype(float)
    same = np.zeros(len(ws), bool)
    same[1:] = wh[1:] == wh[:-1]
    again = tk.counts(same, first)
    whole = np.zeros(len(ends), np.uint64)  # hash of a line's words in order
    if len(ws):
        line_of = np.repeat(np.arange(len(ends)), np.diff(first))
        place = (np.arange(len(ws)) - first[line_of]).astype(np.uint64)
        np.add.at(whole, line_of, wh * (np.uint64(2) * place + np.uint64(1)))
    text_of = np.repeat(np.arange(len(texts)), per_text)
    key = tk.mix(whole) + text_of.astype(np.uint64) * np.uint64(0x9E3779B1)
    _, where, times = np.unique(key, return_inverse=True, return_counts=True)
    w = np.maximum(words, 1.0)
    own = np.stack([
        np.log1p(length), letters / n, upper / np.maximum(letters, 1), digits / n, np.maximum(symbols, 0) / n,
        np.maximum(symbols, 0) / w, drummed / n, (letters + digits) / w / 10.0, again / w,
        np.where(words > 0, np.log(times[where]), 0.0), np.log1p(words)], axis=1)
    left = np.vstack([np.zeros((1, OWN)), own[:-1]])
    right = np.vstack([own[1:], np.zeros((1, OWN))])
    at = np.concatenate([[0], np.cumsum(per_text)])
    left[at[:-1]] = own[at[:-1]]  # a text's first and last line are their own neighbours
    right[at[1:] - 1] = own[at[1:] - 1]
    return np.hstack([own, left, right]), length, per_text


def _log_add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.logaddexp(a, b)


def marginals(unary: np.ndarray, pair: np.ndarray, per_text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of "good" of each line, and of each pair of labels between it and the next line.

    ``unary`` is the log-potential of "good" against "bad". All texts advance together, line by line.
    """
    n = len(unary)
    begin = np.concatenate([[0], np.cumsum(per_text)])[:-1]
    order = np.argsort(-per_text, kind="stable")
    begin, size = begin[order], per_text[order]
    emit = np.stack([np.zeros(n), unary], axis=1)
    ahead, back = emit.copy(), np.zeros((n, 2))
    longest = int(size[0]) if len(size) else 0
    alive = np.searchsorted(-size, -np.arange(longest), side="left")  # texts with more than t lines
    for t in range(1, longest):
        i = begin[:alive[t]] + t
        ahead[i] = emit[i] + _log_add(ahead[i - 1][:, :1] + pair[0], ahead[i - 1][:, 1:] + pair[1])
    for t in range(longest - 2, -1, -1):
        i = begin[:alive[t + 1]] + t
        x = emit[i + 1] + back[i + 1]
        back[i] = _log_add(x[:, :1] + pair[:, 0], x[:, 1:] + pair[:, 1])
    both = ahead + back
    good = 1.0 / (1.0 + np.exp(np.clip(both[:, 0] - both[:, 1], -500, 500)))
    joint = np.zeros((n, 2, 2))
    if n > 1:
        inner = np.ones(n, bool)
        inner[begin + size - 1] = False
        i = np.flatnonzero(inner)
        j = ahead[i][:, :, None] + pair[None] + (emit[i + 1] + back[i + 1])[:, None, :]
        j = np.exp(j - j.max(axis=(1, 2), keepdims=True))
        joint[i] = j / j.sum(axis=(1, 2), keepdims=True)
    return good, joint


def fit(x: np.ndarray, length: np.ndarray, per_text: np.ndarray, label: np.ndarray, rounds: int = 2,
        steps: int = 120, penalty: float = 1e-3, rate: float = 0.15, document: np.ndarray | None = None) -> Model:
    """Maximise the penalised likelihood of the line labels by Adam steps on forward-backward gradients.

    ``document`` numbers the document of each chain; by default each is one.
    """
    document = np.arange(len(per_text)) if document is None else document
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = np.clip((x - mean) / scale, -8, 8)
    y = np.repeat(label, per_text).astype(float)
    weight, bias, pair = np.zeros(z.shape[1]), 0.0, np.zeros((2, 2))
    last = np.zeros(len(z), bool)
    last[np.cumsum(per_text) - 1] = True
    texts = max(1, len(per_text))
    for _ in range(rounds):
        seen = np.zeros((2, 2))
        a, b = y[:-1][~last[:-1]].astype(int), y[1:][~last[:-1]].astype(int)
        np.add.at(seen, (a, b), 1)
        m = v = np.zeros(z.shape[1] + 5)
        for t in range(1, steps + 1):
            good, joint = marginals(z @ weight + bias, pair, per_text)
            grad = np.concatenate([z.T @ (y - good), [(y - good).sum()], (seen - joint.sum(axis=0)).ravel()]) / texts
            grad -= penalty * np.concatenate([weight, [0.0], pair.ravel()])
            m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad ** 2
            step = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
            weight, bias, pair = weight + step[:-5], bias + step[-5], pair + step[-4:].reshape(2, 2)
        good, _ = marginals(z @ weight + bias, pair, per_text)
        y = np.where(np.repeat(label, per_text) == 1, 1.0, (good > 0.5).astype(float))
        every = np.repeat((np.bincount(np.repeat(document, per_text), 1 - y) == 0)[document], per_text)
        y[every & (np.repeat(label, per_text) == 0)] = 0.0  # a bad document keeps a bad line
    return Model(mean, scale, weight, float(bias), pair)


def score(model: Model | None, texts: list[str]) -> np.ndarray:
    """Length-weighted mean of the lines' marginals, for each whole text."""
    if model is None:
        return np.array([0.5 if t.strip() else 0.0 for t in texts])
    x, length, per_text = line_features(texts)
    z = np.clip((x - model.mean) / model.scale, -8, 8)
    good, _ = marginals(z @ model.weights + model.bias, model.pair, per_text)
    at = np.concatenate([[0], np.cumsum(per_text)[:-1]])
    total = np.add.reduceat(length, at)
    out = np.add.reduceat(good * length, at) / np.maximum(total, 1.0)
    return np.where([bool(t.strip()) for t in texts], np.clip(out, 0.0, 1.0), 0.0)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", sample: int = SAMPLE) -> Model | None:
    """Fit on about ``sample`` labelled documents, picked by a hash of the id; only their measures reach the driver."""
    known = (labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("k"))
             .agg(F.avg(F.col(label_col).cast("double")).alias("y")).where("y <> 0.5"))
    few = F.broadcast(bounded_sample(known, "k", sample))  # at most about ``sample`` rows of two numbers
    src = docs.select(F.col(id_col).alias("k"), F.col(text_col).cast("string").alias("t")).where("t <> ''").join(
        few, "k").select(F.col("k").cast("string").alias("k"), (F.col("y") > 0.5).cast("int").alias("y"), "t")
    lines = F.length("t") - F.length(F.replace(F.col("t"), F.lit("\n"), F.lit(""))) + 1
    stretches = src.agg(F.sum(F.ceil(lines / F.lit(STRETCH)))).first()[0] or 0
    share = int(min(1.0, sample / max(1, stretches)) * 2**32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, y, texts = (c.to_pylist() for c in b.columns)
            for i, j in chunked(texts):
                x, length, per_text = line_features(texts[i:j])
                rows = np.hstack([x, length[:, None]]).astype(np.float32)
                at = np.concatenate([[0], np.cumsum(per_text)])
                got = [(keys[d], y[d], rows[s:min(s + STRETCH, e)].tobytes()) for d, (a, e) in enumerate(zip(at[:-1], at[1:]), i)
                       for s in range(a, e, STRETCH) if zlib.crc32(f"{keys[d]}:{s - a}".encode()) < share]
                if got:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*got), (pa.string(), pa.int32(), pa.binary()))],
                                                     names=["k", "y", "x"])

    got = sorted((r["k"], r["y"], bytes(r["x"])) for r in map_batches(src, run, "k string, y int, x binary").collect())
    if len({y for _, y, _ in got}) < 2:
        return None
    rows = [np.frombuffer(x, np.float32).reshape(-1, 3 * OWN + 1).astype(float) for *_, x in got]
    x = np.vstack(rows)
    number = {k: i for i, k in enumerate(dict.fromkeys(k for k, *_ in got))}
    return fit(x[:, :-1], x[:, -1], np.array([len(r) for r in rows]), np.array([y for _, y, _ in got]),
               document=np.array([number[k] for k, *_ in got]))


def classify(docs: DataFrame, model: Model | None, id_cols: list[str], text_col: str = "text") -> DataFrame:
    """``id_cols`` and score, one row per row of ``docs``. The broadcast model is a few kilobytes."""
    shared = broadcast_value(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for t in b.column(b.num_columns - 1).to_pylist()]
            got = [score(shared.value, texts[i:j]) for i, j in chunked(texts)]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(np.concatenate(got) if got else np.zeros(0))],
                                             names=[*b.schema.names[:-1], "score"])

    src = docs.select(*[F.col(c) for c in id_cols], F.col(text_col).cast("string").alias("__text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1])
    return map_batches(src, run, f"{fields}, score double")
