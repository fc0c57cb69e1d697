"""Spelling variants: words at one inserted, deleted or replaced code point, by pairs of trie nodes.

1. Words are counted over whole texts; each task adds up its own first.
2. Sorted words are walked in ranges of the vocabulary, once as they are and once
   reversed. A word shares the nodes of its common prefix with the word before it
   and opens new ones for the rest, so the nodes of a forward and of a reversed
   trie get numbers without a trie being held anywhere. Where a range begins in the
   middle of a prefix, a table of one row per range gives the nodes to go on with.
3. A word of length L gives L pairs (prefix node, suffix node) that skip one position
   and L + 1 that skip none, where a code point could be inserted. Words that skip a
   position to the same pair differ in that code point only; a word that skips none
   lacks the skipped one. A pair holds at most one word per code point of the
   alphabet and one that skips none, so no key can grow with the corpus.
4. Each word keeps its number of near words and the best of them; forms are
   followed to their roots by doubling.

Defined cases: null and empty texts have no words; a null id counts as empty text
where words are damaged on purpose; repeated rows count again; ties go to the word
that is smaller in code-point order; an empty table gives no rows. Columns of the
caller other than id and text are not looked at.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from os.path import commonprefix
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shuffle_partitions
from .common import broadcast_value, map_batches, reliable, text_or_empty

#: Runs counted at once in a task before they go on to Spark.
HELD = 400_000
#: Rows of pairs looked at together; a group of one pair is never cut.
ROWS = 1 << 18
SKIPS_NONE, SKIPS, SKIPS_EARLIER = 0, 1, 2


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 7,
                min_count: int = 2, damage: int | None = None) -> DataFrame:
    """(word, n): runs of letters of at least ``min_length`` code points that occur ``min_count`` times or more.

    With ``damage``, a run whose crc32 with its document's id is divisible by it loses one code point first: a
    known share of misspellings.
    """
    runs = re.compile("[a-zÀ-ÿ]{%d,}" % min_length)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for key, text in zip(*(c.to_pylist() for c in batch.columns)):
                found = runs.findall(text.encode().lower().decode())  # of bytes, lower() is A-Z only
                if damage is None:
                    total.update(found)
                    continue
                seed = crc32(f"{key}:".encode())
                for run, n in Counter(found).items():
                    h = crc32(run.encode(), seed)
                    if h % damage == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1:]
                        if len(run) < min_length:
                            continue
                    total[run] += n
            if len(total) > HELD:
                yield _counted(total)
                total = Counter()
        if total:
            yield _counted(total)

    texts = docs.select(text_or_empty(F.col(id_col)).alias("id"), text_or_empty(F.col(text_col)).alias("text"))
    return (map_batches(texts, count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= min_count))


def _counted(total: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())],
                                      ["word", "n"])


def _number(keys: DataFrame) -> DataFrame:
    """(part, key, n, path): nodes of every prefix of each key, numbered within its range of the sorted keys.

    The root is 0. A key opens the nodes ``before + depth`` past its common prefix with the key before it, where
    ``before`` is the length of all earlier keys together; so numbers follow the order of the keys.
    """
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, path, before = "", [0], 0
        for batch in batches:
            paths = []
            for key in batch.column(1).to_pylist():
                shared = len(commonprefix((last, key)))
                path = path[:shared + 1] + list(range(before + shared + 1, before + len(key) + 1))
                before += len(key)
                last = key
                paths.append(path)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(paths, pa.list_(pa.int64()))], ["part", "key", "n", "path"])

    ranges = (keys.repartitionByRange(shuffle_partitions(keys.sparkSession), "key").sortWithinPartitions("key")
              .select(F.spark_partition_id().alias("part"), "key", "n"))
    return reliable(map_batches(ranges, walk, "part int, key string, n long, path array<long>"))


def _borders(numbered: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """For each range, what its numbers are raised by, and the nodes that it shares with the range before it.

    One row per range comes to the driver.
    """
    rows = numbered.groupBy("part").agg(F.min("key").alias("first"), F.max("key").alias("last"),
                                        F.max_by("path", "key").alias("path")).orderBy("part").collect()
    out: dict[int, tuple[int, list[int]]] = {}
    last, path, base = "", [0], 0
    for r in rows:
        shared = path[:len(commonprefix((last, r["first"]))) + 1]
        out[r["part"]] = base, shared
        # numbers up to the length of the first key are its own path
        path = [shared[x] if x < len(shared) else base + x for x in r["path"]]
        last, base = r["last"], path[-1]
    return out


class _Raise:
    """Turns numbers within ranges into numbers of the whole trie."""

    def __init__(self, borders: dict[int, tuple[int, list[int]]]):
        n = max(borders, default=0) + 1
        self.base, self.shares, self.at = (np.zeros(n, np.int64) for _ in range(3))
        self.nodes = np.array([x for _, shared in borders.values() for x in shared], np.int64)
        at = 0
        for part, (base, shared) in borders.items():
            self.base[part], self.shares[part], self.at[part] = base, len(shared), at
            at += len(shared)

    def __call__(self, part: np.ndarray, x: np.ndarray) -> np.ndarray:
        out = self.base[part] + x
        old = np.flatnonzero(x < self.shares[part])
        out[old] = self.nodes[self.at[part[old]] + x[old]]
        return out


def _pairs(words: list[str], n: np.ndarray, prefix: np.ndarray, suffix: np.ndarray) -> tuple[np.ndarray, ...]:
    """Rows (p, s, id, n, how) of words whose prefix and suffix nodes (by length, root first) lie one after another."""
    size = np.array([len(w) for w in words], np.int64)
    first = np.concatenate([[0], np.cumsum(size + 1)])
    word = np.repeat(np.arange(len(words)), size + 1)
    at = np.arange(first[-1]) - first[word]
    other = first[word] + size[word] - at  # the suffix that begins where the prefix ends
    leaf = prefix[first[1:] - 1]
    inside = np.flatnonzero(at < size[word])
    cp = np.frombuffer("\0".join(words).encode("utf-32-le") + b"\0\0\0\0", np.uint32)
    same = cp[inside] == cp[inside + 1]
    how = np.concatenate([np.full(len(word), SKIPS_NONE, np.int8), np.where(same, SKIPS_EARLIER, SKIPS).astype(np.int8)])
    both = np.concatenate([word, word[inside]])
    return (np.concatenate([prefix, prefix[inside]]), np.concatenate([suffix[other], suffix[other[inside] - 1]]),
            leaf[both], n[both], how)


def _near(p: np.ndarray, s: np.ndarray, ids: np.ndarray, n: np.ndarray, how: np.ndarray) -> tuple[np.ndarray, ...]:
    """(id, near, best_n, best) from rows sorted by pair: what each word meets in its group.

    Of a run of equal letters only the last is a deletion, so two words meet once.
    """
    group = np.concatenate([[0], np.cumsum((p[1:] != p[:-1]) | (s[1:] != s[:-1]))])[:len(p)]
    keep = np.flatnonzero(np.bincount(group)[group] > 1)
    group, ids, n, how = group[keep], ids[keep], n[keep], how[keep]
    order = np.lexsort((ids, -n, how == SKIPS_NONE, group))
    group, ids, n, how = group[order], ids[order], n[order], how[order]
    if not len(group):
        return (np.zeros(0, np.int64),) * 4
    start = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    g = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(group))))
    skip = how != SKIPS_NONE
    skips = np.bincount(g, skip, len(start)).astype(np.int64)
    # replaced: all words that skip, the best first
    x = np.flatnonzero(skip & (skips[g] > 1))
    lead = start[g[x]]
    best = np.where(x == lead, lead + 1, lead)
    out = [(ids[x], skips[g[x]] - 1, n[best], ids[best])]
    # the word that skips none is the last of its group; the others, with the skipped code point, are its insertions
    end = np.append(start[1:], len(group)) - 1
    whole = ~skip[end]
    x = np.flatnonzero((how == SKIPS) & whole[g])
    out.append((ids[x], np.ones(len(x), np.int64), n[end[g[x]]], ids[end[g[x]]]))
    told, best = np.unique(g[x], return_index=True)
    out.append((ids[end[told]], np.bincount(g[x], minlength=len(start))[told], n[x[best]], ids[x[best]]))
    return tuple(np.concatenate(c) for c in zip(*out))


def neighbours(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(id, word, n) of distinct ``words`` (word, n), and (id, n_near, best_n, best) of those that have near words.

    Ids follow the code-point order of the words.
    """
    spark = words.sparkSession
    forward = _number(words.select(F.col("word").alias("key"), "n"))
    back = _number(words.select(F.reverse("word").alias("key"), "n"))
    ends = _borders(forward), _borders(back)
    raises = broadcast_value(spark, tuple(_Raise(b) for b in ends))
    bases = spark.createDataFrame([(k, b) for k, (b, _) in ends[0].items()], "part int, base long")
    dictionary = forward.join(F.broadcast(bases), "part").select(
        (F.col("base") + F.element_at("path", -1)).alias("id"), F.col("key").alias("word"), "n")

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up, down = raises.value
        for batch in batches:
            if not batch.num_rows:
                continue
            word, n, f_part, f_path, b_part, b_path = batch.columns
            size = np.diff(f_path.offsets.to_numpy())
            flat = [r(np.repeat(part.to_numpy(), size), path.flatten().to_numpy())
                    for r, part, path in ((up, f_part, f_path), (down, b_part, b_path))]
            cols = _pairs(word.to_pylist(), n.to_numpy(), *flat)
            for at in range(0, len(cols[0]), ROWS):  # a very long word has many pairs
                yield pa.RecordBatch.from_arrays([pa.array(c[at:at + ROWS]) for c in cols], ["p", "s", "id", "n", "how"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        rows = 0

        def told(cols: tuple[np.ndarray, ...]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c) for c in _near(*cols)], ["id", "near", "best_n", "best"])

        for batch in batches:
            held.append(tuple(c.to_numpy() for c in batch.columns))
            rows += batch.num_rows
            if rows >= ROWS:
                cols = tuple(np.concatenate(c) for c in zip(*held))
                last = (cols[0] == cols[0][-1]) & (cols[1] == cols[1][-1])  # the last group may go on
                yield told(tuple(c[~last] for c in cols))
                held, rows = [tuple(c[last] for c in cols)], int(last.sum())
        if rows:
            yield told(tuple(np.concatenate(c) for c in zip(*held)))

    f = forward.select(F.col("key").alias("word"), "n", F.col("part").alias("f_part"), F.col("path").alias("f_path"))
    b = back.select(F.reverse("key").alias("word"), F.col("part").alias("b_part"), F.col("path").alias("b_path"))
    pairs = map_batches(f.join(b, "word"), pair, "p long, s long, id long, n long, how tinyint")
    met = map_batches(pairs.repartition("p", "s").sortWithinPartitions("p", "s"), meet, "id long, near long, best_n long, best long")
    best = F.max(F.struct(F.col("best_n"), (-F.col("best")).alias("low")))
    near = (met.groupBy("id").agg(F.sum("near").alias("n_near"), best.alias("b"))
            .select("id", "n_near", F.col("b.best_n").alias("best_n"), (-F.col("b.low")).alias("best")))
    return dictionary, near


def group_variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """word, form, root, n, n_near, form_n of each of the distinct ``words`` (word, n).

    ``form`` is the near word of largest n, if that is at least ``ratio`` times the word's own (``ratio`` > 1). Each
    step to a form multiplies n by ``ratio``, which bounds the way to the root, whatever the corpus.
    """
    dictionary, near = neighbours(reliable(words))
    known = reliable(dictionary.join(near, "id", "left"))
    form = F.col("best_n") >= F.lit(ratio) * F.col("n")
    roots = known.where(form).select("id", F.col("best").alias("form"), F.col("best_n").alias("form_n"), F.col("best").alias("root"))
    most = known.agg(F.max("n")).first()[0] or 1
    for _ in range(math.ceil(math.log2(max(1.0, math.log(most, ratio))))):
        onward = roots.select(F.col("id").alias("root"), F.col("root").alias("far"))
        roots = reliable(roots.join(onward, "root", "left").select("id", "form", "form_n", F.coalesce("far", "root").alias("root")))
    names = known.select("id", "word")
    named = (roots.join(names.select(F.col("id").alias("form"), F.col("word").alias("form_word")), "form")
             .join(names.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root")
             .select("id", "form_word", "root_word", "form_n"))
    return known.join(named, "id", "left").select(
        "word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
