"""Phrase collocations: Apriori candidates counted by double-array tries over all text positions at once.

1. Words and their numbers are counted per language. Words below the least count
   can't be in a phrase; the others get numbers, the most frequent first, in blocks
   of ``WORDS`` that are looked up one after another. Texts become arrays of these
   numbers, -1 standing for rarer words and the ends of pieces.
2. Phrases of two words and more are hashed into counters, ``1 << SKETCH_BITS`` a length
   and more of them in larger corpora; they stop at 255 and are added up by Spark. A phrase whose counter stays below
   the least count can't be frequent, nor can one that holds such a phrase: what is
   left are the candidates, safe by Apriori (a superset of the frequent phrases).
3. At each position the longest candidate that begins there makes a window; its
   beginnings are the other candidates there. Windows are dealt by their first two words into parts, equal ones as one
   with a count. Of a part's candidates double-array tries are made (of ``PHRASES`` each), and numpy moves the states of
   all its windows a digit of a word on at a time; ``bincount`` adds up the windows of the states that accept. These counts are exact
   whatever the counters let through, and each position is gone through once, however many candidates there are.
4. Scores, containment and ranks are joins and aggregates over the frequent phrases.

Defined cases: a null text is empty, a null language is ``und``; repeated rows count
again; words may be any code points but blanks, tabs and the marks that end a piece;
a language without candidates gives no rows, as does an empty table. Columns of the
caller other than text and language are not looked at.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textkit as tk
from .common import broadcast_value, chunked, map_batches, reliable, text_or_empty

MAX_WORDS = 4
#: Words of one table of numbers, and candidates of one trie.
WORDS = 1 << 20
PHRASES = 1 << 19
#: Counters a length: one for some 16 words of the corpus, between these powers of two. Their bitmaps are broadcast: 96 MB at most.
SKETCH_BITS, MOST_BITS = 24, 28
#: Distinct words a task counts before they go on to Spark, and positions of a chunk of encoded text.
HELD = 400_000
POSITIONS = 1 << 21
#: Bits of a digit of a word's number, the alphabet of a trie.
BITS = 7
_PART = 1 << 16  # counters of a row
_ROW = 1 << 18  # word numbers of a row, or as many more as its last piece has
_MARKS = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz .........")


def words_of(texts: list[str]) -> list[bytes]:
    """Words of the texts in turn; ``.`` stands for every end of a piece or text."""
    return b" . ".join(t.encode().translate(_MARKS).replace(b".", b" . ") for t in texts).split()


def _by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, list[str]]]:
    """Chunks of the texts of one language."""
    texts: dict[str, list[str]] = {}
    for lang, text in zip(*(c.to_pylist() for c in batch.columns)):
        texts.setdefault(lang, []).append(text)
    for lang, those in texts.items():
        for a, b in chunked(those):
            yield lang, those[a:b]


def count_words(texts: DataFrame) -> DataFrame:
    """(lang, word, n) of all words of ``texts`` (lang, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, Counter] = {}

        def told() -> Iterator[pa.RecordBatch]:
            for lang, total in totals.items():
                total.pop(b".", None)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(total), pa.string()), pa.array([w.decode() for w in total], pa.string()),
                                                  pa.array(list(total.values()), pa.int64())], ["lang", "word", "n"])
            totals.clear()

        for batch in batches:
            for lang, those in _by_language(batch):
                totals.setdefault(lang, Counter()).update(words_of(those))
            if sum(map(len, totals.values())) > HELD:
                yield from told()
        yield from told()

    return map_batches(texts, run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _numbered(frequent: DataFrame) -> tuple[DataFrame, int]:
    """(lang, word, n, id) and how many: ids from 0 without gaps, in the order of the range-sorted (n descending) words."""
    part = reliable(frequent.repartitionByRange(F.col("n").desc(), "lang", "word").sortWithinPartitions(F.col("n").desc(), "lang", "word")
                    .select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place")))
    sizes = part.groupBy("part").agg(F.count(F.lit(1)).alias("rows"), F.min("place").alias("first")).orderBy("part").collect()
    starts, total = [], 0
    for r in sizes:
        starts.append((r["part"], total - r["first"]))
        total += r["rows"]
    starts_df = part.sparkSession.createDataFrame(starts, "part int, shift long")
    return part.join(F.broadcast(starts_df), "part").select("lang", "word", "n", (F.col("place") + F.col("shift")).cast("int").alias("id")), total


def encode(texts: DataFrame, vocabulary: DataFrame, size: int) -> DataFrame:
    """(ids): arrays of the texts' words as numbers (int32), one or more rows a batch, each ended by -1.

    Runs of -1 are one; vocabularies beyond ``WORDS`` are looked up block by block, the distinct words of some 2 million at once.
    """
    spark = texts.sparkSession
    blocks = []
    for low in range(0, size, WORDS):
        rows = vocabulary.where((F.col("id") >= low) & (F.col("id") < low + WORDS)).select("lang", "word", "id").toArrow()
        blocks.append(broadcast_value(spark, rows.combine_chunks()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[tuple[pa.Array, np.ndarray]]] = {}
        held: dict[str, list[pa.Array]] = {}

        def told() -> Iterator[pa.RecordBatch]:
            for lang, those in held.items():
                if lang not in known:
                    known[lang] = [w for b in blocks if len((w := _lookup(b.value, lang))[1])]
                found = pa.concat_arrays(those).dictionary_encode()
                number = np.full(len(found.dictionary), -1, np.int32)
                for words, ids in known[lang]:
                    at = pc.fill_null(pc.index_in(found.dictionary, value_set=words), -1).to_numpy()
                    number[at >= 0] = ids[at[at >= 0]]
                ids = number[found.indices.to_numpy()]
                ids = ids[(ids >= 0) | np.concatenate([[False], ids[:-1] >= 0])]
                ends = np.flatnonzero(ids < 0) + 1
                for row in np.split(ids, np.unique(ends[np.searchsorted(ends, np.arange(_ROW, len(ids), _ROW))])):
                    if len(row):
                        yield pa.RecordBatch.from_arrays([pa.array([row.tobytes()], pa.binary())], ["ids"])
            held.clear()

        size = 0
        for batch in batches:
            for lang, those in _by_language(batch):
                found = words_of(those)
                found.append(b".")  # is no word
                held.setdefault(lang, []).append(pa.array(found, pa.binary()))
                size += len(found)
                if size >= POSITIONS:
                    yield from told()
                    size = 0
        yield from told()

    return map_batches(texts, run, "ids binary")


def _lookup(table: pa.Table, lang: str) -> tuple[pa.Array, np.ndarray]:
    """Words of a language and their numbers."""
    rows = table.filter(pc.equal(table.column("lang"), lang)).combine_chunks()
    words = rows.column("word").cast(pa.binary())
    return words.combine_chunks() if isinstance(words, pa.ChunkedArray) else words, rows.column("id").to_numpy()


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Encoded texts in chunks of about ``POSITIONS``, ended by enough -1 to look ahead."""
    held, size = [], 0
    for batch in batches:
        for x in batch.column(0):
            held.append(np.frombuffer(x.as_buffer(), np.int32))
            size += len(held[-1])
            if size >= POSITIONS:
                yield np.concatenate([*held, np.full(MAX_WORDS, -1, np.int32)])
                held, size = [], 0
    if size:
        yield np.concatenate([*held, np.full(MAX_WORDS, -1, np.int32)])


def _hashes(ids: np.ndarray, bits: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each length from 2 the positions where a phrase of frequent words begins, and its counter."""
    at = np.flatnonzero(ids >= 0)
    h = tk.mix(ids[at].astype(np.uint64) + np.uint64(1))
    for k in range(2, MAX_WORDS + 1):
        on = ids[at + k - 1] >= 0
        at, h = at[on], h[on]
        with np.errstate(over="ignore"):
            h = tk.mix(h * np.uint64(31) + ids[at + k - 1].astype(np.uint64) + np.uint64(k))
        yield k, at, (h >> np.uint64(64 - bits)).astype(np.uint32)


def _sketch(encoded: DataFrame, least: int, bits: int) -> dict[int, np.ndarray]:
    """For each length a packed bitmap of the counters that reach ``least`` (at most 255). Counters travel in rows of 64 K."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {k: [] for k in range(2, MAX_WORDS + 1)}

        def told() -> Iterator[pa.RecordBatch]:
            for k, those in held.items():
                if not those:
                    continue
                h = np.sort(np.concatenate(those))
                those.clear()
                first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
                n = np.minimum(255, np.diff(np.append(first, len(h)))).astype(np.uint8)
                h = h[first]
                ends = [0, *(np.flatnonzero(np.diff(h // _PART)) + 1).tolist(), len(h)]
                parts, rows, size = [], [], 0
                for a, b in zip(ends, ends[1:]):
                    # dense, or the places and counts of those above 0, if that is shorter
                    if 3 * (b - a) >= _PART:
                        row = np.zeros(_PART, np.uint8)
                        row[h[a:b] % _PART] = n[a:b]
                        rows.append(row.tobytes())
                    else:
                        rows.append((h[a:b] % _PART).astype(np.uint16).tobytes() + n[a:b].tobytes())
                    parts.append(int(h[a]) // _PART)
                    size += len(rows[-1])
                    if size > 1 << 20 or b == len(h):
                        yield pa.RecordBatch.from_arrays([pa.array([k] * len(rows), pa.int32()), pa.array(parts, pa.int32()),
                                                          pa.array(rows, pa.binary())], ["k", "part", "counters"])
                        parts, rows, size = [], [], 0

        size = 0
        for ids in _chunks(batches):
            for k, _, h in _hashes(ids, bits):
                if len(h):
                    held[k].append(h)
            size += len(ids)
            if size > 2 * POSITIONS:
                yield from told()
                size = 0
        yield from told()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows come sorted by (k, part); one row of counters is held
        now, total = None, np.zeros(_PART, np.uint16)
        for batch in batches:
            for k, part, counters in zip(*(c.to_pylist() for c in batch.columns)):
                if now is not None and now != (k, part):
                    yield _bits(now, total >= least)
                    total = np.zeros(_PART, np.uint16)
                now = k, part
                if len(counters) == _PART:
                    total = np.minimum(255, total + np.frombuffer(counters, np.uint8))
                else:
                    met = np.frombuffer(counters, np.uint16, len(counters) // 3)
                    total[met] = np.minimum(255, total[met] + np.frombuffer(counters, np.uint8, len(met), 2 * len(met)))
        if now is not None:
            yield _bits(now, total >= least)

    rows = map_batches(encoded, run, "k int, part int, counters binary").repartition("k", "part").sortWithinPartitions("k", "part")
    out = {k: np.zeros((1 << bits) // 8, np.uint8) for k in range(2, MAX_WORDS + 1)}
    width = _PART // 8
    for batch in map_batches(rows, add, "k int, part int, bits binary").toArrow().to_batches():
        for k, part, told in zip(*batch.columns):
            out[k.as_py()][part.as_py() * width:(part.as_py() + 1) * width] = np.frombuffer(zlib.decompress(told.as_buffer()), np.uint8)
    return out


def _bits(place: tuple[int, int], passed: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([place[0]], pa.int32()), pa.array([place[1]], pa.int32()),
                                       pa.array([zlib.compress(np.packbits(passed).tobytes(), 1)], pa.binary())], ["k", "part", "bits"])


_W = [f"w{i}" for i in range(1, MAX_WORDS + 1)]
_IDS = ", ".join(f"{w} int" for w in _W)


def _windows(ids: np.ndarray, passed: dict[int, np.ndarray], bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct (w1, ..., w4), -1 past the end, and at how many positions each is the longest candidate that begins there.

    Candidates are phrases all of whose parts may reach the least count by the counters.
    """
    def told(k: int, at: np.ndarray, once: np.ndarray, of: np.ndarray, longer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        times = np.bincount(of[~longer[at]], minlength=len(once))
        met = np.flatnonzero(times)
        rows = np.full((len(met), MAX_WORDS), -1, np.int32)
        for i in range(k):
            rows[:, i] = ids[at[once[met]] + i]
        return rows, times[met]

    good = ids >= 0  # begins a phrase of k - 1 words that may be frequent
    rank = ids  # of the phrase of k - 1 words that begins here
    last = None
    for k, at, h in _hashes(ids, bits):
        ok = (passed[k][h >> 3] >> (7 - (h & 7)).astype(np.uint8)) & 1 > 0
        at = at[ok]
        at = at[good[at] & good[at + 1]]  # both parts are safe
        good = np.zeros(len(ids), bool)
        good[at] = True
        if last is not None:
            yield told(*last, good)
        _, once, of = np.unique(rank[at].astype(np.int64) << 32 | ids[at + k - 1], return_index=True, return_inverse=True)
        rank = np.zeros(len(ids), np.int32)
        rank[at] = of
        last = k, at, once, of
    yield told(*last, np.zeros(len(ids), bool))


def _summed(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows, those that begin alike side by side, and the sums of their counts."""
    rows, times = (np.concatenate(x) for x in zip(*held))
    if not len(rows):
        return rows, times
    a = rows[:, 0].astype(np.int64) << 32 | rows[:, 1]
    b = rows[:, 2].astype(np.int64) << 32 | rows[:, 3].astype(np.int64) & 0xFFFFFFFF
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
    return rows[order[first]], np.add.reduceat(times[order], first)


def _distinct(rows: np.ndarray) -> np.ndarray:
    return _summed([(rows, np.ones(len(rows), np.int64))])[0]


def _rows(rows: np.ndarray, *more: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*(pa.array(np.ascontiguousarray(c)) for c in rows.T), *more], _W + ["f"][:len(more)])


class Trie:
    """A double-array trie over phrases (rows of word numbers, -1 past the end).

    The state after the first word is that word's rank among the first words. Later words are read digit by
    digit: from state s, digit d leads to ``base[s] + d`` if ``check`` there is s.
    """

    def __init__(self, phrases: np.ndarray):
        phrases = _distinct(phrases)
        self.digits = max(1, -(-int(phrases.max()).bit_length() // BITS))
        self.heads = np.unique(phrases[:, 0])
        self.first = np.full(self.heads[-1] + 2, -1, np.int32)
        self.first[self.heads] = np.arange(len(self.heads))
        digits = phrases[:, 1:].astype(np.int64)
        shift = BITS * np.arange(self.digits - 1, -1, -1)
        steps = np.where(digits[:, :, None] < 0, -1, (digits[:, :, None] >> shift) & ((1 << BITS) - 1)).reshape(len(phrases), -1)
        state = np.searchsorted(self.heads, phrases[:, 0])  # of a node, before it is placed
        edges = []  # (parent node, digit, child node)
        nodes = len(self.heads)
        for step in steps.T:
            on = step >= 0
            key = state[on] << BITS | step[on]
            unique, child = np.unique(key, return_inverse=True)
            edges.append((unique >> BITS, unique & ((1 << BITS) - 1), nodes + np.arange(len(unique))))
            state[on] = nodes + child
            nodes += len(unique)
        parent, digit, child = (np.concatenate(c) for c in zip(*edges))
        place = self._place(parent, digit, child, nodes)
        self.phrases = phrases
        self.accepts = np.full(len(self.base), -1, np.int32)
        self.accepts[place[state]] = np.arange(len(phrases))

    def _place(self, parent: np.ndarray, digit: np.ndarray, child: np.ndarray, nodes: int) -> np.ndarray:
        """Slots of all nodes; those with the most children first, then whole rounds of random tries, then only children."""
        rng = np.random.default_rng(7)
        order = np.lexsort((digit, parent))
        parent, digit, child = parent[order], digit[order], child[order]
        owner, first, count = np.unique(parent, return_index=True, return_counts=True)
        heads, width = len(self.heads), 1 << BITS
        large = count > 6
        middle = (count > 1) & ~large
        slots = heads + width * int(large.sum())
        end = slots + 3 * int(count[middle].sum()) + int((count == 1).sum()) + 2 * width
        taken = np.zeros(end, bool)
        taken[:heads] = True
        base = np.zeros(len(owner), np.int64)
        base[large] = heads + width * np.arange(int(large.sum()))  # a stretch of their own
        rank = np.repeat(np.arange(len(owner)), count)  # the owner of each edge
        on = large[rank]
        taken[base[rank[on]] + digit[on]] = True
        todo = np.flatnonzero(middle)
        while len(todo):
            base[todo] = rng.integers(slots, end - width, len(todo))
            edge = np.concatenate([first[todo] + i for i in range(2)] + [first[todo][count[todo] > i] + i for i in range(2, 7)])
            who = np.concatenate([todo] * 2 + [todo[count[todo] > i] for i in range(2, 7)])
            at = base[who] + digit[edge]
            _, once, times = np.unique(at, return_inverse=True, return_counts=True)
            bad = np.unique(who[taken[at] | (times[once] > 1)])
            fine = ~np.isin(who, bad)
            taken[at[fine]] = True
            todo = bad
        only = np.flatnonzero(count == 1)
        free = heads + np.flatnonzero(~taken[heads:])[:len(only)]
        base[only] = free - digit[first[only]]
        at = base[rank] + digit
        place = np.empty(nodes, np.int64)
        place[:heads] = np.arange(heads)
        place[child] = at
        self.base = np.full(end, -1 - width, np.int32)  # a state without children leads nowhere
        self.check = np.full(end + width, -1, np.int32)
        self.base[place[owner]] = base
        self.check[at] = place[parent]
        return place

    def count(self, ids: np.ndarray, at: np.ndarray | None = None, times: np.ndarray | None = None) -> np.ndarray:
        """How often each phrase begins at a position of ``ids``, or at those of ``at``, which count ``times`` each."""
        at = np.arange(len(ids)) if at is None else at
        state = self.first[np.minimum(ids[at], len(self.first) - 1)]  # the last one, -1 too, is no head
        on = state >= 0
        total = np.zeros(len(self.phrases), np.int64)
        times = np.ones(len(at), np.int64) if times is None else times
        at, state, times = at[on], state[on], times[on]
        for k in range(1, MAX_WORDS):
            word = ids[at + k]
            on = word >= 0
            at, state, word, times = at[on], state[on], word[on], times[on]
            for shift in range(BITS * (self.digits - 1), -1, -BITS):
                to = self.base[state] + ((word >> shift) & ((1 << BITS) - 1))
                on = (to >= 0) & (self.check[to] == state)
                at, state, word, times = at[on], to[on], word[on], times[on]
            phrase = self.accepts[state]
            on = phrase >= 0
            total += np.bincount(phrase[on], times[on], len(total)).astype(np.int64)  # exact up to 2 ** 53
        return total


def _frequent(rows: np.ndarray, times: np.ndarray, least: int, most: int) -> Iterator[pa.RecordBatch]:
    """Phrases that occur ``least`` times or more, of a part's windows (distinct, those that begin alike side by side).

    A trie takes ``most`` candidates.
    """
    found = []
    for k in range(2, MAX_WORDS + 1):
        begin = rows[rows[:, k - 1] >= 0].copy()
        begin[:, k:] = -1
        found.append(begin[np.concatenate([[True], (begin[1:] != begin[:-1]).any(axis=1)])] if len(begin) else begin)
    phrases = np.concatenate(found)
    ids, at = rows.ravel(), MAX_WORDS * np.arange(len(rows))
    for low in range(0, len(phrases), most):
        trie = Trie(phrases[low:low + most])
        total = trie.count(ids, at, times)
        met = np.flatnonzero(total >= least)
        for some in np.split(met, range(_PART, len(met), _PART)):
            yield _rows(trie.phrases[some], pa.array(total[some]))


def count_phrases(encoded: DataFrame, least: int, words: int) -> DataFrame:
    """(w1, ..., w4, f): exact counts of the phrases that occur ``least`` times or more in texts of so many words.

    Tasks send their windows as sorted arrays, one for each part (by the first two words) that they meet.
    """
    parts, block = max(64, words >> 21), PHRASES
    bits = min(MOST_BITS, max(SKETCH_BITS, (words >> 4).bit_length()))
    passed = broadcast_value(encoded.sparkSession, _sketch(encoded, min(least, 255), bits))

    def send(held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        rows, times = _summed(held)
        part = (tk.mix(rows[:, 0].astype(np.uint64) << np.uint64(32) | rows[:, 1].astype(np.uint64)) % np.uint64(parts)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        for those in np.split(order, np.flatnonzero(np.diff(part[order])) + 1) if len(order) else []:
            table = np.ascontiguousarray(rows[those].T).tobytes() + times[those].astype(np.int64).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([part[those[0]]], pa.int32()), pa.array([zlib.compress(table, 1)], pa.binary())],
                                             ["part", "windows"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for ids in _chunks(batches):
            held.extend(_windows(ids, passed.value, bits))
            size = sum(len(x) for x, _ in held)
            if size > 4 * HELD:
                yield from send(held)
                held, size = [], 0
        if size:
            yield from send(held)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows come sorted by part; one part's windows are held, equal ones put together each time they have doubled
        now, held, size, most = None, [], 0, 0
        for batch in batches:
            for part, table in zip(*(c.to_pylist() for c in batch.columns)):
                if part != now and held:
                    yield from _frequent(*_summed(held), least, block)
                    held, size, most = [], 0, 0
                now = part
                table = zlib.decompress(table)
                n = len(table) // (4 * MAX_WORDS + 8)
                held.append((np.frombuffer(table, np.int32, MAX_WORDS * n).reshape(MAX_WORDS, -1).T,
                             np.frombuffer(table, np.int64, n, 4 * MAX_WORDS * n)))
                size += n
                if size > max(2 * most, _PART):
                    held = [_summed(held)]
                    size = most = len(held[0][0])
        if held:
            yield from _frequent(*_summed(held), least, block)

    sent = map_batches(encoded, run, "part int, windows binary").repartition("part").sortWithinPartitions("part")
    return map_batches(sent, count, f"{_IDS}, f long")


def _part(low: int, size: int) -> list:
    """Words ``low`` to ``low + size`` of a phrase, as a phrase."""
    return [F.col(_W[low + i]) if i < size else F.lit(-1) for i in range(MAX_WORDS)]


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 30,
                 scale: int = 2_000_000, covered: int = 80, top: int | None = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: phrases of 2 to 4 words that occur ``least`` times or more in a language.

    The lowest floor(scale * a / (l + r)) over all cuts into two parts is the score (the first cut, if several).
    A phrase inside a longer one with at least ``covered`` percent of its count is dropped. ``top`` is the
    length of the report (None: all).
    """
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), text_or_empty(F.col(text_col)).alias("text"))
    counted = reliable(count_words(texts))
    totals = counted.groupBy("lang").agg(F.sum("n").alias("total"))
    total = counted.agg(F.sum("n")).first()[0] or 0
    vocabulary, size = _numbered(counted.where(F.col("n") >= least))
    vocabulary = reliable(vocabulary)
    encoded = reliable(encode(texts, vocabulary, size))
    phrases = reliable(count_phrases(encoded, least, total))
    length = sum(F.when(F.col(w) >= 0, 1).otherwise(0) for w in _W)
    words = vocabulary.select(F.col("id").alias("w1"), *[F.lit(-1).alias(w) for w in _W[1:]], F.col("n").alias("f"))
    f = words.unionByName(phrases)
    sized = phrases.withColumn("size", length)

    # every cut of every phrase, met with the counts of its two parts
    cuts = None
    held = None
    for size_ in range(2, MAX_WORDS + 1):
        of = sized.where(F.col("size") == size_)
        for k in range(1, size_):
            cut = of.select(*_W, "f", F.lit(k).alias("k"), F.struct(*_part(0, k)).alias("left"), F.struct(*_part(k, size_ - k)).alias("right"))
            cuts = cut if cuts is None else cuts.unionAll(cut)
        for part in range(2, size_):
            for low in range(size_ - part + 1):
                inner = of.select(*[c.alias(w) for c, w in zip(_part(low, part), _W)], "f")
                held = inner if held is None else held.unionAll(inner)
    key = F.struct(*[F.col(w) for w in _W])
    left = f.select(key.alias("left"), F.col("f").alias("l"))
    right = f.select(key.alias("right"), F.col("f").alias("r"))
    big = "decimal(38,0)"
    cuts = cuts.join(left, "left").join(right, "right").withColumn(
        "score", F.expr(f"(cast({scale} as decimal(18,0)) * cast(f as decimal(19,0))) div (cast(l as {big}) + cast(r as {big}))"))
    best = cuts.groupBy(*_W).agg(F.min(F.struct("score", "k", F.col("f").alias("a"), "l", "r")).alias("b"))
    longest = held.groupBy(*_W).agg(F.max("f").alias("longer"))
    kept = (best.join(longest, _W, "left")
            .where(F.col("longer").isNull() | (F.col("longer").cast("decimal(19,0)") * 100 < F.col("b.a").cast("decimal(19,0)") * covered)))

    # words of what is left
    spelled = (kept.select(*_W, "b", F.posexplode(F.array(*_W)).alias("at", "id")).where("id >= 0")
               .join(vocabulary.select("id", "lang", "word"), "id")
               .groupBy(*_W).agg(F.first("lang").alias("lang"), F.first("b").alias("b"),
                                 F.sort_array(F.collect_list(F.struct("at", "word"))).alias("words"))
               .select("lang", F.concat_ws(" ", F.col("words.word")).alias("phrase"), "b.*"))
    ranked = spelled.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))).cast("long"))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", *[F.col(c).cast("long").alias(c) for c in ("a", "l", "r")],
                                              F.col("total").cast("long").alias("n"), F.col("score").cast("long").alias("score"))
