"""Benchmark decontamination by the q-gram lemma.

A passage of ``m`` characters that occurs with at most ``k`` edits shares at
least ``m + 1 - q - k * q`` of its q-grams with the place where it occurs, on
diagonals that differ by at most ``k``. Shared q-grams are counted in overlapping
bands of diagonals; a band that reaches the bound is verified by banded
alignment. Text and passages are compared as lower-case letters and digits with
one space between words. Items longer than ``WHOLE`` characters are searched as
overlapping windows, and every item also as pieces of ``PIECE`` words, one every
``PIECE_STEP`` words: any ``RUN`` = 13 words of an item in a row hold a whole piece
and are found, verbatim or with the same share of edits in that piece. A word of
more than ``LONG_WORD`` characters (script without spaces) counts as one word for
each ``LONG_WORD`` characters begun. Items shorter than ``MIN_CHARS`` are found
where they stand verbatim, on word bounds.

The benchmark is handled in blocks of bounded size, each broadcast against all
documents; no text is shuffled.

Defined cases: null or empty texts and items match nothing, and neither do items
without letter or digit; a short item matches however short it is; equal items
are each reported; repeated rows each give their rows; an empty table gives no
rows; ties between places of equal distance go to the first. Pieces are reported
where no longer passage that holds them is; pieces that meet are one row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .common import broadcast_value, chunked, map_batches

Q = 8
#: Edits allowed, as a share of the passage's characters.
EDIT_RATE = 0.1
MIN_CHARS = 40
WHOLE, WINDOW, STEP = 256, 200, 100
#: Words in a row that are found wherever they begin in an item, and the pieces that see to it.
RUN, PIECE_STEP = 13, 4
PIECE = RUN - PIECE_STEP + 1
LONG_WORD = 8
#: Places of a passage that are compared at once, as the bits of one number.
HEAD = 64
#: Stands for places outside a document; equals no code point.
OUTSIDE = 0xFFFFFFFF
#: Shared q-grams (place in the text, place in a passage) that are listed at once; bounds a task's memory.
HITS = 1_000_000
#: Counters (as a power of two) of the shared q-grams of passages by stretch of the text, and their step from one stretch to the next.
_COUNTERS, _SPREAD = 19, 40503
#: Characters of benchmark text in one broadcast.
BLOCK_CHARS = 4_000_000


@cache
def _plain() -> np.ndarray:
    """Lower-case form of each letter or digit; 32 for what is neither."""
    out = tk.lower_table().copy()
    out[(tk.classes() & (tk.LETTER | tk.DIGIT)) == 0] = 32
    return out


def normal_form(cp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Normalised code points, and the place of each in ``cp``."""
    low = _plain()[cp]
    blank = low == 32
    keep = ~blank
    keep[1:] |= blank[1:] & ~blank[:-1]
    at = np.flatnonzero(keep)
    return low[at], at


def gram_hashes(text: np.ndarray) -> np.ndarray:
    """Hash of the ``Q`` (eight) code points from each place on (the last Q - 1 places have none)."""
    if len(text) < Q:
        return np.zeros(0, np.uint64)
    p = [np.uint64(pow(0x9E3779B97F4A7C15, i, 1 << 64)) for i in range(Q)]
    one = text.astype(np.uint64) + np.uint64(1)
    two = one[:-1] + one[1:] * p[1]
    four = two[:-2] + two[2:] * p[2]
    eight = four[:-4] + four[4:] * p[4]
    n = len(text) - Q + 1
    return tk.mix(eight[:n])


@dataclass(frozen=True)
class Index:
    items: list  # id of each passage's item
    passages: list[np.ndarray]
    budget: np.ndarray  # edits allowed
    bound: np.ndarray  # shared q-grams needed
    grams: np.ndarray  # sorted distinct hashes
    first: np.ndarray  # where each hash's postings begin (and the end)
    passage_of: np.ndarray
    offset_of: np.ndarray
    bits: np.ndarray  # hashes present, by their leading bits
    shift: int
    number: np.ndarray  # of each passage's item
    place: np.ndarray  # of each passage in its item
    whole: int  # so many passages are whole items or windows; pieces follow
    short: dict  # length -> (hash, item, text) of the items searched verbatim
    letters: np.ndarray  # number of each code point among those of the passages, 0 if in none
    heads: np.ndarray  # those numbers of each passage's first HEAD places, 0 beyond its end


def _word_starts(norm: np.ndarray) -> np.ndarray:
    """Where words begin, and each further ``LONG_WORD`` characters of a longer one."""
    at = np.arange(len(norm))
    blank = norm == 32
    starts = ~blank & np.append(True, blank[:-1])[:len(norm)]
    since = at - np.maximum.accumulate(np.where(starts, at, 0))
    return np.flatnonzero(~blank & (since % LONG_WORD == 0))


def pieces(norm: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) of every piece of a normalised item; none if all of it is no longer than one piece."""
    starts = _word_starts(norm)
    if len(starts) <= PIECE:
        return []
    ends = np.append(starts, len(norm))
    ends = ends - (norm[np.maximum(ends - 1, 0)] == 32)
    firsts = [*range(0, len(starts) - PIECE, PIECE_STEP), len(starts) - PIECE]
    return [(int(starts[i]), int(ends[i + PIECE])) for i in firsts]


_STEP = 0x9E3779B97F4A7C15


def _prefix_hashes(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of code points times powers, up to each place, and the powers' inverses: any part's hash is one difference."""
    def powers(x: int) -> np.ndarray:
        out = np.full(len(text) + 1, x, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    total = np.append(np.uint64(0), np.cumsum((text.astype(np.uint64) + np.uint64(1)) * powers(_STEP)[:-1], dtype=np.uint64))
    return total, powers(pow(_STEP, -1, 1 << 64))


def build_index(items: list[tuple[object, str]], rate: float = EDIT_RATE, parts: bool = False) -> Index:
    """Whole items and windows; with ``parts`` the pieces and the short items too."""
    ids, passages, number, place, cut, short = [], [], [], [], [], {}
    for no, (item, text) in enumerate(items):
        cp, _ = tk.code_points([text or ""])
        norm, _ = normal_form(cp)
        norm = norm[1:] if len(norm) and norm[0] == 32 else norm
        norm = norm[:-1] if len(norm) and norm[-1] == 32 else norm
        if parts and len(norm):
            cut += [(item, no, a, norm[a:b]) for a, b in pieces(norm)]
        if len(norm) < MIN_CHARS:
            if parts and len(norm):
                value = int(_prefix_hashes(norm)[0][-1])
                short.setdefault(len(norm), []).append((value, item, norm))
            continue
        starts = [0] if len(norm) <= WHOLE else [*range(0, len(norm) - WINDOW, STEP), len(norm) - WINDOW]
        for s in starts:
            ids.append(item)
            passages.append(norm[s:] if len(norm) <= WHOLE else norm[s:s + WINDOW])
            number.append(no)
            place.append(s)
    whole = len(passages)
    for item, no, a, part in cut:
        ids.append(item)
        passages.append(part)
        number.append(no)
        place.append(a)
    letters = np.zeros(0x110000, np.int32)
    if passages:
        known = np.unique(np.concatenate(passages))
        letters[known] = np.arange(1, len(known) + 1)
    heads = np.zeros((len(passages), HEAD), np.int32)
    for i, part in enumerate(passages):
        heads[i, :min(HEAD, len(part))] = letters[part[:HEAD]]
    size = np.array([len(p) for p in passages], dtype=np.int64)
    budget = np.minimum((size * rate).astype(np.int64), np.maximum(0, (size - Q) // Q))
    hashes = [gram_hashes(p) for p in passages]
    h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    of = np.repeat(np.arange(len(passages), dtype=np.int32), [len(x) for x in hashes])
    off = np.concatenate([np.arange(len(x), dtype=np.int32) for x in hashes]) if hashes else np.zeros(0, np.int32)
    order = np.argsort(h, kind="stable")
    grams, first = np.unique(h[order], return_index=True)
    wide = max(16, int(np.ceil(np.log2(max(1, len(grams)) * 32))))
    bits = np.zeros(1 << wide, bool)
    bits[(grams >> np.uint64(64 - wide)).astype(np.int64)] = True
    return Index(ids, passages, budget, size + 1 - Q - budget * Q, grams, np.append(first, len(h)), of[order], off[order],
                 bits, 64 - wide, np.array(number, dtype=np.int64), np.array(place, dtype=np.int64), whole, short,
                 letters, heads)


def candidate_bands(index: Index, text: np.ndarray, bounds: np.ndarray,
                    limit: int = HITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, passage, first diagonal) of every band that holds enough shared q-grams.

    ``bounds`` are the documents' places in ``text``. A diagonal is a place in the document minus the place in the passage.
    About ``limit`` pairs of a place and a passage's q-gram are held at once, however many items share a passage.
    """
    none = (np.zeros(0, np.int64),) * 3
    h = gram_hashes(text)
    at = np.flatnonzero(index.bits[(h >> np.uint64(index.shift)).astype(np.int64)]) if len(index.grams) else none[0]
    if not len(at):
        return none
    found = np.searchsorted(index.grams, h[at])
    found[found == len(index.grams)] = 0
    hit = index.grams[found] == h[at]
    at, found = at[hit], found[hit]
    doc = np.searchsorted(bounds, at, side="right") - 1
    inside = at + Q <= bounds[doc + 1]  # not across two documents
    at, found, doc = at[inside], found[inside], doc[inside]
    times = index.first[found + 1] - index.first[found]
    if not len(times) or not times.sum():
        return none
    size = index.bound + Q - 1 + index.budget * Q
    half_width = index.budget + 1
    span = np.int64(4 * len(text) + 4096)
    shift = max(9, int((size + 2 * half_width).max()).bit_length())  # the places of a band lie in two neighbouring stretches at most
    # overlapping bands: each diagonal lies in two, a band of budget + 1 diagonals in one of them
    found_bands = [(none[0], none[0])] * 2
    ends = np.unique(np.append(np.searchsorted(np.cumsum(times), np.arange(limit, times.sum(), limit)) + 1, len(times)))
    for a, b in zip(np.append(0, ends[:-1]), ends):
        t = times[a:b]
        which = np.repeat(index.first[found[a:b]] - np.cumsum(t) + t, t) + np.arange(t.sum())
        passage, place = index.passage_of[which], np.repeat(at[a:b], t)
        some = _crowded(passage, np.repeat(at[a:b] >> shift, t), index.bound)
        if a:  # bands that reach into the parts before or after can't be told yet
            some |= place < at[a] + (2 << shift)
        if b < len(times):
            some |= place > at[b - 1] - (2 << shift)
        some = np.flatnonzero(some)
        which, passage, place = which[some], passage[some].astype(np.int64), place[some]
        pair = np.repeat(doc[a:b], t)[some] * np.int64(len(index.passages)) + passage
        diagonal = place - index.offset_of[which]  # in the whole chunk; its document follows from the place
        strip = (diagonal + 2048) // half_width[passage]  # a band is two of these
        for half in (0, 1):
            keys, n = np.unique(pair * span + ((strip + half) >> 1), return_counts=True)
            if a:
                keys, where = np.unique(np.append(found_bands[half][0], keys), return_inverse=True)
                n = np.bincount(where, np.append(found_bands[half][1], n)).astype(np.int64)
            # bands with too few q-grams stay only while places to come can lie in them
            p = (keys // span) % len(index.passages)
            keep = n >= index.bound[p]
            if b < len(times):
                w = 2 * half_width[p]
                keep |= (keys % span) * w - half * half_width[p] - 2048 + w + size[p] > at[b]
            found_bands[half] = (keys[keep], n[keep])
    out = []
    for half, (keys, _) in enumerate(found_bands):
        p = (keys // span) % len(index.passages)
        w = 2 * half_width[p]
        out.append((keys // span // len(index.passages), p, (keys % span) * w - half * half_width[p] - 2048))
    return tuple(np.concatenate(x) for x in zip(*out))


def _crowded(passage: np.ndarray, stretch: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """Whether a passage's shared q-grams in a stretch of the text and one of its neighbours may reach the bound.

    Counted in a table of bounded size; what shares a counter only raises it, so no pair that can reach the bound is lost.
    """
    size = 1 << min(_COUNTERS, len(passage).bit_length())
    cell = (stretch * _SPREAD + passage) & (size - 1)
    n = np.bincount(cell, minlength=size)
    n += np.maximum(np.roll(n, _SPREAD), np.roll(n, -_SPREAD))
    return n[cell] >= bound[passage]


def align(passages: list[np.ndarray], windows: list[np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Fewest edits that turn each passage into a part of its window, and where that part ends in the window.

    Only ``width`` diagonals are computed: the passage's place j may meet the window's places j .. j + width - 1. All
    pairs advance together, one place of the passage at a time.
    """
    n, far = len(passages), 1 << 20
    size = np.array([len(p) for p in passages])
    longest = int(size.max())
    p = np.full((n, longest), 0xFFFFFFFE, np.uint32)
    t = np.full((n, longest + width), OUTSIDE, np.uint32)
    for i, (a, b) in enumerate(zip(passages, windows)):
        p[i, :len(a)] = a
        b = b[:longest + width]
        t[i, :len(b)] = b
    steps = np.arange(width, dtype=np.int32)
    cost = np.zeros((n, width), np.int32)  # after no place of the passage: any start is free
    best, end = np.full(n, far, np.int32), np.zeros(n, np.int64)
    for j in range(longest):
        new = cost + (p[:, j:j + 1] != t[:, j:j + width])
        skip = np.concatenate([cost[:, 1:], np.full((n, 1), far, np.int32)], axis=1) + 1  # passage place without partner
        np.minimum(new, skip, out=new)
        cost = np.minimum.accumulate(new - steps, axis=1) + steps  # window places without partner
        done = np.flatnonzero(size == j + 1)
        if len(done):
            k = cost[done].argmin(axis=1)
            best[done], end[done] = cost[done, k], j + 1 + k
    return best, end


def may_match(index: Index, text: np.ndarray, passage: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Whether the first ``HEAD`` places of each passage are within its budget of a part of text[low:high].

    Bit-parallel (Myers), all pairs at once. Where it says no, the whole passage can't be within its budget either.
    """
    out = np.zeros(len(passage), bool)
    letters = index.letters[text]
    one, wide = np.uint64(1), int(index.letters.max(initial=0)) + 1
    step = max(64, min(8192, 4_000_000 // wide))  # bounds the table of masks
    order = np.argsort(high - low, kind="stable")
    for i in range(0, len(passage), step):
        rows = order[i:i + step]
        some, which = np.unique(passage[rows], return_inverse=True)
        heads = index.heads[some]
        mask = np.zeros((len(some), wide), np.uint64)
        for j in range(HEAD):
            mask[np.arange(len(some)), heads[:, j]] |= one << np.uint64(j)
        mask[:, 0] = 0
        mask, base = mask.ravel(), which * wide
        size = np.minimum(index.heads.shape[1], np.array([len(index.passages[x]) for x in some]))[which]
        last = (size - 1).astype(np.uint64)
        up, down = np.full(len(rows), ~np.uint64(0)), np.zeros(len(rows), np.uint64)
        score = size.astype(np.int64)
        best = score.copy()
        a, b = low[rows], high[rows]
        for j in range(int((b - a).max(initial=0))):
            at = a + j
            equal = mask[base + np.where(at < b, letters[np.minimum(at, len(text) - 1)], 0)]
            x = equal | down
            h = (((equal & up) + up) ^ up) | equal
            more, less = down | ~(h | up), up & h
            score += ((more >> last) & one).astype(np.int64) - ((less >> last) & one).astype(np.int64)
            np.minimum(best, score, out=best)
            more, less = more << one, less << one
            up, down = less | ~(x | more), more & x
        out[rows] = best <= index.budget[passage[rows]]
    return out


def matches(index: Index, texts: list[str]) -> list[tuple[int, int, int, int, int]]:
    """(text, passage, start, end, edits) in characters of the original texts, best place of each pair."""
    cp, starts = tk.code_points(texts)
    norm, at = normal_form(cp)
    bounds = np.searchsorted(at, starts)
    doc, passage, diagonal = candidate_bands(index, norm, bounds)
    # blanks at either end of a document, or after it, are no part of it
    blank = np.append(norm == 32, False)
    opens = bounds[:-1] + (blank[bounds[:-1]] & (bounds[:-1] < bounds[1:]))
    closes = np.maximum(opens, bounds[1:] - blank[bounds[1:] - 1])
    size = np.array([len(p) for p in index.passages], dtype=np.int64)
    # a band that runs off its document leaves too few places for the passage
    left = np.maximum(diagonal - index.budget[passage] - 1, opens[doc])
    right = np.minimum(diagonal + 3 * (index.budget[passage] + 1) + size[passage], closes[doc])
    room = right - left >= size[passage] - index.budget[passage]
    doc, passage, diagonal, left, right = (x[room] for x in (doc, passage, diagonal, left, right))
    near = may_match(index, norm, passage, left, np.minimum(right, diagonal + 3 * (index.budget[passage] + 1) + HEAD))
    doc, passage, diagonal = doc[near], passage[near], diagonal[near]
    out: dict[tuple[int, int], tuple[int, int, int]] = {}
    held: dict[tuple[int, int], list[tuple[int, int]]] = {}  # parts of an item found in a text by whole items and windows
    order = np.lexsort((diagonal, passage >= index.whole))
    doc, passage, diagonal = doc[order], passage[order], diagonal[order]
    split = int((passage < index.whole).sum())
    for i in [*range(0, split, 256), *range(split, len(doc), 256)]:
        to = min(i + 256, split) if i < split else i + 256
        if i == split:
            for x, y in out:
                a = int(index.place[y])
                held.setdefault((x, int(index.number[y])), []).append((a, a + int(size[y])))
        # a place without edits is not bettered by a later one, and a piece says nothing new within a longer passage
        left = [j for j, (x, y) in enumerate(zip(doc[i:to].tolist(), passage[i:to].tolist()))
                if out.get((x, y), (1,))[0] and not (y >= index.whole and any(
                    a <= index.place[y] and index.place[y] + size[y] <= b for a, b in held.get((x, int(index.number[y])), ())))]
        if not left:
            continue
        d, p, g = (c[i:to][left] for c in (doc, passage, diagonal))
        k = index.budget[p]
        low, begin = g - k - 1, opens[d]
        high = np.minimum(g + 3 * (k + 1) + size[p], closes[d])
        wide = int((4 * (k + 1)).max()) + 2
        # what lies before the document is filled, so that the passage's place j still meets the window's place j
        windows = [np.concatenate([np.full(max(0, c - a), OUTSIDE, np.uint32), norm[max(a, c):max(a, b, c)]])
                   for a, b, c in zip(low, high, begin)]
        edits, end = align([index.passages[x] for x in p], windows, wide)
        ok = np.flatnonzero(edits <= k)
        if not len(ok):
            continue
        # the same from the end backwards gives where the best part begins
        pad = int(k[ok].max()) + 1
        back = [np.concatenate([np.full(pad, OUTSIDE, np.uint32), windows[x][:end[x]][::-1]]) for x in ok]
        _, first = align([index.passages[p[x]][::-1] for x in ok], back, 2 * pad + 1)
        for x, f in zip(ok, first):
            b = int(low[x] + min(end[x], len(windows[x])))
            a = max(int(low[x]), int(begin[x]), b - int(f) + pad)
            key = (int(d[x]), int(p[x]))
            found = (int(edits[x]), int(at[a] - starts[d[x]]), int(at[b - 1] + 1 - starts[d[x]]))
            if key not in out or found < out[key]:
                out[key] = found
    return [(d, p, a, b, e) for (d, p), (e, a, b) in sorted(out.items())]


def short_places(index: Index, texts: list[str]) -> list[tuple[int, object, int, int, int]]:
    """(text, item, start, end, characters) of the first place where each short item stands verbatim between word bounds."""
    if not index.short:
        return []
    cp, starts = tk.code_points(texts)
    norm, at = normal_form(cp)
    bounds = np.searchsorted(at, starts)
    blank = norm == 32
    begins = np.flatnonzero(~blank & np.append(True, blank[:-1])[:len(norm)])
    total, back = _prefix_hashes(norm)
    out = []
    for length, items in index.short.items():
        a = begins[begins + length <= len(norm)]
        a = a[np.append(blank, True)[a + length]]  # texts are kept apart by a blank, and an item holds whole words
        a = a[a + length <= bounds[np.searchsorted(bounds, a, side="right")]]
        h = (total[a + length] - total[a]) * back[a]
        known = np.array(sorted({v for v, _, _ in items}), dtype=np.uint64)
        near = np.searchsorted(known, h)
        near[near == len(known)] = 0
        hit = known[near] == h
        first: dict[tuple[int, int], int] = {}
        for x, value in zip(a[hit].tolist(), h[hit].tolist()):
            first.setdefault((int(np.searchsorted(bounds, x, side="right")) - 1, value), x)
        by_value: dict[int, list] = {}
        for value, item, text in items:
            by_value.setdefault(value, []).append((item, text))
        for (d, value), x in first.items():
            out += [(d, item, int(at[x] - starts[d]), int(at[x + length - 1] + 1 - starts[d]), length)
                    for item, text in by_value[value] if np.array_equal(text, norm[x:x + length])]
    return out


def places(index: Index, texts: list[str]) -> list[tuple[int, object, int, int, int, int]]:
    """(text, item, start, end, edits, characters of the passage): whole items, windows, pieces joined, short items.

    Pieces that follow each other in the item and meet in the text are one place; its edits are the most of any piece.
    """
    out, cut = [], {}
    for d, p, a, b, e in matches(index, texts):
        if p < index.whole:
            out.append((d, index.items[p], a, b, e, len(index.passages[p])))
        else:
            cut.setdefault((d, int(index.number[p])), []).append(
                (int(index.place[p]), int(index.place[p]) + len(index.passages[p]), a, b, e, index.items[p]))
    for (d, _), found in cut.items():
        joined: list[list] = []
        for s, t, a, b, e, item in sorted(found, key=lambda x: x[:5]):
            last = joined[-1] if joined else None
            if last and s <= last[1] + 1 and last[2] <= a <= last[3] + 1 and b >= last[3]:
                last[1], last[3], last[4] = t, b, max(last[4], e)
            else:
                joined.append([s, t, a, b, e, item])
        out += [(d, item, a, b, e, t - s) for s, t, a, b, e, item in joined]
    out += [(d, item, a, b, 0, n) for d, item, a, b, n in short_places(index, texts)]
    return sorted(out, key=lambda r: (r[0], *r[2:]))


def indexes(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", block_chars: int = BLOCK_CHARS,
            rate: float = EDIT_RATE) -> Iterator[Index]:
    """One index per block of about ``block_chars`` characters of benchmark text."""
    items = benchmark.select(F.col(id_col).alias("i"), F.col(text_col).cast("string").alias("t")).where("t <> ''")
    size = items.agg(F.sum(F.length("t")).alias("n")).first()["n"] or 0
    blocks = -(-size // block_chars)
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("t"), F.lit(blocks)) == b).collect()
        yield build_index(sorted(((r["i"], r["t"]) for r in rows), key=lambda r: (str(r[0]), r[1])), rate, parts=True)


def find(docs: DataFrame, benchmark: DataFrame, id_cols: list[str], text_col: str = "text", item_col: str = "item_id",
         item_text: str = "text", rate: float = EDIT_RATE) -> DataFrame:
    """One row per document and benchmark item found in it: ``id_cols``, the item's id, start, end, edits, passage_chars.

    Of several windows of one item in a document, and of several separate runs of its pieces, each is a row.
    """
    src = docs.select(*[F.col(c) for c in id_cols], F.col(text_col).cast("string").alias("__text"))
    item_type = benchmark.schema[item_col].dataType
    fields = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1]),
                        f"`{item_col}` {item_type.simpleString()}"])
    schema = f"{fields}, start long, end long, edits long, passage_chars long"
    out = None
    for index in indexes(benchmark, item_col, item_text, rate=rate):
        shared = broadcast_value(docs.sparkSession, index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b in batches:
                texts = [t or "" for t in b.column(b.num_columns - 1).to_pylist()]
                for i, j in chunked(texts):
                    got = places(shared.value, texts[i:j])
                    if got:
                        d, p, a, e, k, n = (list(c) for c in zip(*got))
                        rows = pa.array([i + x for x in d])
                        yield pa.RecordBatch.from_arrays(
                            [*(c.take(rows) for c in b.columns[:-1]), pa.array(p),
                             *(pa.array(c, pa.int64()) for c in (a, e, k, n))],
                            names=[*b.schema.names[:-1], item_col, "start", "end", "edits", "passage_chars"])

        part = map_batches(src, run, schema)
        out = part if out is None else out.unionAll(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                      item_text: str = "text", rate: float = EDIT_RATE) -> DataFrame:
    """The rows of ``docs``, all columns, in whose text no benchmark passage is found."""
    at, names = docs.columns.index(text_col), [f"c{i}" for i in range(len(docs.columns))]
    schema = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, docs.schema.fields))
    out = docs.toDF(*names)
    for index in indexes(benchmark, item_col, item_text, rate=rate):
        shared = broadcast_value(docs.sparkSession, index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b in batches:
                texts = [t or "" for t in b.column(at).to_pylist()]
                clean = np.ones(len(texts), bool)
                for i, j in chunked(texts):
                    clean[[i + m[0] for m in places(shared.value, texts[i:j])]] = False
                yield b.filter(pa.array(clean))

        out = map_batches(out, run, schema)
    return out.toDF(*docs.columns)
