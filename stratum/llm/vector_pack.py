"""Vector bin packing of token sequences.

Examples go into training sequences under three limits at once: tokens,
segments (pieces) and loss-bearing tokens. An example goes to the open bin where
the dot product of its demand and the bin's room, each as a share of the limit,
is largest. If none has room and all bins are open, it is cut: it fills up the
fullest bin and its rest is placed anew, so bins close full. Each task packs its
own partition with ``OPEN_BINS`` open bins, so memory is bounded and a lost task
is simply run again.

Cutting rule: any cut is allowed; every id lies in exactly one piece. A bin that
can't be filled any more (end of a partition, segment or loss limit reached) is
cut into sequences whose lengths are powers of two, which need no padding.

Defined cases: a null or empty text holds only the end id; repeated rows are
packed each; an empty table gives no rows. Loss-bearing are the tokens of an
example from ``loss_from`` on (null: all).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches
from .tokens import word_tokenizer

#: Bins kept open by a task.
OPEN_BINS = 48


@dataclass(frozen=True)
class Limits:
    tokens: int = 4096
    segments: int = 512
    loss_tokens: int = 4096


@dataclass
class Piece:
    key: object
    data: bytes  # four bytes an id
    start: int
    doc_tokens: int
    loss_from: int

    def __len__(self) -> int:
        return len(self.data) // 4

    @property
    def loss(self) -> int:
        return max(0, self.start + len(self) - max(self.start, self.loss_from))

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return (Piece(self.key, self.data[:4 * n], self.start, self.doc_tokens, self.loss_from),
                Piece(self.key, self.data[4 * n:], self.start + n, self.doc_tokens, self.loss_from))


@dataclass
class Bin:
    pieces: list[Piece] = field(default_factory=list)
    tokens: int = 0
    loss: int = 0

    def add(self, p: Piece) -> None:
        self.pieces.append(p)
        self.tokens += len(p)
        self.loss += p.loss


class Packer:
    """Packs pieces as they come; ``emit`` gets each finished sequence as a list of pieces."""

    def __init__(self, limits: Limits, emit: Callable[[list[Piece]], None], open_bins: int = OPEN_BINS):
        if min(limits.tokens, limits.segments, limits.loss_tokens, open_bins) < 1:
            raise ValueError("limits must be positive")
        self.limits, self.emit, self.size = limits, emit, open_bins
        self.top = np.array([limits.tokens, limits.segments, limits.loss_tokens], dtype=float)
        self.bins: list[Bin] = []
        self.room = np.zeros((open_bins, 3))

    def _fits(self, b: Bin, p: Piece) -> int:
        """How many ids of ``p``, from its start, have room in ``b``."""
        if len(b.pieces) >= self.limits.segments:
            return 0
        n = min(len(p), self.limits.tokens - b.tokens)
        free = max(0, p.loss_from - p.start)  # ids that bear no loss
        return min(n, free + self.limits.loss_tokens - b.loss)

    def add(self, p: Piece) -> None:
        while len(p):
            k = self._best(p)
            if k is None and len(self.bins) < self.size:
                self.bins.append(Bin())
                self._noted(len(self.bins) - 1)
                k = len(self.bins) - 1
            if k is None:
                k = max(range(len(self.bins)), key=lambda i: (self.bins[i].tokens, -i))
            n = self._fits(self.bins[k], p)
            if n <= 0:
                self._close(k)
                continue
            head, p = p.cut(n) if n < len(p) else (p, Piece(p.key, b"", 0, 0, 0))
            self.bins[k].add(head)
            if self.bins[k].tokens == self.limits.tokens:
                self._close(k)
            else:
                self._noted(k)

    def _best(self, p: Piece) -> int | None:
        if not self.bins:
            return None
        room = self.room[:len(self.bins)]
        need = np.array([len(p), 1, p.loss], dtype=float)
        score = np.where((room >= need).all(axis=1), (room / self.top) @ (need / self.top), -1.0)
        k = int(score.argmax())
        return k if score[k] >= 0 else None

    def _noted(self, k: int) -> None:
        b = self.bins[k]
        self.room[k] = (self.limits.tokens - b.tokens, self.limits.segments - len(b.pieces), self.limits.loss_tokens - b.loss)

    def _close(self, k: int) -> None:
        b = self.bins.pop(k)
        self.room[k:len(self.bins)] = self.room[k + 1:len(self.bins) + 1]
        self._out(b)

    def _out(self, b: Bin) -> None:
        pieces, left = b.pieces, b.tokens
        if left == self.limits.tokens:
            self.emit(pieces)
            return
        while left:
            size = 1 << (left.bit_length() - 1)
            taken, got = [], 0
            while got < size:
                p = pieces.pop(0)
                if got + len(p) > size:
                    p, rest = p.cut(size - got)
                    pieces.insert(0, rest)
                taken.append(p)
                got += len(p)
            self.emit(taken)
            left -= size

    def finish(self) -> None:
        """Fill the fuller bins from the emptiest, then let the few rests go."""
        rest = sorted(self.bins, key=lambda b: b.tokens)
        self.bins = []
        moved = Packer(self.limits, self.emit, 1)
        for b in reversed(rest):
            for p in b.pieces:
                moved.add(p)
        for b in moved.bins:
            self._out(b)


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         loss_col: str | None = None, limits: Limits = Limits(), end_id: int = 2) -> DataFrame:
    """One row per piece: the id column, start, length, ids (little-endian 32-bit), doc_tokens, loss_tokens,
    sequence_id, offset. A sequence id holds the partition that packed it and a number there."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = word_tokenizer(tokenizer_path)
        base, made, out = TaskContext.get().partitionId() << 36, 0, []

        def emit(pieces: list[Piece]) -> None:
            nonlocal made
            offset = 0
            for p in pieces:
                out.append((p.key, p.start, len(p), p.data, p.doc_tokens, p.loss, base + made, offset))
                offset += len(p)
            made += 1

        def flush(schema: pa.Schema) -> Iterator[pa.RecordBatch]:
            if out:
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], schema.field(0).type), *(pa.array(c, pa.int64()) for c in cols[1:3]),
                     pa.array(cols[3], pa.binary()), *(pa.array(c, pa.int64()) for c in cols[4:])],
                    names=[schema.names[0], "start", "length", "ids", "doc_tokens", "loss_tokens", "sequence_id", "offset"])
                out.clear()

        packer, schema = Packer(limits, emit), None
        for b in batches:
            schema = b.schema
            keys, texts, loss = (b.column(i).to_pylist() for i in range(3))
            for key, text, first in zip(keys, texts, loss):
                data = tok.encode(text or "") + end
                packer.add(Piece(key, data, 0, len(data) // 4, max(0, first or 0)))
                if len(out) >= 500:
                    yield from flush(schema)
        if schema is not None:
            packer.finish()
            yield from flush(schema)

    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                      (F.col(loss_col).cast("long") if loss_col else F.lit(None).cast("long")).alias("loss_from"))
    kind = src.schema["doc_id"].dataType.simpleString()
    return map_batches(src, run, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, "
                                 "loss_tokens long, sequence_id long, offset long", tokenizes=True).withColumnRenamed("doc_id", id_col)
