"""Online packing of token sequences by the sum of squares.

Each task packs the texts that it reads, in their order. A level array holds how
many windows are filled to each level. The ids of a text beyond the capacity
fill windows of their own; what is left of it goes to the level, or to a new
window, for which the sum of the squared counts of all levels gets least; the
fullest such level wins a tie. So no level gets many windows, and later texts
find a level that they complete.

Padding follows from the windows that are still open at a task's end (or when
``OPEN`` are, which bounds a task's memory). A sequence whose length is a power
of two isn't padded, so such windows stay. The others are joined end to end and
cut anew at the capacity; what is left at the end is cut into powers of two. A
task so adds one cut per joined sequence and a dozen short sequences at most,
and nothing is padded. Nothing is shuffled and no task waits for another; texts
must come in the same order when a task is repeated, as from a table.

A null text is empty; an empty one is a piece with the end id alone. Texts of
equal length go where the level array, as it is then, sends them. Repeated rows
are pieces of their own. An empty table gives an empty result. Columns other
than doc_id and text are left out. Special tokens' strings are ordinary text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polyscore.llm.common import map_arrow, slices, texts_of
from polyscore.llm.forms import LowerEncoder, remembered
from polyscore.llm.tokens import with_end

CAPACITY = 2048
#: Windows that a task keeps open; beyond, they are joined as at its end.
OPEN = 8192
_ROW = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


@dataclass
class Piece:
    """A run of a text's ids."""

    doc_id: int | None
    start: int
    ids: np.ndarray
    doc_tokens: int

    def cut(self, at: int) -> tuple[Piece, Piece]:
        return (Piece(self.doc_id, self.start, self.ids[:at], self.doc_tokens),
                Piece(self.doc_id, self.start + at, self.ids[at:], self.doc_tokens))


@dataclass
class Window:
    pieces: list[Piece] = field(default_factory=list)


def is_power(n: int) -> bool:
    return n > 0 and n & (n - 1) == 0


def best_level(counts: np.ndarray, length: int, capacity: int) -> int:
    """The level (0: a new window) that takes ``length`` ids with the least sum of squared counts.

    ``counts[0]`` and ``counts[capacity]`` are 0: empty and full windows aren't counted.
    """
    last = capacity - length
    before, after = counts[:last + 1], counts[length:]
    change = 2 * after[:last + 1] - 2 * before + 2  # a window leaves one level and comes to another
    change[0] = 2 * counts[length] + 1  # a new window leaves none
    change[last] -= 2 * counts[capacity] + 1  # a full window is counted nowhere
    change[1:][before[1:] == 0] = np.iinfo(np.int64).max
    least = int(change.min())
    return last - int(np.argmax(change[::-1] == least))


class LevelPacker:
    """The windows of a task, by level; full ones are handed out as lists of pieces."""

    def __init__(self, capacity: int = CAPACITY, most_open: int = OPEN):
        self.capacity, self.most_open = capacity, most_open
        self.counts = np.zeros(capacity + 1, np.int64)
        self.windows: list[list[Window]] = [[] for _ in range(capacity)]
        self.open = 0

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        while len(piece.ids) >= self.capacity:
            head, piece = piece.cut(self.capacity)
            yield [head]
        length = len(piece.ids)
        if not length:
            return
        level = best_level(self.counts, length, self.capacity)
        if level:
            window = self.windows[level].pop()
            self.counts[level] -= 1
            self.open -= 1
        else:
            window = Window()
        window.pieces.append(piece)
        if level + length == self.capacity:
            yield window.pieces
            return
        self.windows[level + length].append(window)
        self.counts[level + length] += 1
        self.open += 1
        if self.open >= self.most_open:
            yield from self.close()

    def close(self) -> Iterator[list[Piece]]:
        """All open windows, none of which needs padding then."""
        now, room = [], self.capacity
        for level in range(self.capacity - 1, 0, -1):
            for window in self.windows[level]:
                if is_power(level):
                    yield window.pieces
                    continue
                for piece in window.pieces:
                    while len(piece.ids) >= room:
                        head, piece = piece.cut(room)
                        yield [*now, head]
                        now, room = [], self.capacity
                    if len(piece.ids):
                        now.append(piece)
                        room -= len(piece.ids)
            self.windows[level] = []
        yield from self._powers(now, self.capacity - room)
        self.counts[:] = 0
        self.open = 0

    @staticmethod
    def _powers(pieces: list[Piece], total: int) -> Iterator[list[Piece]]:
        pieces = pieces[::-1]
        while total:
            size = room = 1 << (total.bit_length() - 1)
            out = []
            while room:
                piece = pieces.pop()
                if len(piece.ids) > room:
                    piece, rest = piece.cut(room)
                    pieces.append(rest)
                out.append(piece)
                room -= len(piece.ids)
            yield out
            total -= size


def pack_levels(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY,
                most_open: int = OPEN) -> DataFrame:
    """The pieces of every text of ``docs`` and their places: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = remembered(LowerEncoder, tokenizer).encode
        packer = LevelPacker(capacity, most_open)
        sequence = TaskContext.get().partitionId() << 40
        rows: list[tuple] = []

        def take(full: Iterator[list[Piece]]) -> None:
            nonlocal sequence
            for pieces in full:
                offset = 0
                for p in pieces:
                    n = len(p.ids)
                    rows.append((p.doc_id, p.start, n, zlib.crc32(p.ids.tobytes()), p.doc_tokens, sequence, offset))
                    offset += n
                sequence += 1

        def out() -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * 7
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                              [c.split()[0] for c in _ROW.split(", ")])

        for batch in batches:
            for part in slices(batch, 8 << 20):
                ids, counts = encode(part.column(1))
                ids, bounds = with_end(ids, counts, end_id)
                ids = ids.astype("<u4")
                for doc_id, a, b in zip(part.column(0).to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist()):
                    take(packer.add(Piece(doc_id, 0, ids[a:b].copy() if b - a < capacity else ids[a:b], b - a)))
                yield out()
        take(packer.close())
        yield out()

    rows = texts_of(docs, "doc_id").withColumn("doc_id", F.col("doc_id").cast("long"))
    return map_arrow(rows, pack, _ROW)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
