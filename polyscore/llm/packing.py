"""Best-two-fit packing of token sequences.

Only the lengths of the pieces matter to the packing, and there are no more
lengths than the capacity, so the plan is made on the histogram of lengths: a
bin is filled greedily with the longest pieces that fit; then its smallest
piece gives way to two unpacked pieces that fit the expanded gap more tightly,
as long as such a pair exists. The same bin is repeated while the histogram
still holds its pieces, which is what packing bin by bin would do. Spark counts
the lengths, ranks the pieces of each length over salted parts (one length may
hold a third of all rows) and gives each rank its place.

A null text is empty; an empty one is a piece with the end id alone. Texts
beyond the capacity are cut into pieces of the capacity, the first one shorter
where the length isn't a multiple. Repeated rows are separate pieces. An empty
table gives an empty result. Columns other than doc_id and text are left out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from polyscore.llm.common import map_arrow, rows_per_task, slices, stage, texts_of
from polyscore.llm.tokens import encoder, with_end

CAPACITY = 2048
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of every text: doc_id, piece, start, length, ids_crc32."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            for part in slices(batch, 8 << 20):
                ids, counts = enc.encode(part.column(1))
                ids, bounds = with_end(ids, counts, end_id)
                n = np.diff(bounds)
                parts = -(-n // capacity)
                row = np.repeat(np.arange(len(n)), parts)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
                first = n - (parts - 1) * capacity
                length = np.where(piece == 0, first[row], capacity)
                start = np.where(piece == 0, 0, first[row] + (piece - 1) * capacity)
                at = bounds[:-1][row] + start
                raw = ids.astype("<u4").tobytes()
                crc = [zlib.crc32(raw[4 * a:4 * (a + k)]) for a, k in zip(at.tolist(), length.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start),
                     pa.array(length), pa.array(crc, pa.int64())],
                    ["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = texts_of(docs, "doc_id").withColumn("doc_id", F.col("doc_id").cast("long"))
    return map_arrow(rows, cut, _PIECES)


def plan_bins(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Kinds of bins, each with the number of its pieces by length and how often it is used.

    ``counts[n]`` is the number of pieces of length n. A kind is repeated until
    some length runs short, so there are a few kinds per length at most.
    """
    left = np.array(counts, np.int64)
    kinds = []
    while left.any():
        free, used, gap = left.copy(), {}, capacity
        lengths = np.flatnonzero(free)

        def take(n: int, by: int = 1) -> None:
            nonlocal gap
            free[n] -= by
            used[n] = used.get(n, 0) + by
            gap -= n * by
            if not used[n]:
                del used[n]

        while (at := int(np.searchsorted(lengths, gap, "right"))) and gap:
            while at and not free[lengths[at - 1]]:
                at -= 1
            if not at:
                break
            n = int(lengths[at - 1])
            take(n, min(int(free[n]), gap // n))
        while gap and used:
            small = min(used)
            pair = _best_pair(np.flatnonzero(free), free, gap + small)
            if pair is None or sum(pair) <= small:
                break
            take(small, -1)
            for n in pair:
                take(n)
        times = min(int(left[n]) // k for n, k in used.items())
        for n, k in used.items():
            left[n] -= times * k
        kinds.append((used, times))
    return kinds


def _best_pair(lengths: np.ndarray, free: np.ndarray, room: int) -> tuple[int, int] | None:
    """Two free pieces with the largest sum within ``room``."""
    if not len(lengths):
        return None
    mate = np.searchsorted(lengths, room - lengths, "right") - 1
    own = (mate >= 0) & (lengths[np.maximum(mate, 0)] == lengths) & (free[lengths] < 2)
    mate = mate - own
    total = np.where(mate >= 0, lengths + lengths[np.maximum(mate, 0)], -1)
    best = int(np.argmax(total))
    return (int(lengths[best]), int(lengths[mate[best]])) if total[best] > 0 else None


def _places(kinds: list[tuple[dict[int, int], int]]) -> tuple[np.ndarray, ...]:
    """For runs of ranks of a length: key (length and first rank), first bin, pieces per bin, offset."""
    seen: dict[int, int] = {}
    rows, bin0 = [], 0
    for used, times in kinds:
        offset = 0
        for n, k in sorted(used.items(), reverse=True):
            rows.append((n << 48 | seen.get(n, 0), seen.get(n, 0), bin0, k, offset))
            seen[n] = seen.get(n, 0) + k * times
            offset += n * k
        bin0 += times
    return tuple(np.array(x, np.int64) for x in zip(*sorted(rows))) if rows else (np.zeros(0, np.int64),) * 5


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (staged, with length up to ``capacity``) with sequence_id and offset."""
    spark = pieces.sparkSession
    salts = rows_per_task(pieces)
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "start"), F.lit(salts)).cast("int"))
    by_part = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    counts = np.zeros(capacity + 1, np.int64)
    for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect():  # capacity rows at most
        counts[r["length"]] = r["n"]
    places = spark.sparkContext.broadcast(_places(plan_bins(counts, capacity)))  # a few rows per length
    before = by_part.select("length", "salt", (
        F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).alias("before"))
    ranked = (salted.withColumn("rank", F.row_number().over(
        Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")) - 1)
        .join(before, ["length", "salt"])
        .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("before")).alias("rank")))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, bin0, per, offset = places.value
        for batch in batches:
            length, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            at = np.searchsorted(key, length << 48 | rank, "right") - 1
            nth = rank - first[at]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(bin0[at] + nth // per[at]),
                 pa.array(offset[at] + nth % per[at] * length)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return map_arrow(ranked, place, _PIECES + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    return pack(stage(token_pieces(docs, tokenizer, end_id, capacity), "pieces"), capacity)
