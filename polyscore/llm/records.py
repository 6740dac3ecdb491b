"""Length-delimited binary records of token ids, with a separate offset index.

A file is a run of records. A record is framed as

    uint64 length | uint32 masked crc32c(length) | payload | uint32 masked crc32c(payload)

all little-endian, the framing of TFRecord files. The payload is ``int64
doc_id, uint32 flags, uint32 n_tokens``, then the ids (16 bits each where the
vocabulary allows, else 32) padded to a multiple of four bytes. Flag bit 0: the
id of the document is null; bit 1: ids have 32 bits.

The offset index is a Parquet table with one row per record: file number,
place in the file, offset, length and the number of ids before it in the file.
With it any reader fetches any records in any order.

Rows come in ascending order of document id over ascending file numbers (null
ids first; equal ids ordered by the hash of their text). A null text is an
empty one; an empty text is a record with the end id alone; repeated rows are
separate records; an empty table gives an empty index and no file.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from polyscore.llm.common import map_arrow, rows_per_task, slices, stage
from polyscore.llm.tokens import encoder, with_end
from polyscore.session import scratch_path

HEADER, TRAILER, META = 12, 4, 16
#: Rows of the index that one reading task takes.
READ_ROWS = 4096
_POLY = np.uint32(0x82F63B78)
_LANE = 64
_FULL = np.uint32(0xFFFFFFFF)
_INDEX = "shard int, seq long, doc_id long, offset long, length long, start long, n_tokens long"


def _byte_tables() -> np.ndarray:
    t = np.zeros((4, 256), np.uint32)
    t[0] = np.arange(256)
    for _ in range(8):
        t[0] = np.where(t[0] & 1, (t[0] >> np.uint32(1)) ^ _POLY, t[0] >> np.uint32(1))
    for k in range(1, 4):
        t[k] = (t[k - 1] >> np.uint32(8)) ^ t[0][t[k - 1] & 255]
    return t[::-1].copy()  # row p is for byte p of a little-endian word


def _linear(tables: np.ndarray, x: np.ndarray) -> np.ndarray:
    return (tables[0][x & 255] ^ tables[1][(x >> np.uint32(8)) & 255]
            ^ tables[2][(x >> np.uint32(16)) & 255] ^ tables[3][x >> np.uint32(24)])


def _from_images(images: np.ndarray) -> np.ndarray:
    value = np.arange(256)
    t = np.zeros((4, 256), np.uint32)
    for bit in range(32):
        t[bit // 8] ^= np.where((value >> (bit % 8)) & 1, images[bit], 0).astype(np.uint32)
    return t


_WORD = _byte_tables()
_BITS = np.uint32(1) << np.arange(32, dtype=np.uint32)


def _lane_steps(most: int) -> Iterator[np.ndarray]:
    """Tables that move a state over 1, 2, 4, ... lanes."""
    images = _BITS
    for _ in range(_LANE):
        images = _linear(_WORD, images)
    while most:
        tables = _from_images(images)
        yield tables
        images = _linear(tables, images)
        most >>= 1


def crc32c(words: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """CRC-32C of each run of ``counts`` (one at least) little-endian 32-bit words, vectorised.

    A checksum is linear over GF(2), so runs are cut into lanes that are
    computed side by side from state 0 and then moved to their place.
    """
    counts = np.asarray(counts, np.int64)
    lanes = -(-counts // _LANE)
    begin = np.cumsum(counts) - counts
    lane0 = np.cumsum(lanes) - lanes
    grid = np.zeros(int(lanes.sum()) * _LANE, np.uint32)
    shift = (lane0 + lanes) * _LANE - counts - begin
    grid[np.arange(len(words)) + np.repeat(shift, counts)] = words
    grid[begin + shift] ^= _FULL
    grid = np.ascontiguousarray(grid.reshape(-1, _LANE).T)
    state = np.zeros(grid.shape[1], np.uint32)
    for row in grid:
        state = _linear(_WORD, state ^ row)
    after = np.repeat(lane0 + lanes - 1, lanes) - np.arange(len(state))
    for bit, tables in enumerate(_lane_steps(int(after.max()) if len(after) else 0)):
        moved = (after >> bit) & 1 == 1
        state[moved] = _linear(tables, state[moved])
    return np.bitwise_xor.reduceat(state, lane0) ^ _FULL if len(state) else np.zeros(0, np.uint32)


def masked(crc: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(0xA282EAD8)


def open_folder(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder by its address, as the cluster names it."""
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))


def frame(doc_ids: list, ids: np.ndarray, bounds: np.ndarray, wide: bool) -> tuple[bytes, np.ndarray]:
    """The records of a batch as bytes, and each record's payload length."""
    counts = np.diff(bounds)
    per = 1 if wide else 2
    width = -(-counts // per)
    size = META // 4 + width  # payload in words
    total = size + 4
    end = np.cumsum(total)
    begin = end - total
    out = np.zeros(int(end[-1]), "<u4")
    length = (size * 4).astype("<u8").view("<u4").reshape(-1, 2)
    out[begin], out[begin + 1] = length[:, 0], length[:, 1]
    out[begin + 2] = masked(crc32c(length.reshape(-1), np.full(len(size), 2)))
    null = np.array([d is None for d in doc_ids])
    who = np.array([0 if d is None else d for d in doc_ids], "<i8").view("<u4").reshape(-1, 2)
    out[begin + 3], out[begin + 4] = who[:, 0], who[:, 1]
    out[begin + 5] = null.astype(np.uint32) | np.uint32(2 if wide else 0)
    out[begin + 6] = counts
    small = out.view("<u4" if wide else "<u2")
    first = (begin + 7) * per
    small[np.arange(len(ids)) + np.repeat(first - bounds[:-1], counts)] = ids
    inside = np.arange(int(size.sum())) + np.repeat(begin + 3 - (np.cumsum(size) - size), size)
    out[begin + 3 + size] = masked(crc32c(out[inside], size))
    return out.tobytes(), size * 4


def parse(raw: bytes) -> Iterator[tuple[int | None, np.ndarray]]:
    """Document ids and token ids of consecutive records; raises on a wrong checksum."""
    w = np.frombuffer(raw, "<u4")
    begin, at = [], 0
    while at < len(w):
        begin.append(at)
        at += (int(w[at]) | int(w[at + 1]) << 32) // 4 + 4
    begin = np.array(begin, np.int64)
    size = np.diff(np.append(begin, at)) - 4
    head = np.stack([w[begin], w[begin + 1]], 1).reshape(-1)
    inside = np.arange(int(size.sum())) + np.repeat(begin + 3 - (np.cumsum(size) - size), size)
    if ((masked(crc32c(head, np.full(len(size), 2))) != w[begin + 2]).any()
            or (masked(crc32c(w[inside], size)) != w[begin + 3 + size]).any()):
        raise ValueError("a record's checksum is wrong")
    for b in begin.tolist():
        flags, n = int(w[b + 5]), int(w[b + 6])
        body = w[b + 7:b + 7 + (n if flags & 2 else -(-n // 2))]
        doc_id = None if flags & 1 else int(w[b + 3:b + 5].view("<i8")[0])
        yield doc_id, body if flags & 2 else body.view("<u2")[:n]


def write_records(docs: DataFrame, tokenizer: str, end_id: int = 0, folder: str | None = None) -> tuple[str, DataFrame]:
    """Write every text of ``docs`` (doc_id, text); returns the folder and the index.

    The file of a task is written under a name of its own and then moved, so a
    repeated task only writes the same bytes again.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "records")
    tie = F.xxhash64(F.col("text"))
    parts = (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
             .repartitionByRange(F.col("doc_id"), tie).sortWithinPartitions(F.col("doc_id"), tie))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        shard, enc = context.partitionId(), encoder(tokenizer)
        wide = max(len(enc.width), end_id + 1) > 1 << 16
        filesystem, base = open_folder(folder)
        own = f"{base}/.shard-{shard:06d}.{context.taskAttemptId()}"
        sink, seq, offset, start = None, 0, 0, 0
        for batch in batches:
            for part in slices(batch, 8 << 20):
                if sink is None:
                    filesystem.create_dir(base, recursive=True)
                    sink = filesystem.open_output_stream(own)
                ids, counts = enc.encode(part.column(1))
                ids, bounds = with_end(ids, counts, end_id)
                who = part.column(0).to_pylist()
                raw, sizes = frame(who, ids, bounds, wide)
                sink.write(raw)
                n = len(who)
                lengths = sizes + HEADER + TRAILER
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, shard, np.int32)), pa.array(np.arange(seq, seq + n)),
                     pa.array(who, pa.int64()), pa.array(offset + np.cumsum(lengths) - lengths),
                     pa.array(lengths), pa.array(start + bounds[:-1]), pa.array(np.diff(bounds))],
                    ["shard", "seq", "doc_id", "offset", "length", "start", "n_tokens"])
                seq, offset, start = seq + n, offset + len(raw), start + int(bounds[-1])
        if sink is not None:
            sink.close()
            filesystem.move(own, f"{base}/shard-{shard:06d}")

    return folder, stage(map_arrow(parts, write, _INDEX), "record-index")


def read_records(folder: str, index: DataFrame) -> DataFrame:
    """Per record, from the files: doc_id, start (ids in all files before it), n_tokens, ids_crc32.

    Index rows are dealt out in blocks; a block reads its span of one file.
    """
    totals = index.groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    before = totals.select("shard", (F.sum("total").over(Window.orderBy("shard")) - F.col("total")).alias("before"))
    block = (F.col("seq") / READ_ROWS).cast("long")
    rows = (index.select("shard", "seq", "offset", "length", "start")
            .repartition(rows_per_task(index), F.col("shard"), block)
            .sortWithinPartitions("shard", "seq"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, base = open_folder(folder)
        for batch in batches:
            shard, seq, offset, length, start = (batch.column(i).to_numpy() for i in range(5))
            new = (np.diff(shard) != 0) | (np.diff(seq) != 1)
            span = np.cumsum(length) // (8 << 20)
            new |= np.diff(span) != 0
            cuts = np.concatenate(([0], np.flatnonzero(new) + 1, [len(shard)]))
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if a == b:
                    continue
                with filesystem.open_input_file(f"{base}/shard-{shard[a]:06d}") as f:
                    raw = f.read_at(int(offset[b - 1] + length[b - 1] - offset[a]), int(offset[a]))
                got = list(parse(raw))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard[a:b]), pa.array([d for d, _ in got], pa.int64()), pa.array(start[a:b]),
                     pa.array([len(x) for _, x in got], pa.int64()),
                     pa.array([zlib.crc32(x.astype("<u4").tobytes()) for _, x in got], pa.int64())],
                    ["shard", "doc_id", "start", "n_tokens", "ids_crc32"])

    got = map_arrow(rows, read, "shard int, doc_id long, start long, n_tokens long, ids_crc32 long")
    return (got.join(before, "shard")
            .select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"))
