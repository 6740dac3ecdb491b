"""Shared helpers of the text operators: staging, Arrow buffers, vectorised words.

Words are found and hashed on the UTF-8 bytes of a whole Arrow batch with
numpy, so no Python object is made per word. Long texts are cut into chunks at
separators only, which keeps the working memory of a task bounded.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from polyscore.session import scratch_path, ship_package

CHUNK = 1 << 20
#: Settings while a table is staged: shuffle files go with their job, and Arrow batches are
#: bounded in rows and bytes, so that a worker's memory doesn't follow the length of texts.
_STAGING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
            "spark.sql.shuffleDependency.fileCleanup.enabled": "true",
            "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
            "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts the lineage without relying on executor memory; the shuffle files of
    the finished job are released at its end.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = {}
    for key, value in _STAGING.items():
        try:
            before[key] = spark.conf.get(key, None)
            spark.conf.set(key, value)
        except Exception:  # the setting has another name in other Spark versions
            before.pop(key, None)
    try:
        df.write.parquet(path, compression=compression)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    return spark.read.schema(df.schema).parquet(path)


def release_memory() -> None:
    """Give what a finished task freed back to the system: workers are reused, and allocators keep it otherwise."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str) -> DataFrame:
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from fn(batches)
        finally:
            release_memory()

    return df.mapInArrow(run, schema)


def texts_of(df: DataFrame, *keep: str) -> DataFrame:
    """The named columns and ``text`` as UTF-8 bytes, null read as empty; nothing else is carried."""
    return df.select(*[F.col(c) for c in keep],
                     F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a binary or string column without nulls."""
    big = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if big else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    if column.buffers()[2] is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def slices(batch: pa.RecordBatch, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about ``most`` text bytes (one row at least)."""
    _, off = buffers(batch.column(batch.schema.get_field_index("text")))
    at = 0
    while at < batch.num_rows:
        end = int(np.searchsorted(off, off[at] + most, "right")) - 1
        end = min(max(end, at + 1), batch.num_rows)
        yield batch.slice(at, end - at)
        at = end


def space_lut(lower: bool) -> np.ndarray:
    """Byte values of words ``[^\\x20\\x09-\\x0D]+``; 0 marks a separator, others are value + 1."""
    lut = np.arange(1, 257, dtype=np.uint16)
    if lower:
        lut[65:91] += 32
    lut[[32, 9, 10, 11, 12, 13]] = 0
    return lut


def alnum_lut() -> np.ndarray:
    """Words of lower-cased ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``: digits, letters, all beyond ASCII."""
    lut = np.arange(1, 257, dtype=np.uint16)
    lut[65:91] += 32
    ascii_word = np.zeros(128, bool)
    ascii_word[48:58] = ascii_word[65:91] = ascii_word[97:123] = True
    lut[:128][~ascii_word] = 0
    return lut


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = np.asarray(x, np.uint64).copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _coefficients(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


_COEF = _coefficients(256)


def words(data: np.ndarray, offsets: np.ndarray, lut: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hash, start and end byte of every word; words never cross ``offsets``.

    A word's hash is a multilinear hash of its bytes with random coefficients,
    mixed with its length.
    """
    hashes, starts, ends = [], [], []
    at, n = 0, len(data)
    cut = offsets[1:-1]
    while at < n:
        end = min(n, at + CHUNK)
        if end < n:  # stop at a separator or a row's end
            part = lut[data[at:end]]
            sep = np.flatnonzero(part == 0)
            row = int(np.searchsorted(cut, end, "right"))
            last = int(cut[row - 1]) if row and cut[row - 1] > at else 0
            if len(sep):
                last = max(last, at + int(sep[-1]) + 1)
            while last <= at:  # one word longer than the chunk
                step = data[end:end + CHUNK]
                sep = np.flatnonzero(lut[step] == 0)
                row = int(np.searchsorted(cut, end, "left"))
                stops = [end + int(sep[0])] if len(sep) else []
                if row < len(cut) and cut[row] <= end + len(step):
                    stops.append(int(cut[row]))
                if not len(step):
                    stops.append(n)
                last, end = (min(stops) if stops else at), end + len(step)
            end = last
        h, s, e = _chunk(data[at:end], cut[(cut > at) & (cut < end)] - at, lut)
        hashes.append(h)
        starts.append(s + at)
        ends.append(e + at)
        at = end
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(starts), np.concatenate(ends)


def _chunk(data: np.ndarray, cut: np.ndarray, lut: np.ndarray):
    global _COEF
    v = lut[data]
    inside = v != 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    if len(cut):
        first[cut] = inside[cut]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    if len(cut):
        last[cut - 1] = inside[cut - 1]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last) + 1
    if not len(starts):
        return np.zeros(0, np.uint64), starts, ends
    at = np.flatnonzero(inside)
    length = ends - starts
    if length.max() > len(_COEF):
        _COEF = _coefficients(int(length.max()) * 2)
    begin = np.concatenate(([0], np.cumsum(length)[:-1]))
    place = np.arange(len(at)) - np.repeat(begin, length)
    with np.errstate(over="ignore"):
        h = np.add.reduceat(_COEF[place] * v[at].astype(np.uint64), begin)
        h = mix(h + length.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return h, starts, ends


def row_of(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The row that each word starts in."""
    return np.searchsorted(offsets[1:], starts, "right")


def ngrams(hashes: np.ndarray, n: int, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word's index of each run of ``n`` words within a row."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(row[:m] == row[n - 1:])
    coef = _coefficients(n + 7)[7:]
    with np.errstate(over="ignore"):
        h = np.zeros(len(at), np.uint64)
        for j in range(n):
            h += hashes[at + j] * coef[j]
        return mix(h + np.uint64(n)), at


def rows_per_task(df: DataFrame) -> int:
    """Shuffle partitions of the session, the grain of explicit salts."""
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
