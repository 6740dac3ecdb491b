"""Sums over the pairs of weights and calls that share a variant, without a shuffle of the pairs.

A variant with m weights and n calls makes m * n products, far more than the
rows of either side. So the sides are shuffled, not the products: the pairs of
(sample, score column) are a grid of ``rows`` x ``cols`` tasks by the hashes of
both, a call goes to the tasks of its sample's row, a weight to those of its
column. A grid of t tasks ships about ``sqrt(t)`` times the rows of either side.

Rows travel as cells: columns of some thousand rows, sorted by variant, with
whole numbers in as many byte planes as their range needs, then zstd. A task
holds the weights of its columns (``HELD`` at most, expected) by variant; the
calls of its samples pass by in parts of about ``CALLS`` by the hash of the
sample, and the products of about ``PRODUCTS`` of them are sorted and summed at a time.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from polyscore.session import ship_package

#: Weights that a task holds, products that it forms, and calls of a part of its samples (expected).
HELD, TASK_PRODUCTS, CALLS = 10_000_000, 128_000_000, 500_000
#: Products that are summed at once, and rows that a map task packs at once.
PRODUCTS, PACKED = 500_000, 1_000_000
#: Parts of a task's weights by the hash of the variant: one of them is sorted at a time.
PARTS = 16
#: Rows of a batch that is returned, and bytes of cells that a task is given at once.
OUT, BATCH = 65_536, "32m"
_ZSTD = pa.Codec("zstd", compression_level=1)


def grid(weights: int, calls: int, products: int, at_once: int) -> tuple[int, int]:
    """(rows, cols) of the tasks: bounded weights and products in a task, the fewest rows shipped."""
    tasks = max(at_once, -(-products // TASK_PRODUCTS))
    least = max(1, -(-weights // HELD))
    return min(((max(1, -(-tasks // cols)), cols) for cols in range(least, max(least, tasks) + 1)),
               key=lambda rc: rc[0] * weights + rc[1] * calls)


def _planes(x: np.ndarray) -> tuple:
    """Whole numbers above their least, a byte plane for each byte that the range needs."""
    low = int(x.min())
    above = x.astype(np.int64, copy=False).view(np.uint64) - np.uint64(low % 2**64)
    width = max(1, (int(above.max()).bit_length() + 7) // 8)
    return "int", low, width, np.ascontiguousarray(above.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _whole(kind, low: int, width: int, planes: bytes) -> np.ndarray:
    above = np.zeros((len(planes) // width, 8), np.uint8)
    above[:, :width] = np.frombuffer(planes, np.uint8).reshape(width, -1).T
    return (above.view("<u8").reshape(-1) + np.uint64(low % 2**64)).view(np.int64)


def _packed(column: pa.Array) -> tuple:
    """A column of a cell: whole numbers, their steps where these aren't negative, doubles that are whole, other doubles, or a dictionary and places in it."""
    if not column.null_count:
        if pa.types.is_integer(column.type):
            x = column.to_numpy(zero_copy_only=False).astype(np.int64)
            steps = np.diff(x)
            if len(steps) and x[0] <= x[-1] and steps.min() >= 0:  # in order: the first and the steps
                return ("steps", int(x[0]), *_planes(steps)[1:])
            return _planes(x)
        if pa.types.is_float64(column.type):
            x = column.to_numpy(zero_copy_only=False)
            if np.all(np.abs(x) < 2**52):  # not for NaN
                whole = x.astype(np.int64)
                if np.array_equal(whole.astype(np.float64).view(np.int64), x.view(np.int64)):  # -0.0 isn't whole here
                    return ("whole", *_planes(whole)[1:])
            return "double", np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8).T).tobytes()
    coded = column.dictionary_encode(null_encoding="encode")
    return "coded", coded.dictionary, _planes(coded.indices.to_numpy(zero_copy_only=False))


def _column(packed: tuple, kind: pa.DataType) -> pa.Array:
    if packed[0] == "int":
        return pa.array(_whole(*packed)).cast(kind)
    if packed[0] == "steps":
        return pa.array(np.concatenate(([packed[1]], packed[1] + np.cumsum(_whole("int", *packed[2:]))))).cast(kind)
    if packed[0] == "whole":
        return pa.array(_whole(*packed).astype(np.float64))
    if packed[0] == "double":
        return pa.array(np.ascontiguousarray(np.frombuffer(packed[1], np.uint8).reshape(8, -1).T).view(np.float64).reshape(-1))
    return packed[1].take(pa.array(_whole(*packed[2])))


def _cell(columns: Sequence[pa.Array]) -> bytes:
    """Columns of a cell as they are shuffled: its length, then zstd."""
    plain = pickle.dumps([_packed(c) for c in columns], protocol=5)
    return len(plain).to_bytes(8, "little") + _ZSTD.compress(plain, asbytes=True)


def _columns(cell: pa.Buffer, kinds: Sequence[pa.DataType]) -> list[pa.Array]:
    cell = memoryview(cell)
    plain = _ZSTD.decompress(cell[8:], decompressed_size=int.from_bytes(cell[:8], "little"), asbytes=True)
    return [_column(p, kind) for p, kind in zip(pickle.loads(plain), kinds)]


def _cells(df: DataFrame, band: F.Column, part: F.Column, columns: Sequence[str]) -> DataFrame:
    """(band, part, cell): the rows of either in cells, sorted by the first of ``columns``."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(rows).combine_chunks()
            band, place, variant = (table.column(c).combine_chunks() for c in ("_band", "_part", columns[0]))
            if not pa.types.is_integer(variant.type):
                variant = variant.dictionary_encode().indices
            _, group = np.unique(band.to_numpy().astype(np.int64) << 32 | place.to_numpy(), return_inverse=True)
            order = np.argsort(variant.to_numpy())
            order = order[np.argsort(group[order].astype(np.uint16 if group.max() < 2**16 else np.int64), kind="stable")]
            ends = np.cumsum(np.bincount(group)).tolist()
            taken = [table.column(c).combine_chunks().take(pa.array(order)) for c in columns]
            ids = [x.to_numpy()[order] for x in (band, place)]
            for lo, hi in zip([0, *ends], ends):
                cell = _cell([c.slice(lo, hi - lo) for c in taken])
                yield pa.RecordBatch.from_arrays([pa.array([int(x[lo])], pa.int32()) for x in ids] + [pa.array([cell], pa.binary())],
                                                 ["band", "part", "cell"])

        rows, n = [], 0
        for batch in batches:
            if batch.num_rows:
                rows.append(batch)
                n += batch.num_rows
            if n >= PACKED:
                yield from flush(rows)
                rows, n = [], 0
        if n:
            yield from flush(rows)

    return (df.select(band.cast("int").alias("_band"), part.cast("int").alias("_part"), *columns)
            .mapInArrow(pack, "band int, part int, cell binary"))


class _Codes:
    """Numbers of the values met so far, null among them."""

    def __init__(self, kind: pa.DataType):
        self.values = pa.array([], kind)

    def of(self, column: pa.Array) -> np.ndarray:
        coded = column.dictionary_encode(null_encoding="encode")
        new = coded.dictionary.filter(pc.is_null(pc.index_in(coded.dictionary, value_set=self.values)))
        self.values = pa.concat_arrays([self.values, new])
        code = pc.index_in(coded.dictionary, value_set=self.values).to_numpy(zero_copy_only=False).astype(np.int64)
        return code[coded.indices.to_numpy(zero_copy_only=False)]


class _Keys:
    """Numbers of score columns: a key's values have numbers, and each pair of what is left of it and its own has one."""

    def __init__(self, kinds: Sequence[pa.DataType]):
        self.each = [_Codes(kind) for kind in kinds]
        self.pairs = [_Codes(pa.int64()) for _ in kinds[1:]]

    def of(self, columns: Sequence[pa.Array]) -> np.ndarray:
        code = self.each[0].of(columns[0])
        for each, pairs, column in zip(self.each[1:], self.pairs, columns[1:]):
            code = pairs.of(pa.array(code << 32 | each.of(column)))
        return code

    def values(self, code: np.ndarray) -> list[pa.Array]:
        out = []
        for each, pairs in zip(self.each[:0:-1], self.pairs[::-1]):
            pair = pairs.values.to_numpy()[code]
            out.append(each.values.take(pa.array(pair & (2**32 - 1))))
            code = pair >> 32
        return [self.each[0].values.take(pa.array(code)), *out[::-1]]


class _Weights:
    """Weights by variant: those of variant ``at[i]`` lie at ``first[i]`` and after, ``count[i]`` of them."""

    def __init__(self, kinds: dict, keys: Sequence[str]):
        self.keys = _Keys([kinds[k] for k in keys])
        self.kind = kinds["variant"]
        self.parts, self.n = [], 0

    def add(self, cells: list[list[pa.Array]]) -> None:
        """The cells of a part: all weights of its variants."""
        variant, beta, bucket, *keys = [pa.concat_arrays(c) for c in zip(*cells)]
        code = self.keys.of(keys)
        coded = variant.dictionary_encode()
        place = coded.indices.to_numpy(zero_copy_only=False)
        order = np.argsort(place, kind="stable")
        count = np.bincount(place, minlength=len(coded.dictionary))
        beta = beta.to_numpy(zero_copy_only=False)[order]
        short = beta.astype(np.float32)
        self.parts.append((coded.dictionary, self.n + np.cumsum(count) - count, count, code[order].astype(np.int32),
                           bucket.to_numpy(zero_copy_only=False)[order].astype(np.int8), short if np.array_equal(short, beta) else beta))
        self.n += len(order)

    def finish(self) -> None:
        at, first, count, col, bucket, beta = zip(*self.parts)
        self.parts = []
        at, self.first, self.count = pa.concat_arrays(at), np.concatenate(first), np.concatenate(count)
        order = pc.sort_indices(at).to_numpy()
        at, self.first, self.count = at.take(pa.array(order)), self.first[order], self.count[order]
        self.at = at.to_numpy() if pa.types.is_integer(self.kind) else at
        self.col, self.bucket, self.beta = (np.concatenate(x) for x in (col, bucket, beta))

    def find(self, variant: pa.Array) -> np.ndarray:
        """Places of variants among those with weights, -1 for others."""
        if not pa.types.is_integer(self.kind):
            return pc.fill_null(pc.index_in(variant, value_set=self.at), -1).to_numpy().astype(np.int64)
        v = variant.to_numpy(zero_copy_only=False)
        place = np.minimum(np.searchsorted(self.at, v), len(self.at) - 1)
        return np.where(self.at[place] == v, place, -1)


def _sums(held: _Weights, cells: list[list[pa.Array]], sums: int | None, nested: bool) -> Iterator[list[pa.Array]]:
    """(sample, *keys, sums) of a part of the samples: all of their calls."""
    place = np.concatenate([held.find(c[0]) for c in cells])
    sample = pa.concat_arrays([c[1] for c in cells]).dictionary_encode(null_encoding="encode")
    dosage = pa.concat_arrays([c[2] for c in cells]).to_numpy(zero_copy_only=False)
    user = sample.indices.to_numpy(zero_copy_only=False)
    met = np.flatnonzero(place >= 0)
    met = met[np.argsort(user[met], kind="stable")]
    place, user, dosage = place[met], user[met], dosage[met]
    if not len(user):
        return
    last = np.flatnonzero(np.append(np.diff(user) != 0, True))  # the last call of each sample
    made = np.cumsum(held.count[place])[last]
    one, lo = 0, 0
    while one < len(last):  # whole samples, one at least
        one = max(one + 1, int(np.searchsorted(made, (made[one - 1] if one else 0) + PRODUCTS, side="right")))
        hi = int(last[one - 1]) + 1
        yield from _summed(held, sample.dictionary, place[lo:hi], user[lo:hi], dosage[lo:hi], sums, nested)
        lo = hi


def _summed(held: _Weights, samples: pa.Array, place, user, dosage, sums: int | None, nested: bool) -> Iterator[list[pa.Array]]:
    count = held.count[place]
    call = np.repeat(np.arange(len(place)), count)
    weight = np.repeat(held.first[place] - np.cumsum(count) + count, count) + np.arange(len(call))
    cell = user[call].astype(np.int64) << 32 | held.col[weight]
    order = np.argsort(cell)
    cell, weight = cell[order], weight[order]
    x = held.beta[weight].astype(np.float64) * dosage[call[order]]
    first = np.flatnonzero(np.concatenate(([True], np.diff(cell) != 0)))
    cell = cell[first]
    if sums is None:
        found = [(np.add.reduceat(x, first) + 0.0, None)]  # no -0.0, as a sum from 0 on
    else:
        bucket, found = held.bucket[weight], []
        for i in range(sums):
            of = bucket <= i if nested else bucket == i
            found.append((np.add.reduceat(np.where(of, x, 0.0), first) + 0.0, ~np.logical_or.reduceat(of, first)))
    for lo in range(0, len(cell), OUT):
        some = slice(lo, lo + OUT)
        yield [samples.take(pa.array(cell[some] >> 32)), *held.keys.values(cell[some] & (2**32 - 1)),
               *[pa.array(s[some], mask=None if none is None else none[some]) for s, none in found]]


def factored_sums(weights: DataFrame, calls: DataFrame, *, variant: str, sample: str, keys: Sequence[str], beta: str, dosage: str,
                  sizes: tuple[int, int, int], out: Sequence[str], bucket: str | None = None, nested: bool = True) -> DataFrame:
    """(sample, *keys, *out): sums of beta * dosage (doubles) over the shared variants, none of which is null.

    Without ``bucket`` one sum, else one for each number i of a bucket: over the buckets up to i (``nested``)
    or over bucket i, null where it has no product. ``sizes`` are the numbers of weights, calls and products.
    """
    spark = weights.sparkSession
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH)  # cells are wide
    n_weights, n_calls, products = sizes
    rows, cols = grid(n_weights, n_calls, products, spark.sparkContext.defaultParallelism)
    parts = max(1, -(-n_calls // (rows * CALLS)))
    by = lambda n, *names: F.pmod(F.xxhash64(*names), F.lit(n))
    w = weights.select(F.col(variant).alias("variant"), F.col(beta).alias("_beta"),
                       (F.col(bucket).cast("tinyint") if bucket else F.lit(0).cast("tinyint")).alias("_bucket"), *keys)
    d = calls.select(F.col(variant).alias("variant"), F.col(sample).alias("_sample"), F.col(dosage).alias("_dosage"))
    ours = _cells(w, by(cols, *keys), by(PARTS, "variant"), ["variant", "_beta", "_bucket", *keys])
    theirs = _cells(d, by(rows * parts, "_sample") % rows, by(rows * parts, "_sample"), ["variant", "_sample", "_dosage"])
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    ready = (ours.select(every(rows).alias("row"), F.col("band").alias("col"), F.lit(0).alias("kind"), "part", "cell")
             .unionByName(theirs.select(F.col("band").alias("row"), every(cols).alias("col"), F.lit(1).alias("kind"), "part", "cell"))
             .select((F.col("row") * cols + F.col("col")).alias("task"), "kind", "part", "cell")
             .repartitionById(rows * cols, "task").sortWithinPartitions("kind", "part"))

    from pyspark.sql.pandas.types import to_arrow_schema
    kinds = {f.name: f.type for f in to_arrow_schema(T.StructType([*w.schema.fields, *d.schema.fields[1:]]))}
    shapes = [[kinds[c] for c in ("variant", "_beta", "_bucket", *keys)], [kinds[c] for c in ("variant", "_sample", "_dosage")]]
    names, keys, sums = [sample, *keys, *out], list(keys), len(out) if bucket else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now, cells = _Weights(kinds, keys), None, []

        def settle() -> Iterator[list[pa.Array]]:
            if now is not None and now[0] == 0:
                held.add(cells)
            elif now is not None and held.n:
                if held.parts:
                    held.finish()
                yield from _sums(held, cells, sums, nested)

        for batch in batches:
            for i, at in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                if at != now:
                    for columns in settle():
                        yield pa.RecordBatch.from_arrays(columns, names)
                    now, cells = at, []
                cells.append(_columns(batch.column(3)[i].as_buffer(), shapes[at[0]]))
        for columns in settle():
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = T.StructType([T.StructField(n, s.dataType) for n, s in zip(
        names, [d.schema["_sample"], *[w.schema[k] for k in keys], *[T.StructField("", T.DoubleType())] * len(out)])])
    return ready.mapInArrow(run, schema)
