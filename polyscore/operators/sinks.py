"""Sinks and materialisation: checkpoints, per-key files, batches, resumable parts."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from polyscore.operators.deal import tasks_for
from polyscore.session import create_exclusive, file_ages, move, path_exists, staging


#: Writer option for many folders: tasks move their own files into place, not the driver one after the other.
#: A failed write leaves files behind, so only for folders that count as written with their _SUCCESS marker.
TASKS_COMMIT = ("mapreduce.fileoutputcommitter.algorithm.version", "2")


def materialize(df: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """Write then re-read (cuts lineage; survives executor loss).

    ``mode='read_if_exists'`` re-uses a finished write (``_SUCCESS`` marker);
    ``'overwrite'`` always rewrites; ``'error'`` refuses an existing path.
    """
    spark = df.sparkSession
    if mode == "read_if_exists":
        if path_exists(spark, f"{path}/_SUCCESS"):
            return spark.read.parquet(path)
        mode = "overwrite"
    with staging(spark):
        df.write.mode(mode).parquet(path)
    return spark.read.parquet(path)


def write_per_key(df: DataFrame, path: str, key: str, *, sort_by: Sequence[str] = (),
                  sep: str = "\t", compression: str = "gzip", max_records: int | None = None) -> None:
    """One folder of delimited files per key value (e.g. per phenotype).

    Rows are dealt by ranges of (key, sort_by), so a large key is spread over
    as many tasks as it fills and its files, in name order, are sorted; without
    ``sort_by`` a key is written by one task.  NA marks missing values.
    ``df`` is evaluated for its size and for its rows; store it first where that is dear.
    """
    if sort_by:
        w = df.repartitionByRange(tasks_for(df.sparkSession, df.count()), key, *sort_by).sortWithinPartitions(key, *sort_by)
    else:
        w = df.repartition(key)
    writer = (w.write.mode("overwrite").partitionBy(key).option("sep", sep).option("header", True)
              .option("nullValue", "NA").option("compression", compression).option(*TASKS_COMMIT))
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    writer.csv(path)


def write_delimited(df: DataFrame, path: str, *, sep: str = "\t", header: bool = True,
                    compression: str | None = None, single_file: bool = False) -> None:
    out = df.coalesce(1) if single_file else df
    w = out.write.mode("overwrite").option("sep", sep).option("header", header).option("nullValue", "NA")
    if compression:
        w = w.option("compression", compression)
    w.csv(path)


def claim_batch(spark: SparkSession, path: str, name: str = "batch", stale_after: float | None = None) -> int:
    """An exclusive batch number: its marker ``path/_claims/<name><n>`` didn't exist before.

    Numbers ascend from 1. With ``stale_after`` an abandoned claim (no finished
    batch, last marker older than so many seconds) is taken over instead, by a retry
    marker that is exclusive as well.
    """
    claims = f"{path}/_claims"
    ages = file_ages(spark, claims)
    if stale_after is not None:
        for n in abandoned_batches(spark, path, name):
            tries = [a for f, a in ages.items() if re.fullmatch(rf"{re.escape(name)}{n}(\.retry\d+)?", f)]
            if min(tries) > stale_after and create_exclusive(spark, f"{claims}/{name}{n}.retry{len(tries)}"):
                return n
    taken = _numbers(ages, name) | _numbers(file_ages(spark, path), name)
    n = max(taken, default=0) + 1
    while not create_exclusive(spark, f"{claims}/{name}{n}"):
        n += 1
    return n


def _numbers(names, name: str) -> set[int]:
    return {int(m[1]) for f in names if (m := re.fullmatch(rf"{re.escape(name)}(\d+)", f))}


def abandoned_batches(spark: SparkSession, path: str, name: str = "batch") -> list[int]:
    """Claimed numbers without a finished batch: their writers failed or are still at work."""
    return sorted(_numbers(file_ages(spark, f"{path}/_claims"), name) - _numbers(file_ages(spark, path), name))


def publish_batch(spark: SparkSession, path: str, write: Callable[[str], None], name: str = "batch",
                  stale_after: float | None = None) -> str:
    """Write a new batch beside the others, then give it its claimed name; returns its folder.

    Readers of ``path`` see whole batches only: claims and unfinished work lie in
    folders with an underscore. A batch whose name came to exist meanwhile (its claim was taken over) isn't replaced.
    """
    n = claim_batch(spark, path, name, stale_after)
    work = f"{path}/_work/{name}{n}-{uuid.uuid4().hex[:12]}"
    write(work)
    target = f"{path}/{name}{n}"
    move(spark, work, target)
    return target


def append_batch(df: DataFrame, path: str, batch_col: str = "batch", stale_after: float | None = None) -> int:
    """Append df as a batch of its own, a partition of ``path``; never clobbers another, also with writers at once."""
    target = publish_batch(df.sparkSession, path, lambda work: df.write.parquet(work), f"{batch_col}=", stale_after)
    return int(target.rpartition("=")[2])


def write_parts(df: DataFrame, path: str, part_col: str = "part_id") -> None:
    """Write (or rewrite) only the parts present in df; other parts stay untouched."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(part_col).parquet(path))


def missing_parts(wanted: DataFrame, spark: SparkSession, path: str, part_col: str = "part_id") -> DataFrame:
    """Wanted part ids that have no finished data under path (left-anti join)."""
    if not path_exists(spark, path):
        return wanted.select(part_col).distinct()
    present = spark.read.parquet(path).select(part_col).distinct()
    return wanted.select(part_col).distinct().join(present, part_col, "left_anti")


def is_primitive(dt: T.DataType) -> bool:
    return isinstance(dt, (T.AtomicType, T.NullType))


def select_primitives(df: DataFrame, sep: str = ".") -> DataFrame:
    """Flatten nested structs to top level and keep only primitive-typed columns."""
    cols = []

    def walk(prefix: list[str], dt: T.DataType):
        if isinstance(dt, T.StructType):
            for f in dt.fields:
                walk(prefix + [f.name], f.dataType)
        elif is_primitive(dt):
            cols.append(F.col(".".join(f"`{p}`" for p in prefix)).alias(sep.join(prefix)))

    for f in df.schema.fields:
        walk([f.name], f.dataType)
    return df.select(*cols)
