"""Ranking and sampling without single-task windows over hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def rank_within(df: DataFrame, key: Sequence[str], order: Sequence, name: str = "idx") -> DataFrame:
    """0-based position of each row within its key group in a total order.

    A window partitioned by the key would sort a whole group in one task
    (one phenotype = every variant).  Instead the rows are range-sorted on
    (key, order) across all tasks, each task counts its rows per key, a
    running sum over those (tasks x keys sized) counts gives every task's
    offset per key, and the index is offset + row number inside the task.
    """
    from polyscore.session import scratch_dir
    scratch_dir(df.sparkSession)
    key = list(key)
    s = (df.repartitionByRange(*key, *order)
         .sortWithinPartitions(*key, *order)
         .withColumn("_t", F.spark_partition_id())
         .withColumn("_mid", F.monotonically_increasing_id())
         .checkpoint(eager=True))
    first = s.groupBy("_t", *key).agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n"))
    off = first.select("_t", *key, "_first",
                       F.coalesce(F.sum("_n").over(Window.partitionBy(*key).orderBy("_t")
                                                   .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
                       .alias("_off"))
    return (s.join(off, ["_t", *key])
            .withColumn(name, F.col("_off") + F.col("_mid") - F.col("_first"))
            .drop("_t", "_mid", "_first", "_off"))


def hash_order_key(col: str, seed: int) -> F.Column:
    """Repeatable pseudo-random order key of a sample id (replaces a random normal draw): md5(id || seed)."""
    return F.md5(F.concat(F.col(col).cast("string"), F.lit(str(seed))))


def top_n_per_group(df: DataFrame, group: Sequence[str], order: Sequence, n_col_or_int, name: str = "_rn") -> DataFrame:
    """Rows ranked < n within their group.

    ``row_number() <= n`` lets Spark insert a partial group limit before the
    shuffle (for n up to ``spark.sql.optimizer.windowGroupLimitThreshold``, which the
    session defaults raise), so a hot group ships at most n rows per map task.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    n = F.lit(n_col_or_int) if isinstance(n_col_or_int, int) else F.col(n_col_or_int)
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= n).drop(name)
