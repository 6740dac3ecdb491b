"""Numbers of tasks that follow the rows, so that what a task sorts or groups stays the same as tables grow."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Rows that a task sorts or groups (expected).
TASK_ROWS = 500_000


def tasks_for(spark: SparkSession, rows: int) -> int:
    """Tasks for so many rows, at least those that run at once."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))


@contextmanager
def joins_in(spark: SparkSession, tasks: int) -> Iterator[None]:
    """Joins and groups without a number of tasks of their own run in at least ``tasks`` while a dataset is written."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(max(tasks, int(before))))
    try:
        yield
    finally:
        spark.conf.set(key, before)
