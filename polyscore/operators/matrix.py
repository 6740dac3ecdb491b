"""Blocks of a samples x phenotypes matrix: its cells outnumber the rows of both axes by far, so they are never shuffled."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Blocks:
    """A grid of ``rows`` x ``cols`` blocks that cells fall into by the hashes of their sample and phenotype.

    Tables of cells, of samples and of phenotypes are dealt by ``block`` to the same
    number of tasks: a join on the block and a key needs no further shuffle.
    """

    rows: int
    cols: int
    tasks: int
    user: str = "user_id"
    pid: str = "pid"

    def _row(self) -> Column:
        return F.pmod(F.xxhash64(self.user), F.lit(self.rows)).cast("int")

    def _col(self) -> Column:
        return F.pmod(F.xxhash64(self.pid), F.lit(self.cols)).cast("int")

    def deal(self, df: DataFrame) -> DataFrame:
        return df.repartition(self.tasks, "block")

    def of_cells(self, df: DataFrame) -> DataFrame:
        """Rows with a sample and a phenotype, each in its block."""
        return self.deal(df.withColumn("block", self._row() * self.cols + self._col()))

    def of_samples(self, df: DataFrame) -> DataFrame:
        """Rows with a sample, once in each block that has its cells."""
        every = F.explode(F.sequence(F.lit(0), F.lit(self.cols - 1)))
        return self.deal(df.select("*", every.alias("_c")).withColumn("block", self._row() * self.cols + F.col("_c")).drop("_c"))

    def of_phenos(self, df: DataFrame) -> DataFrame:
        """Rows with a phenotype, once in each block that has its cells."""
        every = F.explode(F.sequence(F.lit(0), F.lit(self.rows - 1)))
        return self.deal(df.select("*", every.alias("_r")).withColumn("block", F.col("_r") * self.cols + self._col()).drop("_r"))


def join_by_block(spark: SparkSession) -> None:
    """Let joins on the block and further keys use tables dealt by the block alone."""
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
