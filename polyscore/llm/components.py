"""Connected components of a table of links, by alternating large and small stars.

Each round replaces the links of every node by links to the smallest node it
sees; the smallest node's own row does not grow. No link, node or component
leaves the executors; each round's links are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polyscore.llm.common import stage


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One star step over links (a, b) with a < b."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        both = links.select(F.col("b").alias("u"), F.col("a").alias("v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = both.join(least, "u")
    if large:
        out = joined.where(F.col("v") > F.col("u")).select(F.col("m").alias("a"), F.col("v").alias("b"))
    else:
        out = (joined.select(F.col("m").alias("a"), F.col("v").alias("b"))
               .unionByName(least.select(F.col("m").alias("a"), F.col("u").alias("b"))))
    return out.where(F.col("a") < F.col("b")).distinct()


def components(links: DataFrame, name: str = "links") -> DataFrame:
    """``node`` and the smallest node ``root`` of its component, for nodes in ``links`` (a, b) that aren't roots."""
    ordered = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where(F.col("a") < F.col("b"))
    now = stage(ordered.distinct(), name)
    seen = None
    while True:
        now = stage(_star(_star(now, True), False), name)
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            return now.select(F.col("b").alias("node"), F.col("a").alias("root"))
        seen = state
