"""Reshaping between the array form (parallel per-population arrays) and long tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polyscore.constants import P_THRESHOLDS, POPS


def pheno_data_arrays(pheno_pop: DataFrame, fields: Sequence[str] = ("n_cases", "n_controls", "heritability", "lambda_gc"),
                      key: str = "pid") -> DataFrame:
    """Column dimension in array form: (key, pheno_data ARRAY<STRUCT<pop, ...>>) in population order.

    The collected array per phenotype is bounded by the number of populations.
    """
    st = F.struct(F.col("pop"), *[F.col(f) for f in fields])
    return pheno_pop.groupBy(key).agg(F.array_sort(F.collect_list(st)).alias("pheno_data"))


def summary_stat_arrays(stats: DataFrame, pheno_data: DataFrame, fields: Sequence[str],
                        key: str = "pid", row_key: str = "vid") -> DataFrame:
    """Entries in array form, aligned with pheno_data: element i is population pheno_data[i].pop or null.

    One shuffle on (key, row_key); each group is bounded by the number of populations.
    """
    pos = pheno_data.select(key, F.posexplode(F.col("pheno_data.pop")).alias("i", "pop"))
    st = F.struct(*[F.col(f) for f in fields])
    g = (stats.join(pos, [key, "pop"])
         .groupBy(key, row_key).agg(F.map_from_entries(F.collect_list(F.struct("i", st))).alias("_m")))
    sizes = pheno_data.select(key, F.size("pheno_data").alias("_n"))
    return (g.join(sizes, key)
            .select(key, row_key, F.transform(F.sequence(F.lit(0), F.col("_n") - 1),
                                              lambda i: F.try_element_at(F.col("_m"), i)).alias("summary_stats")))


def separate_by_pop(cols: DataFrame, entries: DataFrame, col_field: str = "pheno_data",
                    entry_field: str = "summary_stats", key: str = "pid", keep_index: bool = False) -> DataFrame:
    """Explode the column array with its index and pick the matching entry element.

    Returns entries with one row per (entry, population of its column);
    ``col_field`` and ``entry_field`` become the single struct of that population.
    """
    ex = cols.select(key, F.posexplode(col_field).alias("pop_index", col_field))
    out = (entries.join(ex, key)
           .withColumn(entry_field, F.get(F.col(entry_field), F.col("pop_index"))))
    return out if keep_index else out.drop("pop_index")


def explode_thresholds(cols: DataFrame, thresholds=P_THRESHOLDS) -> DataFrame:
    """Each column row x the thresholds (name, value); a generator over a constant list, no join."""
    arr = F.array(*[F.struct(F.lit(n).alias("p_threshold_name"), F.lit(float(t)).alias("p_threshold"))
                    for n, t in thresholds])
    return cols.select("*", F.inline(arr))


def wide_by_pop(df: DataFrame, keys: Sequence[str], fields: Sequence[str], pops: Sequence[str] = POPS,
                pop_col: str = "pop", name: str = "{field}_{pop}") -> DataFrame:
    """Conditional aggregation to one column per (field, population), field-major.

    The population list is fixed, so no pivot scan is needed to find it.
    """
    aggs = [F.max(F.when(F.col(pop_col) == p, F.col(f))).alias(name.format(field=f, pop=p))
            for f in fields for p in pops]
    return df.groupBy(*keys).agg(*aggs)


def split_snp(df: DataFrame, snp: str = "SNP") -> DataFrame:
    """chr:pos:a1:a2 -> chr, pos, a1, a2 columns; the id is kept."""
    parts = F.split(F.col(snp), ":")
    return df.select(F.get(parts, 0).alias("chr"), F.get(parts, 1).try_cast("int").alias("pos"),
                     F.get(parts, 2).alias("a1"), F.get(parts, 3).alias("a2"), "*")


def to_matrix(df: DataFrame, row_key: Sequence[str], col_key: Sequence[str], row_fields: Sequence[str],
              col_fields: Sequence[str], entry_fields: Sequence[str]):
    """Split a flat table into (rows, cols, entries) dimensions keyed by their keys."""
    rows = df.select(*row_key, *row_fields).dropDuplicates(list(row_key))
    cols = df.select(*col_key, *col_fields).dropDuplicates(list(col_key))
    entries = df.select(*row_key, *col_key, *entry_fields)
    return rows, cols, entries


def add_dim_index(df: DataFrame, order: Sequence[str], name: str = "idx") -> DataFrame:
    """0-based index of a dimension table in a total order, without a single-task window.

    The table is range-sorted and checkpointed (so both passes see the same
    partitions); each partition's row count gives its offset; the index is
    offset + position within the partition.
    """
    from pyspark.sql import Window

    from polyscore.session import scratch_dir
    scratch_dir(df.sparkSession)
    sorted_df = (df.orderBy(*order)
                 .withColumn("_p", F.spark_partition_id())
                 .withColumn("_mid", F.monotonically_increasing_id())
                 .checkpoint(eager=True))
    counts = sorted_df.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_p", (F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)))
                            .alias("_off"))
    within = F.col("_mid") - F.shiftleft(F.col("_p").cast("long"), 33)
    return (sorted_df.join(F.broadcast(offsets), "_p")
            .withColumn(name, F.coalesce(F.col("_off"), F.lit(0)) + within)
            .drop("_p", "_mid", "_off"))


def densify_thresholds(weights: DataFrame, thresholds=P_THRESHOLDS, beta: str = "beta", p: str = "p") -> DataFrame:
    """Make every (cell, threshold) present: weight = beta if P < t else 0.0 (missing or NaN -> 0.0).

    The study densifies the whole variants x columns grid so a dense block
    matrix can be written; in long form an absent cell already means weight
    0, so only cells present at some threshold are expanded, by a generator
    over the constant threshold list (no cartesian product with the grid).
    """
    arr = F.array(*[F.struct(F.lit(n).alias("p_threshold_name"), F.lit(float(t)).alias("p_threshold"))
                    for n, t in thresholds])
    w = weights.select("*", F.inline(arr))
    val = F.when(F.col(beta).isNotNull() & ~F.isnan(beta) & (F.col(p) < F.col("p_threshold")), F.col(beta))
    return w.withColumn("weight", F.coalesce(val, F.lit(0.0)))
