"""Final summary statistics with the study's five optional steps, in fixed order.

QC join -> phenotype filter (lambda-GC) -> statistic filter (low confidence)
-> variant filter (high quality) -> gene annotation -> separation by population.

Works on the array form (one row per (phenotype, variant) with the
per-population statistics as an array aligned to the phenotype's
``pheno_data``), which is how the study stores its results; the index
filtering keeps both arrays aligned with higher-order functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polyscore.functions.arrays import kept_indices, take_indices
from polyscore.operators.filters import lambda_gc_ok
from polyscore.operators.joins import genes_containing
from polyscore.operators.reshape import separate_by_pop

STAT_FIELDS = ["af", "af_cases", "af_controls", "beta", "se", "p", "low_confidence"]


def filter_phenos_by_lambda(cols: DataFrame, entries: DataFrame, key: str = "pid"):
    """Keep population indices with 0.5 < lambda < 2 in both arrays; drop phenotypes left empty."""
    c = (cols.withColumn("pheno_indices", kept_indices("pheno_data", lambda x: lambda_gc_ok(x["lambda_gc"])))
         .withColumn("pheno_data", take_indices("pheno_data", "pheno_indices"))
         .where(F.size("pheno_data") > 0))
    e = (entries.join(c.select(key, "pheno_indices"), key)
         .withColumn("summary_stats", take_indices("summary_stats", "pheno_indices"))
         .drop("pheno_indices"))
    return c.drop("pheno_indices"), e


def filter_low_confidence(entries: DataFrame) -> DataFrame:
    """Null out low-confidence (or unknown-confidence) statistics; drop entries with no p-value left."""
    e = entries.withColumn("summary_stats",
                           F.transform("summary_stats", lambda x: F.when(~x["low_confidence"], x)))
    return e.where(F.exists("summary_stats", lambda x: x["p"].isNotNull()))


def final_sumstats(cols: DataFrame, entries: DataFrame, variant_qc: DataFrame, genes: DataFrame | None = None, *,
                   filter_phenos: bool = True, filter_sumstats: bool = True, filter_variants: bool = True,
                   genes_by_overlap: bool = True, separate: bool = True, key: str = "pid",
                   row_key: str = "vid") -> DataFrame:
    """Array-form (cols, entries) -> filtered statistics, long by population when ``separate``."""
    e = entries.join(variant_qc, row_key, "left")
    c = cols
    if filter_phenos:
        c, e = filter_phenos_by_lambda(c, e, key)
    if filter_sumstats:
        e = filter_low_confidence(e)
    if filter_variants:
        e = e.where(F.col("high_quality"))
    if genes_by_overlap and genes is not None:
        vg = genes_containing(variant_qc.select(row_key, "chrom", "pos"), genes, key=row_key)
        e = e.join(vg.select(row_key, "nearest_genes"), row_key, "left")
    if separate:
        return separate_by_pop(c, e, key=key)
    return e.join(c, key)
