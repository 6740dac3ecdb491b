"""Sample cohorts and allele-file repair."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polyscore.functions import ids
from polyscore.operators.joins import unordered_allele_key


def cohort(covariates: DataFrame, qc_list: DataFrame, withdrawn: DataFrame, pop: str | None = None,
           key: str = "user_id") -> DataFrame:
    """Covariate samples that pass QC, minus withdrawn samples, optionally of one population."""
    c = covariates.join(qc_list.select(key).distinct(), key, "left_semi").join(withdrawn.select(key), key, "left_anti")
    return c.where(F.col("pop") == pop) if pop else c


def fix_alleles(allele_file: DataFrame, variants: DataFrame) -> DataFrame:
    """Match file rows to variants on (chrom, pos, unordered alleles); rebuild SNP in ref:alt order.

    Unmatched rows keep a null SNP; the file order ``idx`` is restored on output.
    """
    f = allele_file.withColumn("_k", unordered_allele_key("a1", "a2"))
    v = variants.select("chrom", "pos", unordered_allele_key("ref", "alt").alias("_k"),
                        ids.variant_id().alias("SNP"))
    return (f.join(v, ["chrom", "pos", "_k"], "left")
            .select("idx", "chrom", "SNP", "pos", F.col("a1").alias("A1_bim"), F.col("a2").alias("A2_bim"))
            .orderBy("idx"))


def filtered_genotypes(dosage: DataFrame, variant_counts: DataFrame, cohort_samples: DataFrame,
                       analysed_variants: DataFrame, *, pop: str = "all", min_count: int | None = None) -> DataFrame:
    """Genotypes of cohort samples at variants with enough alleles that were analysed.

    ``variant_counts`` has (vid, af MAP, an MAP); a variant passes when
    af*an >= min_count in any population (or in ``pop``).  All three
    restrictions are left-semi joins, so only genotype columns flow on.
    """
    from polyscore.constants import MIN_ALLELE_COUNT
    from polyscore.operators.filters import min_allele_count
    n = MIN_ALLELE_COUNT if min_count is None else min_count
    ok = variant_counts.where(min_allele_count("af_map", "an_map", pops=None if pop == "all" else [pop], min_count=n))
    s = cohort_samples if pop == "all" else cohort_samples.where(F.col("pop") == pop)
    return (dosage.join(ok.select("vid"), "vid", "left_semi")
            .join(s.select("user_id"), "user_id", "left_semi")
            .join(analysed_variants.select("vid").distinct(), "vid", "left_semi"))
