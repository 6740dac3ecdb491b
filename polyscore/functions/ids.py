"""Phenotype and variant identifiers (built-in expressions only)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def pheno_id(trait_type="trait_type", phenocode="phenocode", pheno_sex="pheno_sex",
             coding="coding", modifier="modifier") -> Column:
    """trait_type-phenocode-pheno_sex[-coding][-modifier], spaces and '/' made '_'.

    Empty strings mean absent, so the optional parts are added only when
    their length is positive.
    """
    def opt(c):
        c = _c(c)
        return F.when(F.length(c) > 0, F.concat(F.lit("-"), c)).otherwise(F.lit(""))

    raw = F.concat(_c(trait_type), F.lit("-"), _c(phenocode), F.lit("-"), _c(pheno_sex), opt(coding), opt(modifier))
    return F.translate(raw, " /", "__")


def variant_id(chrom="chrom", pos="pos", ref="ref", alt="alt") -> Column:
    """contig:pos:ref:alt."""
    return F.concat_ws(":", _c(chrom), _c(pos).cast("string"), _c(ref), _c(alt))


def split_variant_id(varid="varid") -> list[Column]:
    """chrom, pos (int), ref, alt from contig:pos:ref:alt."""
    parts = F.split(_c(varid), ":")
    return [F.get(parts, 0).alias("chrom"), F.get(parts, 1).try_cast("int").alias("pos"),
            F.get(parts, 2).alias("ref"), F.get(parts, 3).alias("alt")]


def alleles_of(varid="varid") -> Column:
    """The two alleles of a variant id (elements 3 and 4 of the split)."""
    return F.slice(F.split(_c(varid), ":"), 3, 2)


def with_chr_prefix(chrom="chrom") -> Column:
    c = _c(chrom)
    return F.when(c.startswith("chr"), c).otherwise(F.concat(F.lit("chr"), c))


def strip_chr_prefix(chrom="chrom") -> Column:
    return F.regexp_replace(_c(chrom), "^chr", "")


def trait_category(trait_type="trait_type") -> Column:
    """quant for continuous/biomarkers, binary for the other known types, null otherwise."""
    from polyscore.constants import BINARY_TRAIT_TYPES, QUANT_TRAIT_TYPES
    t = _c(trait_type)
    return (F.when(t.isin(*QUANT_TRAIT_TYPES), F.lit("quant"))
            .when(t.isin(*BINARY_TRAIT_TYPES), F.lit("binary")))


def normalize_modifier(trait_type="trait_type", modifier="modifier") -> Column:
    """Biomarker phenotypes are keyed with modifier 'irnt'."""
    return F.when(_c(trait_type) == "biomarkers", F.lit("irnt")).otherwise(_c(modifier))


def short_description(text="description", n_words: int = 4) -> Column:
    """First n words, with '...' appended when the text had more."""
    words = F.split(F.trim(_c(text)), r"\s+")
    return F.when(F.size(words) > n_words,
                  F.concat(F.array_join(F.slice(words, 1, n_words), " "), F.lit("..."))).otherwise(F.trim(_c(text)))
