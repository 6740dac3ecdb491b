"""Fixed values that are part of the semantics of the domain."""

# --- fixed values (must equal the published study conventions) ---
# Populations, in alphabetic order; index i is "population i" everywhere.
POPS = ["AFR", "AMR", "CSA", "EAS", "EUR", "MID"]
# Chromosomes of the genotype data; clumping runs on 1-22 and X.
CHROMOSOMES = [str(c) for c in range(1, 23)] + ["X", "XY"]
CLUMP_CHROMOSOMES = [str(c) for c in range(1, 23)] + ["X"]
# P-value thresholds s1..s10 of the polygenic scores (strict P < t).
P_THRESHOLDS = [
    ("s1", 5e-8), ("s2", 1e-6), ("s3", 1e-4), ("s4", 1e-3), ("s5", 1e-2),
    ("s6", 0.05), ("s7", 0.1), ("s8", 0.2), ("s9", 0.5), ("s10", 1.0),
]
# Trait types and their category.
TRAIT_TYPES = ["continuous", "biomarkers", "categorical", "phecode", "icd10", "prescriptions"]
QUANT_TRAIT_TYPES = ["continuous", "biomarkers"]
BINARY_TRAIT_TYPES = ["categorical", "phecode", "icd10", "prescriptions"]
# Reference sample counts per population and the subset cap.
POP_SAMPLE_COUNTS = {"AFR": 6637, "AMR": 982, "CSA": 8876, "EAS": 2709, "EUR": 420542, "MID": 1599}
SUBSET_MAX_SAMPLES = 5000
# Minimum allele count of a variant in at least one population.
MIN_ALLELE_COUNT = 20
# Lambda-GC must lie strictly inside this interval.
LAMBDA_GC_BOUNDS = (0.5, 2.0)
# LD clumping parameters: index p-value, member p-value, r^2, window in bases.
CLUMP_P1 = 1.0
CLUMP_P2 = 1.0
CLUMP_R2 = 0.1
CLUMP_WINDOW_BP = 500_000
# Clump tally bins (PLINK .clumped columns): NSIG p > 0.05, S05 (0.01, 0.05],
# S01 (0.001, 0.01], S001 (0.0001, 0.001], S0001 p <= 0.0001.
CLUMP_TALLY_EDGES = [0.05, 0.01, 0.001, 0.0001]
# Coding excluded from the flat export.
EXCLUDED_CODING = "zekavat_20200409"
# Text columns of PLINK clump output, in file order.
CLUMP_TEXT_COLUMNS = ["contig", "F", "varid", "pos", "P", "TOTAL", "NSIG", "S05", "S01", "S001", "S0001", "SP2"]
# --- end of fixed values ---

PHENO_KEY = ["trait_type", "phenocode", "pheno_sex", "coding", "modifier"]
VARIANT_KEY = ["chrom", "pos", "ref", "alt"]
