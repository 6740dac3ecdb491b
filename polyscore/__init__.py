"""polyscore: population-scale association results and polygenic scores on Spark.

Every matrix of the domain (variants x phenotypes, variants x samples,
samples x score columns) is kept as a long fact table keyed by its row and
column keys, so that each operator is a DataFrame plan that Catalyst can
prune, push down and re-plan at runtime.
"""

from polyscore.constants import POPS, P_THRESHOLDS, TRAIT_TYPES  # noqa: F401
from polyscore.session import get_session, scratch_dir  # noqa: F401
