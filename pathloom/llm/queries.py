"""All queries of the subpackage; importing an operator registers its query."""

from pathloom.llm import chat_format, decontaminate, hard_negatives, license_scan, near_dedup, packing, personal_data, pu_quality, quality_rules, substring_dedup, token_counts, tree_model, whitening  # noqa: F401
from pathloom.llm.base import ORACLES, QUERIES  # noqa: F401
