"""Importing this module registers every query of the subpackage."""

from eddyline.llm import decontaminate, language, near_dup, packing, pii, prefix_trie, quality, secrets, sharding, suffix_dedup, token_alignment, token_counts, url_filter  # noqa: F401
from eddyline.llm.registry import ORACLES, QUERIES  # noqa: F401
