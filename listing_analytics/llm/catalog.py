"""All queries of the subpackage."""

from listing_analytics.llm import (  # noqa: F401
    exact_dedup, fill_in_middle, inverted_multi_index, license_rules, line_dedup, packing, quality_qda, sentence_pieces, sharding,
    simhash_bk, spotsigs, turn_repair, url_equivalence)
from listing_analytics.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
