"""All registered queries."""

from listing_analytics.plans import (
    clean_queries, link_queries, mart_queries, model_queries, page_queries, serve_queries, source_queries)  # noqa: F401
from listing_analytics.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
