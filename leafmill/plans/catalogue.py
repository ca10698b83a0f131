"""All queries of the core; importing the modules registers them."""

from leafmill.plans import aggregate_queries, document_queries, join_queries, name_queries, report_queries, sequence_queries, text_queries  # noqa: F401
from leafmill.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
