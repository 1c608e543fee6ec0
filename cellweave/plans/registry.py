"""All queries: importing the query modules registers them."""

from cellweave.plans import count_queries, model_queries, norm_queries, read_queries  # noqa: F401
from cellweave.plans.catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
