"""Registered queries over the driver tables (see ``registry``)."""

from tabrix.plans import (clean_queries, drift_queries, feature_queries,  # noqa: F401
                          model_queries, quality_queries, split_eval_queries)
from tabrix.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["QUERIES", "ORACLE_SQL"]
