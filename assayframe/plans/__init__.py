"""One query per operator on the given tables."""

from assayframe.plans import (  # noqa: F401  each module registers its queries
    feature_queries,
    model_queries,
    similarity_queries,
    split_queries,
    table_queries,
)
from assayframe.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
