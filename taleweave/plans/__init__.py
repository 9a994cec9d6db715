"""Runnable queries over the driver's tables."""

from taleweave.plans import corpus_queries, experiment_queries, record_queries  # noqa: F401
from taleweave.plans.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
