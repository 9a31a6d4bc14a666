"""Importing this module registers every query."""

from inkprint.plans import corpus_queries, feature_queries, metric_queries, study_queries  # noqa: F401
from inkprint.plans.registry import ORACLES, QUERIES  # noqa: F401
