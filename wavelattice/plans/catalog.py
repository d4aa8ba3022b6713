"""Importing this module registers all queries."""

from wavelattice.plans import metric_queries, model_queries, study_queries, wave_queries  # noqa: F401
from wavelattice.plans.registry import ORACLES, QUERIES  # noqa: F401
