"""Imports every query module, which registers its queries."""

from . import (  # noqa: F401
    queries_cleaning,
    queries_demand,
    queries_drift,
    queries_features,
    queries_models,
    queries_profile,
    queries_split,
    queries_stream,
    queries_training,
)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
