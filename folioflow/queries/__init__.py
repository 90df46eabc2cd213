"""Queries on the benchmark tables, each with the SQL it must agree with."""

from folioflow.queries.registry import QUERIES, Query
from folioflow.queries import (  # noqa: F401
    built_datasets,
    dataset_layer,
    fixed_income,
    market,
    portfolio,
    reference_data,
    span_builds,
)

__all__ = ["QUERIES", "Query"]
