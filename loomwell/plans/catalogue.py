"""Importing this module registers every query."""

from loomwell.plans import (  # noqa: F401
    aggregate_queries,
    io_queries,
    job_queries,
    join_queries,
    projection_queries,
    reshape_queries,
    scalar_queries,
    sql_queries,
    streaming_queries,
    udf_queries,
    version_queries,
    window_queries,
)
from loomwell.plans.registry import REGISTRY

__all__ = ["REGISTRY"]
