"""All named queries of the library."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from roadspan.plans import (  # noqa: F401
    feature_queries,
    journey_queries,
    kpi_queries,
    live_queries,
    registry,
    stream_queries,
    warehouse,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(registry.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(registry.ORACLES)
