"""Named queries: each is a function of the inputs with its checking SQL beside it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadspan.plans.fixtures import Inputs
from roadspan.plans.oracle import with_ctes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, build: Callable[[Inputs], DataFrame], oracle: str | None = None) -> None:
    if name in QUERIES:
        raise ValueError(f"query {name} is registered twice")
    QUERIES[name] = lambda spark, sf_dir: build(Inputs(spark, sf_dir))
    if oracle is not None:
        ORACLES[name] = with_ctes(oracle)


def query(name: str, oracle: str | None = None):
    """Decorator form of :func:`register`."""

    def wrap(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
        register(name, build, oracle)
        return build

    return wrap


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Round doubles to six places for comparison across engines."""
    return df.withColumns({c: F.round(F.col(c).cast("double"), 6) for c in columns})
