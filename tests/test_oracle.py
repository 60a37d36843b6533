"""Every named query with checking SQL, on the smallest data set."""

import pytest
from compare import difference
from conftest import SMALL

from roadspan.plans import catalog

ORACLES = catalog.oracle_sql()
QUERIES = catalog.queries()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_checking_sql(name, spark, duck):
    assert difference(QUERIES[name](spark, SMALL), duck, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(name, spark):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_comparison_notices_differences(spark, duck):
    frame = spark.sql("SELECT 1 AS a, 2.5D AS b")
    assert difference(frame, duck, "SELECT 1 AS a, CAST(2.5 AS DOUBLE) AS b") is None
    assert difference(frame, duck, "SELECT 1 AS a, CAST(2.6 AS DOUBLE) AS b")
    assert difference(frame, duck, "SELECT 1 AS a, CAST(2.5 AS DOUBLE) AS c")
    assert difference(frame, duck, "SELECT 1 AS a, 2.5 AS b")
    assert difference(frame, duck, "SELECT 1 AS a, CAST(2.5 AS DOUBLE) AS b UNION ALL SELECT 1, 1")


SLICED = [
    "trace_with_prev", "vehicle_daily_performance", "state_avg_speed", "state_traveled_distance",
    "rolling_sensor_stats", "alert_counter_stream", "journey_source", "journey", "journey_dim",
    "sliding_sequences", "next_value_pairs", "lag_difference", "banded_impute", "row_progress",
    "filter_dense_clusters", "distance_by_day_live",
]


@pytest.mark.parametrize("name", SLICED)
def test_matches_checking_sql_when_every_vehicle_is_sliced(name, spark, duck):
    spark.conf.set("spark.roadspan.rowsPerSlice", "5")
    try:
        assert difference(QUERIES[name](spark, SMALL), duck, ORACLES[name]) is None
    finally:
        spark.conf.unset("spark.roadspan.rowsPerSlice")


