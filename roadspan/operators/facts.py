"""Fact builders: vehicle days and alerts."""

from __future__ import annotations

from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadspan.functions.scalars import WAREHOUSE_RADIUS_KM, haversine_km, seconds_between
from roadspan.operators.scaling import broadcast_if_small
from roadspan.operators.timeline import Timeline, hot_cuts

# Order of equal times: by every other column, so the previous row is well defined.
TRACE_ORDER = ["trace_date", "engine_status", "latitude", "longitude", "speed", "date_id"]
TRACE_COLUMNS = ["thing_id", *TRACE_ORDER]
PREVIOUS = {
    "prev_latitude": "latitude",
    "prev_longitude": "longitude",
    "prev_trace_date": "trace_date",
}


def with_date_id(trace: DataFrame, date_dim: DataFrame, day: str = "trace_date_day") -> DataFrame:
    """Attach the date key; the calendar is checked for size and broadcast."""
    calendar = date_dim.select("date_id", F.col("full_date").alias(day))
    return trace.join(broadcast_if_small(calendar), day)


def trace_with_prev(
    trace: DataFrame,
    date_dim: DataFrame,
    max_thing_id: int | None = None,
    max_speed: float | None = None,
    after_day: Any = None,
    before_day: Any = None,
) -> DataFrame:
    """Distinct trace rows with the vehicle's previous position and time.

    The filters apply before the previous row is looked up. Copies of a row see
    each other: the first copy has the row before it, all further copies are one
    row that has itself as previous.

    With no large vehicle the window and the DISTINCT share one shuffle by vehicle.
    With one, copies are counted away first and the vehicle's time axis is sliced.
    """
    if max_thing_id is not None:
        trace = trace.filter(F.col("thing_id") <= max_thing_id)
    if max_speed is not None:
        trace = trace.filter(F.col("speed") <= max_speed)
    if after_day is not None:
        trace = trace.filter(F.col("trace_date_day") > F.lit(after_day))
    if before_day is not None:
        trace = trace.filter(F.col("trace_date_day") < F.lit(before_day))
    rows = with_date_id(trace, date_dim).select(*TRACE_COLUMNS)

    def previous(w):
        return {name: F.lag(source).over(w) for name, source in PREVIOUS.items()}

    cuts = hot_cuts(trace, ["thing_id"], "trace_date")
    if cuts is None:
        return Timeline(rows, ["thing_id"], TRACE_ORDER).frame(1, 0, previous).df.distinct()

    counted = rows.groupBy(*TRACE_COLUMNS).agg(F.count("*").alias("_copies"))
    timeline = Timeline(counted, ["thing_id"], TRACE_ORDER, cuts).frame(1, 0, previous)
    # A first copy that already has its own time and position as previous (another row
    # of that second and place is before it) is equal to the further copies.
    apart = ~reduce(
        and_, [F.col(name).eqNullSafe(F.col(source)) for name, source in PREVIOUS.items()]
    )
    both = F.when((F.col("_copies") > 1) & apart, F.array(F.lit(False), F.lit(True))).otherwise(
        F.array(F.lit(False))
    )
    return (
        timeline.df.withColumn("_copy", F.explode(both))
        .withColumns(
            {
                name: F.when(F.col("_copy"), F.col(source)).otherwise(F.col(name))
                for name, source in PREVIOUS.items()
            }
        )
        .drop("_copies", "_copy")
    )


def _hours_with_status(status: int) -> Column:
    gap = seconds_between(F.col("prev_trace_date"), F.col("trace_date"))
    return F.sum(F.when(F.col("engine_status") == status, gap).otherwise(F.lit(0))) / 3600.0


def vehicle_daily_performance(
    trace: DataFrame,
    date_dim: DataFrame,
    max_thing_id: int | None = None,
    max_speed: float | None = None,
    after_day: Any = None,
    before_day: Any = None,
) -> DataFrame:
    """Idle and active hours, kilometres, mean and top speed per vehicle and day.

    A gap counts for the day and engine status of its later row; rows without a
    previous position count for nothing. ``max_speed`` gives the cleaned form and
    ``after_day`` the incremental one.
    """
    steps = trace_with_prev(trace, date_dim, max_thing_id, max_speed, after_day, before_day)
    return (
        steps.filter(F.col("prev_latitude").isNotNull() & F.col("prev_longitude").isNotNull())
        .groupBy("thing_id", "date_id")
        .agg(
            _hours_with_status(0).alias("idle_time"),
            _hours_with_status(1).alias("active_time"),
            F.sum(
                haversine_km(
                    F.col("prev_latitude"),
                    F.col("prev_longitude"),
                    F.col("latitude"),
                    F.col("longitude"),
                    WAREHOUSE_RADIUS_KM,
                )
            ).alias("traveled_distance"),
            F.avg("speed").alias("avg_speed"),
            F.max("speed").cast("double").alias("max_speed"),
        )
    )


def alert_fact(
    alert: DataFrame,
    alert_thing: DataFrame,
    alert_event: DataFrame,
    alert_point: DataFrame,
    point: DataFrame,
    alert_degre: DataFrame,
) -> DataFrame:
    """Alert counts per vehicle, degree, event and point; alerts of unknown degree are left out.

    All bridge joins are on the alert key, so each input is shuffled once; the
    point and degree joins come after the count, which keeps their input small.
    """
    counted = (
        alert.join(alert_thing, "alert_id")
        .join(alert_event, "alert_id")
        .join(alert_point, "alert_id")
        .groupBy("thing_id", "alert_degre_id", "event_id", "point_id")
        .agg(F.count("*").alias("alert_count"))
    )
    known = counted.join(point.select("point_id"), "point_id")
    return known.join(alert_degre.select("alert_degre_id").distinct(), "alert_degre_id", "left_semi").select(
        F.col("point_id").alias("location_id"),
        F.col("alert_degre_id").alias("type_id"),
        F.col("thing_id").alias("user_id"),
        "event_id",
        "alert_count",
        "thing_id",
    )


def alert_fact_dated(
    alert: DataFrame,
    alert_thing: DataFrame,
    alert_event: DataFrame,
    alert_point: DataFrame,
    point: DataFrame,
    alert_degre: DataFrame,
    date_dim: DataFrame,
) -> DataFrame:
    """The alert fact with the alert's own day as a further key."""
    calendar = date_dim.select("date_id", F.col("full_date").alias("alert_day"))
    counted = (
        alert.join(alert_thing, "alert_id")
        .join(alert_event, "alert_id")
        .join(alert_point, "alert_id")
        .groupBy("thing_id", "alert_degre_id", "event_id", "point_id", "alert_day")
        .agg(F.count("*").alias("alert_count"))
    )
    return (
        counted.join(point.select("point_id"), "point_id")
        .join(alert_degre.select("alert_degre_id").distinct(), "alert_degre_id", "left_semi")
        .join(broadcast_if_small(calendar), "alert_day")
        .select(
            F.col("point_id").alias("location_id"),
            "date_id",
            F.col("alert_degre_id").alias("type_id"),
            F.col("thing_id").alias("user_id"),
            "event_id",
            "alert_count",
            "thing_id",
        )
    )


def alert_fact_by_degree(
    alert: DataFrame, alert_thing: DataFrame, alert_degre: DataFrame
) -> DataFrame:
    """Alert counts per vehicle and degree; degrees absent from the code table drop out."""
    counted = (
        alert.join(alert_thing, "alert_id")
        .groupBy("thing_id", "alert_degre_id")
        .agg(F.count("*").alias("alert_count"))
    )
    return counted.join(alert_degre.select("alert_degre_id"), "alert_degre_id").select(
        "thing_id", "alert_degre_id", "alert_count"
    )


def fuel_backfill(vehicle_day: DataFrame) -> DataFrame:
    """Litres per vehicle day: 9 to 12 above 100 km, else 3 to 7, drawn from the keys."""
    draw = F.pmod(F.col("thing_id") * 31 + F.col("date_id") * 17, F.lit(1000)) / F.lit(1000.0)
    return vehicle_day.withColumn(
        "fuel",
        F.when(F.col("traveled_distance") > 100, F.lit(9.0) + draw * 3.0).otherwise(
            F.lit(3.0) + draw * 4.0
        ),
    )


def speed_cap_repair(vehicle_day: DataFrame) -> DataFrame:
    """Replace impossible speeds of a vehicle day."""
    return vehicle_day.withColumns(
        {
            "max_speed": F.when(F.col("max_speed") > 200, F.lit(120.0)).otherwise(F.col("max_speed")),
            "avg_speed": F.when(F.col("avg_speed") > 200, F.lit(80.0)).otherwise(F.col("avg_speed")),
        }
    )
