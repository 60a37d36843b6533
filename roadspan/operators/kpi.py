"""The KPI reports: one operator for every metric, grain and filter."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadspan.functions.scalars import day_label
from roadspan.operators.scaling import broadcast_if_small

VEHICLE_METRICS: dict[str, dict[str, str]] = {
    "distance": {"traveled_distance": "sum"},
    "time": {"idle_time": "sum", "active_time": "sum"},
    "speed": {"avg_speed": "avg", "max_speed": "max"},
    "fuel": {"fuel": "sum"},
}
GRAIN_COLUMNS = {"year": ["year"], "month": ["month", "month_name"], "day": ["full_date"]}


def _vehicle_condition(
    thing_id: int | None, group_id: int | None, type_id: int | None
) -> tuple[str, int] | None:
    """One filter applies: the vehicle, else its group, else its type."""
    if thing_id is not None:
        return "thing_id", thing_id
    if group_id is not None:
        return "group_id", group_id
    if type_id is not None:
        return "type_id", type_id
    return None


def of_vehicles(
    rows: DataFrame,
    thing_dim: DataFrame,
    thing_id: int | None = None,
    group_id: int | None = None,
    type_id: int | None = None,
) -> DataFrame:
    """Rows of known vehicles, restricted by vehicle, else group, else type."""
    things = thing_dim.select("thing_id", "group_id", "type_id")
    condition = _vehicle_condition(thing_id, group_id, type_id)
    if condition is not None:
        things = things.filter(F.col(condition[0]) == condition[1])
    return rows.join(things.select("thing_id"), "thing_id", "left_semi")


def _period(grain: str, year: int | None, month: int | None) -> Column | None:
    if grain == "year":
        return None
    if year is None or (grain == "day" and month is None):
        raise ValueError(f"grain {grain!r} needs a year" + (" and a month" if grain == "day" else ""))
    wanted = F.col("year") == year
    return wanted & (F.col("month") == month) if grain == "day" else wanted


def _dated(fact: DataFrame, date_dim: DataFrame, period: Column | None) -> DataFrame:
    calendar = date_dim if period is None else date_dim.filter(period)
    return fact.join(
        broadcast_if_small(calendar.select("date_id", "full_date", "year", "month", "month_name")),
        "date_id",
    )


def _labelled(report: DataFrame, grain: str) -> DataFrame:
    if grain == "day":
        return report.withColumn("day_label", day_label(F.col("full_date")))
    return report


def _includes_today(grain: str, year: int | None, month: int | None, as_of: dt.date | None) -> bool:
    return grain == "day" and as_of is not None and (year, month) == (as_of.year, as_of.month)


def kpi(
    metric: str,
    grain: str,
    fact: DataFrame,
    date_dim: DataFrame,
    thing_dim: DataFrame,
    thing_id: int | None = None,
    group_id: int | None = None,
    type_id: int | None = None,
    year: int | None = None,
    month: int | None = None,
    live: DataFrame | None = None,
    as_of: dt.date | None = None,
) -> DataFrame:
    """A vehicle metric per year, per month of a year, or per day of a month.

    ``live`` holds vehicle-day state (times in seconds); its rows join a day report
    of the month of ``as_of``, under the same vehicle filter. History and live rows
    are vehicle days of one shape, so a day present in both is aggregated once.
    """
    measures = VEHICLE_METRICS[metric]
    period = _period(grain, year, month)
    rows = _dated(
        of_vehicles(fact, thing_dim, thing_id, group_id, type_id), date_dim, period
    ).select(*GRAIN_COLUMNS[grain], *measures)
    if live is not None and _includes_today(grain, year, month, as_of):
        hours = {c: F.col(c) / 3600.0 for c in ("idle_time", "active_time")}
        today = live.filter(
            (F.year("full_date") == year) & (F.month("full_date") == month)
        ).withColumns(hours)
        today = of_vehicles(today, thing_dim, thing_id, group_id, type_id)
        rows = rows.unionByName(today.select("full_date", *measures))
    aggregates = {"sum": F.sum, "avg": F.avg, "max": F.max}
    report = rows.groupBy(*GRAIN_COLUMNS[grain]).agg(
        *[aggregates[how](name).alias(name) for name, how in measures.items()]
    )
    return _labelled(report, grain)


def alert_kpi(
    alert_type: int,
    grain: str,
    fact: DataFrame,
    date_dim: DataFrame,
    year: int | None = None,
    month: int | None = None,
    live: DataFrame | None = None,
    as_of: dt.date | None = None,
) -> DataFrame:
    """Number of alert fact rows of one type; live alerts add their counters."""
    period = _period(grain, year, month)
    of_type = fact.filter(F.col("type_id") == alert_type)
    rows = _dated(of_type, date_dim, period).select(
        *GRAIN_COLUMNS[grain], F.lit(1).cast("long").alias("alert_count")
    )
    if live is not None and _includes_today(grain, year, month, as_of):
        today = live.filter(
            (F.col("type_id") == alert_type)
            & (F.year("full_date") == year)
            & (F.month("full_date") == month)
        )
        rows = rows.unionByName(
            today.select("full_date", F.col("alert_number").cast("long").alias("alert_count"))
        )
    report = rows.groupBy(*GRAIN_COLUMNS[grain]).agg(F.sum("alert_count").alias("alert_count"))
    return _labelled(report, grain)


def distance_by_year_plus_live_total(
    fact: DataFrame, date_dim: DataFrame, thing_dim: DataFrame, live: DataFrame, as_of: dt.date
) -> DataFrame:
    """Kilometres per year, with the live kilometres added to the year of ``as_of``."""
    history = kpi("distance", "year", fact, date_dim, thing_dim)
    today = of_vehicles(live, thing_dim).select(
        F.lit(as_of.year).alias("year"), "traveled_distance"
    )
    return (
        history.unionByName(today).groupBy("year").agg(F.sum("traveled_distance").alias("traveled_distance"))
    )
