"""The KPI reports as named queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadspan.operators import facts, kpi
from roadspan.plans import stream_queries, warehouse
from roadspan.plans.fixtures import AS_OF, Inputs
from roadspan.plans.oracle import label, r6
from roadspan.plans.registry import register, rounded

YEAR, MONTH = AS_OF.year, AS_OF.month
FILTERS = {"thing": ("thing_id", 5), "group": ("group_id", 3), "type": ("type_id", 2)}


def vehicle_fact(i: Inputs) -> DataFrame:
    return facts.fuel_backfill(warehouse.vehicle_daily(i))


def vehicle_fact_history(i: Inputs) -> DataFrame:
    return facts.fuel_backfill(warehouse.vehicle_daily(i, before_day=AS_OF))


def live_rows(i: Inputs) -> DataFrame:
    return stream_queries.live_vehicle_days(i)


def alert_history(i: Inputs) -> DataFrame:
    before = i.alert.filter(F.col("alert_day") < F.lit(AS_OF))
    return facts.alert_fact_dated(
        before, i.alert_thing, i.alert_event, i.alert_point, i.point, i.alert_degre, warehouse.date_dim(i)
    )


def live_alerts(i: Inputs) -> DataFrame:
    return stream_queries.live_alert_days(i)


def _period(grain: str) -> dict[str, int]:
    return {"year": {}, "month": {"year": YEAR}, "day": {"year": YEAR, "month": MONTH}}[grain]


def _period_sql(grain: str) -> str:
    return {
        "year": "",
        "month": f" AND d.year = {YEAR}",
        "day": f" AND d.year = {YEAR} AND d.month = {MONTH}",
    }[grain]


GRAIN_SQL = {
    "year": "year",
    "month": "month, month_name",
    "day": f"full_date, {label('full_date')} AS day_label",
}
GROUP_SQL = {"year": "year", "month": "month, month_name", "day": "full_date"}


def _vehicle_oracle(metric: str, grain: str, with_live: bool, condition: str) -> str:
    measures = kpi.VEHICLE_METRICS[metric]
    fact = "vehicle_fuel_history" if with_live else "vehicle_fuel"
    names = ", ".join(measures)
    rows = f"""SELECT year, month, month_name, full_date, {names} FROM {fact} v
    JOIN date_dim d ON v.date_id = d.date_id JOIN thing_dim t ON v.thing_id = t.thing_id
    WHERE 1 = 1{_period_sql(grain)}{condition}"""
    if with_live:
        rows += f""" UNION ALL SELECT {YEAR}, {MONTH}, 'January', full_date, {names} FROM live_rows v
        JOIN thing_dim t ON v.thing_id = t.thing_id WHERE 1 = 1{condition}"""
    shown = ", ".join(r6(f"{how}({name})", name) for name, how in measures.items())
    return f"SELECT {GRAIN_SQL[grain]}, {shown} FROM ({rows}) GROUP BY {GROUP_SQL[grain]}"


def _add_vehicle(name: str, metric: str, grain: str, with_live: bool, only: str | None = None) -> None:
    chosen = {FILTERS[only][0]: FILTERS[only][1]} if only else {}

    def build(i: Inputs) -> DataFrame:
        extra = {"live": live_rows(i), "as_of": AS_OF} if with_live else {}
        report = kpi.kpi(
            metric,
            grain,
            vehicle_fact_history(i) if with_live else vehicle_fact(i),
            warehouse.date_dim(i),
            warehouse.thing_dim(i),
            **chosen,
            **_period(grain),
            **extra,
        )
        return rounded(report, *kpi.VEHICLE_METRICS[metric])

    condition = f" AND t.{FILTERS[only][0]} = {FILTERS[only][1]}" if only else ""
    register(name, build, _vehicle_oracle(metric, grain, with_live, condition))


def _alert_oracle(alert_type: int, grain: str, with_live: bool) -> str:
    before = f" AND full_date < DATE '{AS_OF}'" if with_live else ""
    rows = f"""SELECT year, month, month_name, full_date, 1 AS n FROM alert_fact_dated a
    JOIN date_dim d ON a.date_id = d.date_id WHERE type_id = {alert_type}{_period_sql(grain)}{before}"""
    if with_live:
        rows += f""" UNION ALL SELECT {YEAR}, {MONTH}, 'January', alert_day, alert_number
        FROM live_alerts l WHERE type_id = {alert_type}"""
    return f"""SELECT {GRAIN_SQL[grain]}, CAST(SUM(n) AS BIGINT) AS alert_count FROM ({rows})
    GROUP BY {GROUP_SQL[grain]}"""


def _add_alerts(name: str, alert_type: int, grain: str, with_live: bool) -> None:
    def build(i: Inputs) -> DataFrame:
        extra = {"live": live_alerts(i), "as_of": AS_OF} if with_live else {}
        fact = alert_history(i) if with_live else warehouse.alert_fact_dated(i)
        return kpi.alert_kpi(
            alert_type, grain, fact, warehouse.date_dim(i), **_period(grain), **extra
        )

    register(name, build, _alert_oracle(alert_type, grain, with_live))


for _metric in kpi.VEHICLE_METRICS:
    for _grain in ("year", "month", "day"):
        _add_vehicle(f"{_metric}_by_{_grain}", _metric, _grain, with_live=False)
    _add_vehicle(f"{_metric}_by_day_live", _metric, "day", with_live=True)
    for _only in FILTERS:
        _add_vehicle(f"{_metric}_by_month_for_{_only}", _metric, "month", False, _only)
        _add_vehicle(f"{_metric}_by_day_live_for_{_only}", _metric, "day", True, _only)

for _type in (1, 2, 3):
    for _grain in ("year", "month", "day"):
        _add_alerts(f"alerts_type{_type}_by_{_grain}", _type, _grain, with_live=False)
    _add_alerts(f"alerts_type{_type}_by_day_live", _type, "day", with_live=True)

_add_vehicle("distance_history_plus_live", "distance", "day", with_live=True)


def _year_plus_live(i: Inputs) -> DataFrame:
    report = kpi.distance_by_year_plus_live_total(
        vehicle_fact_history(i),
        warehouse.date_dim(i),
        warehouse.thing_dim(i),
        live_rows(i),
        dt.date(YEAR, MONTH, AS_OF.day),
    )
    return rounded(report, "traveled_distance")


register(
    "distance_by_year_plus_live_total",
    _year_plus_live,
    f"""SELECT year, {r6('SUM(traveled_distance)', 'traveled_distance')} FROM (
    SELECT d.year, traveled_distance FROM vehicle_fuel_history v
    JOIN date_dim d ON v.date_id = d.date_id JOIN thing_dim t ON v.thing_id = t.thing_id
    UNION ALL SELECT {YEAR}, traveled_distance FROM live_rows v
    JOIN thing_dim t ON v.thing_id = t.thing_id) GROUP BY year""",
)
