"""Queries over sources, incremental loads, dimensions and facts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadspan import schemas
from roadspan.operators import dims, facts, loading
from roadspan.plans.fixtures import AS_OF, Inputs
from roadspan.plans.oracle import AS_OF_SQL, date_attributes, r6
from roadspan.plans.registry import query, rounded

DAY_MEASURES = ["idle_time", "active_time", "traveled_distance", "avg_speed", "max_speed"]
DAY_MEASURES_SQL = ", ".join(r6(c, c) for c in DAY_MEASURES)


def thing_dim(i: Inputs) -> DataFrame:
    return dims.thing_dim(i.thing, i.thing_type, i.thing_group)


def date_dim(i: Inputs) -> DataFrame:
    """The calendar, stored once for all uses within one query."""
    return i.stored("date_dim", lambda: dims.date_dim(i.trace_week, "date_insertion_day"))


def vehicle_daily(i: Inputs, **options) -> DataFrame:
    return facts.vehicle_daily_performance(i.trace_week, date_dim(i), **options)


def alert_fact_dated(i: Inputs) -> DataFrame:
    return facts.alert_fact_dated(
        i.alert, i.alert_thing, i.alert_event, i.alert_point, i.point, i.alert_degre, date_dim(i)
    )


# --- sinks and conformance -------------------------------------------------------------


@query(
    "conform_to_schema",
    """SELECT trace_id, CAST(thing_id AS VARCHAR) AS thing_id, trace_date,
    CAST(engine_status AS VARCHAR) AS engine_status, longitude AS long, latitude AS lat,
    oil_value, fuel_liters, fuel_percent, CAST(NULL AS DOUBLE) AS km_after_last_maintance,
    battery, speed FROM trace_src""",
)
def _conform(i: Inputs) -> DataFrame:
    return loading.conform_to_schema(
        i.trace_src, schemas.live_schema("trace"), {"longitude": "long", "latitude": "lat"}
    )


@query(
    "keyed_upsert_sink",
    """SELECT thing_id, trace_date, speed, latitude, longitude, trace_id FROM (
    SELECT *, row_number() OVER (PARTITION BY thing_id ORDER BY trace_date DESC, trace_id DESC) AS rn
    FROM trace_src) WHERE rn = 1""",
)
def _upsert(i: Inputs) -> DataFrame:
    columns = ["thing_id", "trace_date", "speed", "latitude", "longitude", "trace_id"]
    older = i.trace_src.filter(F.col("trace_date_day") < F.lit(AS_OF)).select(*columns)
    newer = i.trace_src.filter(F.col("trace_date_day") >= F.lit(AS_OF))
    return loading.upsert(
        older, newer.select(*columns), ["thing_id"], ["trace_date", "trace_id"]
    )


# --- incremental loading -----------------------------------------------------------------


@query(
    "high_watermark",
    "SELECT coalesce(MAX(date_insertion_day), DATE '2020-01-01') AS watermark FROM trace_week",
)
def _watermark(i: Inputs) -> DataFrame:
    return loading.high_watermark(i.trace_week, "date_insertion_day", dt.date(2020, 1, 1))


@query(
    "incremental_filter",
    f"""SELECT thing_id, trace_date, speed, latitude, longitude FROM trace_week
    WHERE date_insertion_day > (SELECT MAX(date_insertion_day) FROM trace_week
                                WHERE date_insertion_day < {AS_OF_SQL})""",
)
def _incremental(i: Inputs) -> DataFrame:
    loaded = loading.read_watermark(i.history, "date_insertion_day", dt.date(2020, 1, 1))
    return loading.incremental_filter(i.trace_week, "date_insertion_day", loaded).select(
        "thing_id", "trace_date", "speed", "latitude", "longitude"
    )


@query("load_if_empty", "SELECT alert_degre_id AS alert_degree_id, alert_degre_name AS alert_degree FROM alert_degre")
def _load_if_empty(i: Inputs) -> DataFrame:
    dim = dims.alert_degree_dim(i.alert_degre)
    return loading.load_if_empty(dim, dim.filter("alert_degree_id IS NULL"))


@query(
    "surrogate_key",
    """SELECT CAST(row_number() OVER (ORDER BY thing_serial_number) + (SELECT MAX(date_id)
    FROM date_dim) AS BIGINT) AS id, thing_serial_number, thing_designation FROM thing""",
)
def _surrogate(i: Inputs) -> DataFrame:
    loaded = loading.read_watermark(date_dim(i), "date_id", 0)
    return loading.surrogate_key(
        i.thing.select("thing_serial_number", "thing_designation"),
        "id",
        ["thing_serial_number"],
        loaded,
    ).select("id", "thing_serial_number", "thing_designation")


# --- dimensions -----------------------------------------------------------------------------


@query("thing_dim", "SELECT * FROM thing_dim")
def _thing_dim(i: Inputs) -> DataFrame:
    return thing_dim(i)


@query("date_dim", "SELECT * FROM date_dim")
def _date_dim(i: Inputs) -> DataFrame:
    return date_dim(i)


@query(
    "date_attributes",
    f"SELECT trace_id, {date_attributes('trace_date_day', False)} FROM trace_src",
)
def _date_attributes(i: Inputs) -> DataFrame:
    from roadspan.functions.scalars import with_date_attributes

    rows = i.trace_src.select("trace_id", "trace_date_day")
    return with_date_attributes(rows, F.col("trace_date_day"), quarter_as_text=False).drop(
        "trace_date_day"
    )


@query("alert_degree_dim", "SELECT alert_degre_id AS alert_degree_id, alert_degre_name AS alert_degree FROM alert_degre")
def _alert_degree_dim(i: Inputs) -> DataFrame:
    return dims.alert_degree_dim(i.alert_degre)


@query("event_dim", "SELECT event_id, event_designation FROM event")
def _event_dim(i: Inputs) -> DataFrame:
    return dims.event_dim(i.event)


@query(
    "user_dim",
    """SELECT id AS user_id, name AS user_name, CAST(NULL AS BIGINT) AS company_id,
    CAST(NULL AS VARCHAR) AS company_name FROM users""",
)
def _user_dim(i: Inputs) -> DataFrame:
    return dims.user_dim(i.users)


@query(
    "location_dim",
    """SELECT DISTINCT a.point_id AS location_id, wilaya_designation AS province,
    commune_designation AS municipality FROM alert_point a JOIN point p ON a.point_id = p.point_id
    JOIN wilaya w ON p.wilaya_id = w.wilaya_id JOIN commune c ON p.commune_id = c.commune_id""",
)
def _location_dim(i: Inputs) -> DataFrame:
    return dims.location_dim(i.alert_point, i.point, i.wilaya, i.commune)


# --- facts -----------------------------------------------------------------------------------


@query(
    "trace_with_prev",
    """SELECT thing_id, date_id, trace_date, engine_status, latitude, longitude, speed,
    prev_latitude, prev_longitude, prev_trace_date FROM steps""",
)
def _trace_with_prev(i: Inputs) -> DataFrame:
    return facts.trace_with_prev(i.trace_week, date_dim(i)).select(
        "thing_id", "date_id", "trace_date", "engine_status", "latitude", "longitude", "speed",
        "prev_latitude", "prev_longitude", "prev_trace_date",
    )


@query(
    "vehicle_daily_performance",
    f"SELECT thing_id, date_id, {DAY_MEASURES_SQL} FROM vehicle_daily",
)
def _vehicle_daily(i: Inputs) -> DataFrame:
    return rounded(vehicle_daily(i), *DAY_MEASURES)


@query(
    "vehicle_daily_performance_clean",
    f"SELECT thing_id, date_id, {DAY_MEASURES_SQL} FROM vehicle_daily_clean",
)
def _vehicle_daily_clean(i: Inputs) -> DataFrame:
    return rounded(vehicle_daily(i, max_speed=300), *DAY_MEASURES)


@query(
    "vehicle_daily_performance_incremental",
    f"SELECT thing_id, date_id, {DAY_MEASURES_SQL} FROM vehicle_daily_after",
)
def _vehicle_daily_incremental(i: Inputs) -> DataFrame:
    return rounded(vehicle_daily(i, after_day=dt.date(2024, 1, 15)), *DAY_MEASURES)


@query(
    "alert_fact",
    """SELECT point_id AS location_id, alert_degre_id AS type_id, thing_id AS user_id, event_id,
    COUNT(*) AS alert_count, thing_id FROM alert_counted GROUP BY thing_id, alert_degre_id, event_id,
    point_id""",
)
def _alert_fact(i: Inputs) -> DataFrame:
    return facts.alert_fact(i.alert, i.alert_thing, i.alert_event, i.alert_point, i.point, i.alert_degre)


@query(
    "alert_fact_by_degree",
    """SELECT t.thing_id, a.alert_degre_id, COUNT(*) AS alert_count FROM alert a
    JOIN alert_thing t ON a.alert_id = t.alert_id
    JOIN alert_degre g ON a.alert_degre_id = g.alert_degre_id GROUP BY t.thing_id, a.alert_degre_id""",
)
def _alert_fact_by_degree(i: Inputs) -> DataFrame:
    return facts.alert_fact_by_degree(i.alert, i.alert_thing, i.alert_degre)


@query("fuel_backfill", f"SELECT thing_id, date_id, {r6('fuel', 'fuel')} FROM vehicle_fuel")
def _fuel_backfill(i: Inputs) -> DataFrame:
    filled = facts.fuel_backfill(vehicle_daily(i))
    return rounded(filled, "fuel").select("thing_id", "date_id", "fuel")


@query(
    "speed_cap_repair",
    f"""SELECT thing_id, date_id,
    {r6('CASE WHEN max_speed > 200 THEN 120 ELSE max_speed END', 'max_speed')},
    {r6('CASE WHEN avg_speed > 200 THEN 80 ELSE avg_speed END', 'avg_speed')} FROM vehicle_daily""",
)
def _speed_cap(i: Inputs) -> DataFrame:
    repaired = facts.speed_cap_repair(vehicle_daily(i))
    return rounded(repaired, "max_speed", "avg_speed").select(
        "thing_id", "date_id", "max_speed", "avg_speed"
    )


@query("alert_date_backfill", "SELECT * FROM alert_fact_dated")
def _alert_dated(i: Inputs) -> DataFrame:
    return alert_fact_dated(i)
