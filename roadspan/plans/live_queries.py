"""Queries over the live operators and the place lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadspan.operators import live
from roadspan.operators.places import place_lookup
from roadspan.plans.fixtures import AS_OF, Inputs
from roadspan.plans.oracle import date_attributes, r6
from roadspan.plans.registry import query, register, rounded

STATS = [
    f"{sensor}_{suffix}"
    for sensor in ("oil", "fuel")
    for suffix in ("rolling_mean", "rolling_stddev", "cumsum", "min", "max")
]
STATS_SQL = ", ".join(r6(c, c) for c in STATS)


def stored(i: Inputs) -> DataFrame:
    return i.trace_src.filter(F.col("trace_date_day") < F.lit(AS_OF))


def alerts(i: Inputs) -> DataFrame:
    return i.alert_src.withColumns({"type_id": F.col("alert_degre_id"), "user_id": F.col("thing_id")})


def today_alerts(i: Inputs) -> DataFrame:
    return alerts(i).filter(F.col("alert_day") == F.lit(AS_OF))


def day_state(i: Inputs) -> DataFrame:
    """Live state of the as-of day, keyed by vehicle and day."""
    return live.vehicle_state(i.today, ["thing_id", "trace_date_day"])


@query(
    "trace_ingest",
    """SELECT trace_id, thing_id, trace_date, longitude AS long, latitude AS lat, speed,
    engine_status, oil_value, fuel_liters, ROUND(fuel_percent, 2) AS fuel_percent, battery
    FROM trace_src""",
)
def _trace_ingest(i: Inputs) -> DataFrame:
    return live.trace_ingest(i.trace_src).select(
        "trace_id", "thing_id", "trace_date", "long", "lat", "speed", "engine_status",
        "oil_value", "fuel_liters", "fuel_percent", "battery",
    )


@query("last_known_speed", "SELECT thing_id, speed AS last_speed FROM latest_speed")
def _last_known_speed(i: Inputs) -> DataFrame:
    return live.last_known_speed(i.trace_src)


@query(
    "speed_outlier_replace",
    """SELECT t.trace_id, t.thing_id, t.trace_date,
    CASE WHEN t.speed > 200 THEN s.speed ELSE t.speed END AS speed
    FROM trace_today t LEFT JOIN stored_speed s ON t.thing_id = s.thing_id""",
)
def _speed_outlier(i: Inputs) -> DataFrame:
    return live.speed_outlier_replace(i.today, stored(i)).select(
        "trace_id", "thing_id", "trace_date", "speed"
    )


STATE_QUERIES = {
    "state_avg_speed": ("avg_speed", True),
    "state_max_speed": ("max_speed", False),
    "state_idle_time": ("idle_time", False),
    "state_active_time": ("active_time", False),
    "state_fuel": ("fuel", True),
    "state_traveled_distance": ("traveled_distance", True),
    "state_km_since_maintenance": ("km_after_last_maintenance", True),
}


def _state_query(column: str, is_double: bool):
    def build(i: Inputs) -> DataFrame:
        states = live.vehicle_states(i.trace_src)
        states = rounded(states, column) if is_double else states
        return states.select("thing_id", "trace_id", column)

    source = "traveled_distance" if column == "km_after_last_maintenance" else column
    shown = r6(source, column) if is_double else column
    return build, f"SELECT thing_id, trace_id, {shown} FROM states"


for _name, (_column, _double) in STATE_QUERIES.items():
    register(_name, *_state_query(_column, _double))


@query("rolling_sensor_stats", f"SELECT thing_id, trace_date, trace_id, {STATS_SQL} FROM rolling_stats")
def _rolling(i: Inputs) -> DataFrame:
    return rounded(live.rolling_sensor_stats(i.trace_src), *STATS)


@query(
    "latest_row_per_vehicle",
    f"SELECT thing_id, trace_date, trace_id, {STATS_SQL} FROM latest_stats",
)
def _latest(i: Inputs) -> DataFrame:
    return rounded(live.latest_row_per_vehicle(live.rolling_sensor_stats(i.trace_src)), *STATS)


@query(
    "join_latest_features",
    f"""SELECT t.trace_id, t.thing_id, {STATS_SQL} FROM trace_today t
    LEFT JOIN stored_stats s ON t.thing_id = s.thing_id""",
)
def _join_latest(i: Inputs) -> DataFrame:
    incoming = i.today.select("trace_id", "thing_id")
    return rounded(live.join_latest_features(incoming, live.rolling_sensor_stats(stored(i))), *STATS)


@query(
    "constant_features",
    """SELECT trace_id, 1 AS last_oil_change, 1 AS car_age, CAST(0.020 AS DOUBLE) AS fuel_change,
    10 AS power_supply_voltage, 2 AS car_usage FROM trace_src""",
)
def _constants(i: Inputs) -> DataFrame:
    return live.constant_features(i.trace_src.select("trace_id"))


@query(
    "alert_counter_stream",
    "SELECT alert_id, type_id, event_id, user_id, alert_number FROM counted_alerts",
)
def _alert_counter(i: Inputs) -> DataFrame:
    return live.alert_counter(alerts(i)).select(
        "alert_id", "type_id", "event_id", "user_id", F.col("alert_number").cast("long")
    )


@query(
    "alert_enrich",
    f"""SELECT alert_number, event_id, type_id, user_id, town AS municipality, state AS province,
    {date_attributes("alert_day", False)} FROM counted_alerts""",
)
def _alert_enrich(i: Inputs) -> DataFrame:
    return live.alert_enrich(live.alert_counter(alerts(i)), i.gazetteer)


@query("place_lookup", "SELECT alert_id, town, state, country FROM placed_alerts")
def _place_lookup(i: Inputs) -> DataFrame:
    return place_lookup(i.alert_src, i.gazetteer).select("alert_id", "town", "state", "country")
