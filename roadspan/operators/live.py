"""Batch forms of the live operators: per-vehicle state, rolling statistics, alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadspan.functions.scalars import haversine_km, seconds_between, with_date_attributes
from roadspan.operators.loading import latest_by_key
from roadspan.operators.places import place_lookup
from roadspan.operators.timeline import AUTO, Cuts, Timeline, cuts_for, hot_cuts

# Fixed values.
SPEED_LIMIT = 200
FUEL_PER_EVENT = 0.019
ROLLING_BEFORE = 30
CONSTANT_FEATURES = {
    "last_oil_change": 1,
    "car_age": 1,
    "fuel_change": 0.020,
    "power_supply_voltage": 10,
    "car_usage": 2,
}
ALERT_COLUMNS = [
    "alert_number", "day", "day_type", "event_id", "full_date", "month", "month_name",
    "month_year", "municipality", "province", "quarter", "season", "type_id", "user_id", "year",
]

EVENT_ORDER = ["trace_date", "trace_id"]

# Each step halves the weight of older readings: after 64 of them the weight is below
# the precision of a double, so this many readings give the value in full.
BLEND_READINGS = 64


def trace_ingest(events: DataFrame) -> DataFrame:
    """Positions as stored: short coordinate names, fuel percentage to two places."""
    return events.withColumnsRenamed({"latitude": "lat", "longitude": "long"}).withColumn(
        "fuel_percent", F.round("fuel_percent", 2)
    )


def last_known_speed(trace: DataFrame) -> DataFrame:
    """The newest stored speed of each vehicle."""
    newest = latest_by_key(trace.select("thing_id", "speed", *EVENT_ORDER), ["thing_id"], EVENT_ORDER)
    return newest.select("thing_id", F.col("speed").alias("last_speed"))


def speed_outlier_replace(
    events: DataFrame, stored: DataFrame, limit: float = SPEED_LIMIT
) -> DataFrame:
    """Impossible speeds become the vehicle's last stored speed, NULL if there is none."""
    return (
        events.join(last_known_speed(stored), "thing_id", "left")
        .withColumn(
            "speed", F.when(F.col("speed") > limit, F.col("last_speed")).otherwise(F.col("speed"))
        )
        .select(*events.columns)
    )


def _blend(readings: Column) -> Column:
    """Fold x1, (x1 + x2) / 2, … over an array."""
    return F.aggregate(
        F.slice(readings, 2, BLEND_READINGS), F.get(readings, 0), lambda old, x: (old + x) / 2.0
    )


def vehicle_states(events: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The state after every event, folded over each key in time order.

    avg_speed blends each reading half and half with the old value; max_speed is the
    running maximum; idle_time and active_time add the seconds since the previous
    event by engine status; fuel starts at the first level and grows by a fixed
    amount per event; distances add the step from the previous position (0 when a
    coordinate is missing).
    """
    keys = keys or ["thing_id"]

    def neighbours(w):
        return {
            "_prev_lat": F.lag("latitude").over(w),
            "_prev_lon": F.lag("longitude").over(w),
            "_prev_date": F.lag("trace_date").over(w),
        }

    def readings(w):
        last = F.collect_list(F.col("speed").cast("double")).over(w.rowsBetween(1 - BLEND_READINGS, 0))
        return {"_readings": last}

    def per_event(df: DataFrame) -> DataFrame:
        gap = seconds_between(F.col("_prev_date"), F.col("trace_date"))
        step = haversine_km(
            F.col("_prev_lat"), F.col("_prev_lon"), F.col("latitude"), F.col("longitude")
        )
        return df.withColumns(
            {
                "_blended": _blend(F.col("_readings")),
                "_idle": F.when(F.col("engine_status") == 0, gap),
                "_active": F.when(F.col("engine_status") == 1, gap),
                "_step": step,
            }
        ).drop("_prev_lat", "_prev_lon", "_prev_date", "_readings", "_has_speed")

    states = (
        Timeline(events, keys, EVENT_ORDER, hot_cuts(events, keys, "trace_date"))
        .frame(1, 0, neighbours)
        .map(lambda df: df.withColumn("_has_speed", F.col("speed").isNotNull()))
        .frame(BLEND_READINGS - 1, 0, readings, within="_has_speed")
        .map(per_event)
        .running(
            {
                "avg_speed": ("last", F.col("_blended")),
                "max_speed": ("max", F.col("speed")),
                "_idle_sum": ("sum", F.col("_idle")),
                "_active_sum": ("sum", F.col("_active")),
                "_distance": ("sum", F.col("_step")),
                "_events": ("count", F.lit(1)),
                "_first_fuel": ("first", F.col("fuel_liters")),
            }
        )
        .map(
            lambda df: df.withColumn(
                "_fuel_at", F.when(F.col("fuel_liters").isNotNull(), F.col("_events"))
            )
        )
        .running({"_fuel_from": ("first", F.col("_fuel_at"))})
        .df
    )
    distance = F.coalesce(F.col("_distance"), F.lit(0.0))
    return states.withColumns(
        {
            "idle_time": F.coalesce(F.col("_idle_sum"), F.lit(0)),
            "active_time": F.coalesce(F.col("_active_sum"), F.lit(0)),
            "fuel": F.col("_first_fuel")
            + F.lit(FUEL_PER_EVENT) * (F.col("_events") - F.col("_fuel_from")),
            "traveled_distance": distance,
            "km_after_last_maintenance": distance,
        }
    ).drop(
        "_blended", "_idle", "_active", "_step", "_idle_sum", "_active_sum", "_distance",
        "_events", "_first_fuel", "_fuel_at", "_fuel_from",
    )


STATE_COLUMNS = [
    "avg_speed", "max_speed", "idle_time", "active_time", "fuel",
    "traveled_distance", "km_after_last_maintenance",
]


def vehicle_state(
    events: DataFrame, keys: list[str] | None = None, also: tuple[str, ...] = ()
) -> DataFrame:
    """The newest state of each key, with position, status and date attributes.

    ``also`` names further event columns to carry from the newest event.
    """
    keys = keys or ["thing_id"]
    states = vehicle_states(events, keys).select(
        *keys,
        *EVENT_ORDER,
        *STATE_COLUMNS,
        "latitude",
        "longitude",
        "engine_status",
        *also,
    )
    newest = latest_by_key(states, keys, EVENT_ORDER)
    return with_date_attributes(newest, F.to_date("trace_date"), quarter_as_text=False)


def rolling_sensor_stats(
    trace: DataFrame,
    before: int = ROLLING_BEFORE,
    keep: tuple[str, ...] = (),
    cuts: Cuts = AUTO,
) -> DataFrame:
    """Mean, sample deviation, sum, minimum and maximum of the sensors over the
    current reading and ``before`` earlier ones of the vehicle. ``keep`` names the
    sensors to show themselves as well."""

    def stats(w):
        w = w.rowsBetween(-before, 0)
        columns = {}
        for name, source in (("oil", "oil_value"), ("fuel", "fuel_liters")):
            columns |= {
                f"{name}_rolling_mean": F.mean(source).over(w),
                f"{name}_rolling_stddev": F.stddev(source).over(w),
                f"{name}_cumsum": F.sum(source).over(w),
                f"{name}_min": F.min(source).over(w),
                f"{name}_max": F.max(source).over(w),
            }
        return columns

    rows = trace.select("thing_id", *EVENT_ORDER, "oil_value", "fuel_liters")
    cuts = cuts_for(trace, ["thing_id"], "trace_date", cuts)
    return (
        Timeline(rows, ["thing_id"], EVENT_ORDER, cuts)
        .frame(before, 0, stats)
        .df.drop(*({"oil_value", "fuel_liters"} - set(keep)))
    )


def latest_row_per_vehicle(rows: DataFrame) -> DataFrame:
    return latest_by_key(rows, ["thing_id"], EVENT_ORDER)


def join_latest_features(events: DataFrame, stats: DataFrame) -> DataFrame:
    """Incoming rows with the newest stored statistics of their vehicle."""
    newest = latest_row_per_vehicle(stats).drop(*EVENT_ORDER)
    return events.join(newest, "thing_id", "left")


def constant_features(events: DataFrame) -> DataFrame:
    return events.withColumns({name: F.lit(value) for name, value in CONSTANT_FEATURES.items()})


def alert_counter(alerts: DataFrame) -> DataFrame:
    """Running number of each alert within its (type, event, user)."""
    keys = ["type_id", "event_id", "user_id"]
    timeline = Timeline(
        alerts, keys, ["alert_time", "alert_id"], hot_cuts(alerts, keys, "alert_time")
    )
    return timeline.running({"alert_number": ("count", F.lit(1))}).df


def alert_enrich(alerts: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Counted alerts with place and date attributes, as the live table holds them."""
    placed = place_lookup(alerts, gazetteer)
    dated = with_date_attributes(placed, F.to_date("alert_time"), quarter_as_text=False)
    return dated.withColumnsRenamed({"town": "municipality", "state": "province"}).select(
        *ALERT_COLUMNS
    )


def live_alerts(alerts: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """The live alert table: the newest counted row of each (type, event, user)."""
    keys = ["type_id", "event_id", "user_id"]
    row = F.struct(*[c for c in alerts.columns if c not in keys])
    newest = (
        alerts.groupBy(*keys)
        .agg(F.count("*").alias("alert_number"), F.max_by(row, F.struct("alert_time", "alert_id")).alias("_row"))
        .select(*keys, "alert_number", "_row.*")
    )
    return alert_enrich(newest, gazetteer)
