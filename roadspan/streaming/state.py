"""The resumable fold of the live state: what a key has become, and its new events.

The batch form, ``operators.live.vehicle_states``, gives the state after every event. Here
the stored state of a key takes part as one more row, placed at its own time before all events
of that time, and the events behind it are folded by the same windows and slices; the result
is merged with what the state has summed up. So any split of a stream into batches gives the
state of the whole, a key with very many events is cut into slices as elsewhere, and all of it
runs in built-in expressions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadspan.functions.scalars import haversine_km, seconds_between
from roadspan.operators.live import FUEL_PER_EVENT, ROLLING_BEFORE
from roadspan.operators.timeline import Timeline, hot_cuts

WINDOW = ROLLING_BEFORE + 1

STATE = (
    "trace_date TIMESTAMP, trace_id STRING, avg_speed DOUBLE, max_speed DOUBLE, idle_time BIGINT, "
    "active_time BIGINT, fuel DOUBLE, traveled_distance DOUBLE, latitude DOUBLE, longitude DOUBLE, "
    "engine_status INT, oil_window ARRAY<DOUBLE>, fuel_window ARRAY<DOUBLE>"
)
# The carried row of a key has _event 0 and comes before the events of its time.
ORDER = ["trace_date", "_event", "trace_id"]
KEY_TYPES = {"thing_id": "INT", "full_date": "DATE"}


def state_ddl(keys: list[str]) -> str:
    return ", ".join([*[f"{k} {KEY_TYPES[k]}" for k in keys], STATE])


def _rows(events: DataFrame, states: DataFrame, keys: list[str]) -> DataFrame:
    shown = ["trace_date", "trace_id", "latitude", "longitude", "engine_status"]
    read = ["speed", "oil_value", "fuel_liters"]
    new = events.select(*keys, *shown, *[F.col(c).cast("double") for c in read], F.lit(1).alias("_event"))
    carried = states.select(
        *keys, *shown, *[F.lit(None).cast("double").alias(c) for c in read], F.lit(0).alias("_event")
    )
    return new.unionByName(carried)


def summaries(events: DataFrame, states: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: what the events add to its state.

    ``states`` holds the stored rows of these keys. An event older than its key's state counts
    for speeds and fuel only.
    """
    rows = _rows(events, states, keys)
    is_event, carried = F.col("_event"), 1 - F.col("_event")

    def neighbours(w):
        return {
            "_at": F.lag("trace_date").over(w),
            "_lat": F.lag("latitude").over(w),
            "_lon": F.lag("longitude").over(w),
        }

    placed = (
        Timeline(rows, keys, ORDER, hot_cuts(events, keys, "trace_date"))
        .frame(1, 0, neighbours)
        .running(
            {"_events": ("sum", is_event), "_speeds": ("count", F.col("speed")), "_after": ("max", carried)}
        )
        .totals(
            {"_all_events": ("sum", is_event), "_all_speeds": ("count", F.col("speed")), "_resumed": ("max", carried)}
        )
        .df
    )
    current = (F.col("_resumed") == 0) | (F.col("_after") == 1)
    moved = current & (is_event == 1)
    gap = F.when(moved, seconds_between(F.col("_at"), F.col("trace_date")))
    step = F.when(moved, haversine_km(F.col("_lat"), F.col("_lon"), F.col("latitude"), F.col("longitude")))
    place = F.struct(*ORDER)
    # Each reading halves the weight of the earlier ones: the last has a half, the one before
    # a quarter, and so on; what is left goes to the old value.
    weight = F.pow(F.lit(2.0), F.col("_speeds") - F.col("_all_speeds") - 1)
    from_end = F.col("_all_events") - F.col("_events")
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), place))

    def last_values(column: str) -> Column:
        held = F.collect_list(
            F.when(moved & (from_end < WINDOW), F.struct((-from_end).alias("at"), F.col(column).alias("value")))
        )
        return F.transform(F.array_sort(held), lambda x: x["value"])

    newest = F.struct("trace_date", "trace_id", "latitude", "longitude", "engine_status")
    return placed.groupBy(*keys).agg(
        F.count("speed").alias("_n"),
        F.sum(F.col("speed") * weight).alias("_blend"),
        first("speed").alias("_first_speed"),
        F.max("speed").alias("_top"),
        F.coalesce(F.sum(F.when(F.col("engine_status") == 0, gap)), F.lit(0)).alias("_idle"),
        F.coalesce(F.sum(F.when(F.col("engine_status") == 1, gap)), F.lit(0)).alias("_active"),
        F.coalesce(F.sum(step), F.lit(0.0)).alias("_km"),
        F.sum(is_event).alias("_count"),
        first("fuel_liters").alias("_first_fuel"),
        F.min(F.when(F.col("fuel_liters").isNotNull(), F.col("_events"))).alias("_fuel_from"),
        F.max_by(newest, F.when(current, place)).alias("_last"),
        last_values("oil_value").alias("_oils"),
        last_values("fuel_liters").alias("_fuels"),
    )


def fold_events(events: DataFrame, states: DataFrame, keys: list[str]) -> DataFrame:
    """The new state of every key with events, from these and the stored states.

    ``events`` have non-null keys and times. Keys are (thing_id), or (thing_id, full_date) for
    a state that starts anew each day. Repeated events count each time.
    """
    named = states.select(*[F.col(k).alias(f"_old_{k}") for k in keys], F.struct("*").alias("_old"))
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_old_{k}") for k in keys])
    both = summaries(events, states, keys).join(named, same, "left")
    old = lambda c: F.col(f"_old.{c}")
    rest = F.pow(F.lit(2.0), -F.col("_n"))
    blended = F.coalesce(old("avg_speed"), F.col("_first_speed")) * rest + F.col("_blend")
    levels = F.when(
        old("fuel").isNotNull(), old("fuel") + FUEL_PER_EVENT * F.col("_count")
    ).otherwise(F.col("_first_fuel") + FUEL_PER_EVENT * (F.col("_count") - F.col("_fuel_from")))

    def window(had: Column, new: Column) -> Column:
        held = F.concat(F.coalesce(had, F.array().cast("array<double>")), new)
        return F.slice(held, F.greatest(F.size(held) - WINDOW + 1, F.lit(1)), F.lit(WINDOW))

    return both.select(
        *keys,
        "_last.trace_date",
        "_last.trace_id",
        F.when(F.col("_n") > 0, blended).otherwise(old("avg_speed")).alias("avg_speed"),
        F.greatest(old("max_speed"), F.col("_top")).alias("max_speed"),
        (F.coalesce(old("idle_time"), F.lit(0)) + F.col("_idle")).alias("idle_time"),
        (F.coalesce(old("active_time"), F.lit(0)) + F.col("_active")).alias("active_time"),
        levels.alias("fuel"),
        (F.coalesce(old("traveled_distance"), F.lit(0.0)) + F.col("_km")).alias("traveled_distance"),
        "_last.latitude",
        "_last.longitude",
        "_last.engine_status",
        window(old("oil_window"), F.col("_oils")).alias("oil_window"),
        window(old("fuel_window"), F.col("_fuels")).alias("fuel_window"),
    )


def window_features(states: DataFrame) -> DataFrame:
    """Rolling statistics of the sensor windows held in the state."""

    def stats(sensor: str) -> dict:
        values = F.filter(f"{sensor}_window", lambda v: v.isNotNull())
        n = F.size(values)
        total = F.aggregate(values, F.lit(0.0), lambda a, v: a + v)
        mean = F.when(n > 0, total / n)
        squares = F.aggregate(values, F.lit(0.0), lambda a, v: a + (v - mean) * (v - mean))
        return {
            f"{sensor}_rolling_mean": mean,
            f"{sensor}_rolling_stddev": F.when(n > 1, F.sqrt(squares / (n - 1))),
            f"{sensor}_cumsum": F.when(n > 0, total),
            f"{sensor}_min": F.array_min(values),
            f"{sensor}_max": F.array_max(values),
        }

    current = F.col("oil_window")
    return states.withColumns(
        stats("oil") | stats("fuel") | {"oil_value": F.get(current, F.size(current) - 1)}
    ).drop("oil_window", "fuel_window")
