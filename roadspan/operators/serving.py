"""Serving queries other than the KPI reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadspan.operators.kpi import of_vehicles
from roadspan.operators.loading import latest_by_key, top_per_key
from roadspan.operators.scaling import dense_ids, materialise

LIVE_ORDER = ["trace_date", "trace_id"]
# Up to this place a page is the end of a short sorted list; later ones are found by number.
NEAR_ROWS = 10_000


def page(df: DataFrame, order: list[Column], number: int, size: int, stride: int) -> DataFrame:
    """Page ``number`` (from 1) of a totally ordered frame.

    Rows far down are numbered by a range-partitioned sort, so however deep a page lies, no
    task and not the driver gathers the rows before it.
    """
    first = (number - 1) * stride
    if first + size <= NEAR_ROWS:
        return df.orderBy(*order).offset(first).limit(size)
    numbered = dense_ids(df, "_number", order)
    return numbered.filter(F.col("_number").between(first + 1, first + size)).orderBy("_number").drop("_number")


def _only(df: DataFrame, thing_id: int | None) -> DataFrame:
    return df if thing_id is None else df.filter(F.col("thing_id") == thing_id)


# --- vehicles ---------------------------------------------------------------------------


def things_all(thing_dim: DataFrame) -> DataFrame:
    return thing_dim.select("*")


def thing_by_id(thing_dim: DataFrame, thing_id: int) -> DataFrame:
    return _only(thing_dim, thing_id).select("thing_id", "thing_designation").limit(1)


def thing_search(thing_dim: DataFrame, term: str) -> DataFrame:
    return (
        thing_dim.filter(F.col("thing_designation").contains(term))
        .select("thing_id", "thing_designation")
        .distinct()
    )


def thing_types(thing_dim: DataFrame) -> DataFrame:
    return thing_dim.select("type_id", F.col("thing_type_designation").alias("type_name")).distinct()


def thing_groups(thing_dim: DataFrame, limit: int = 10) -> DataFrame:
    return thing_dim.select("group_id", "group_name").distinct().orderBy("group_id", "group_name").limit(limit)


def things_brief(thing_dim: DataFrame) -> DataFrame:
    return thing_dim.select(
        F.col("thing_designation").alias("name"), "thing_id", F.col("thing_plate").alias("plate")
    )


def things_page(thing_dim: DataFrame, number: int = 1, size: int = 15, stride: int = 10) -> DataFrame:
    """Pages of 15 that advance by 10, ordered by id."""
    return page(things_brief(thing_dim), [F.col("thing_id")], number, size, stride)


def thing_count(
    thing_dim: DataFrame, group_id: int | None = None, type_id: int | None = None
) -> DataFrame:
    if group_id is not None:
        thing_dim = thing_dim.filter(F.col("group_id") == group_id)
    elif type_id is not None:
        thing_dim = thing_dim.filter(F.col("type_id") == type_id)
    return thing_dim.agg(F.count("thing_id").alias("thing_count"))


def years_with_data(
    fact: DataFrame, date_dim: DataFrame, thing_dim: DataFrame, thing_id: int | None = None
) -> DataFrame:
    """Years with vehicle days, per vehicle."""
    rows = of_vehicles(fact.select("thing_id", "date_id"), thing_dim, thing_id)
    return rows.join(date_dim.select("date_id", "year"), "date_id").select("thing_id", "year").distinct()


def fuel_total(
    fact: DataFrame,
    thing_dim: DataFrame,
    thing_id: int | None = None,
    group_id: int | None = None,
    type_id: int | None = None,
) -> DataFrame:
    """Litres in total, cut to a whole number."""
    filtered = any(x is not None for x in (thing_id, group_id, type_id))
    rows = of_vehicles(fact, thing_dim, thing_id, group_id, type_id) if filtered else fact
    return rows.agg(F.floor(F.sum("fuel")).cast("long").alias("fuel_consumption"))


def alerts_by_type(alert_fact: DataFrame, alert_degree_dim: DataFrame) -> DataFrame:
    """Number of fact rows with a count, per alert type of the code table."""
    counted = alert_fact.groupBy("type_id").agg(F.count("alert_count").alias("alert_count"))
    codes = alert_degree_dim.select(F.col("alert_degree_id").alias("type_id"))
    return counted.join(codes, "type_id").select("type_id", "alert_count")


# --- journeys ---------------------------------------------------------------------------

# The fields of a journey that the route returns.
JOURNEY_FIELDS = [
    "thing_id", "active_time", "avg_speed", "max_speed",
    "start_point", "end_point", "start_time", "end_time", "part", "path",
]


def _journeys(journey, journey_dim, thing_dim, date_dim, thing_id, group_id, type_id) -> DataFrame:
    known = of_vehicles(journey, thing_dim, thing_id, group_id, type_id)
    return known.join(journey_dim, "journey_id").join(date_dim.select("date_id", "year"), "date_id")


def journeys_page(
    journey: DataFrame,
    journey_dim: DataFrame,
    thing_dim: DataFrame,
    date_dim: DataFrame,
    number: int = 1,
    size: int = 5,
    thing_id: int | None = None,
    group_id: int | None = None,
    type_id: int | None = None,
) -> DataFrame:
    """Pages of journeys, newest first, equal ones once; see :func:`journeys_after` for reading
    one page after the other. A page counts journeys; each gives one row per part of its path.
    """
    once = _distinct_journeys(journey, journey_dim, thing_dim, date_dim, thing_id, group_id, type_id)
    wanted = materialise(page(once, _journey_order(), number, size, size))
    return _with_paths(journey_dim, wanted).select(*JOURNEY_FIELDS)


def journeys_after(
    journey: DataFrame,
    journey_dim: DataFrame,
    thing_dim: DataFrame,
    date_dim: DataFrame,
    after: tuple[dt.datetime | None, int] | None = None,
    size: int = 5,
    thing_id: int | None = None,
    group_id: int | None = None,
    type_id: int | None = None,
) -> DataFrame:
    """The next ``size`` journeys behind ``after``, the (start_time, journey_id) of the last one seen.

    The order is that of :func:`journeys_page`, journeys without a start last; ``journey_id`` is
    among the fields. The bound on the time also prunes the dimension's scan, so a page costs
    the journeys from there on, whatever came before it.
    """
    behind = F.lit(True)
    if after is not None:
        start, last = F.col("start_time"), after[1]
        if after[0] is None:
            journey_dim = journey_dim.filter(start.isNull())
            behind = F.col("journey_id") > last
        else:
            seen = F.lit(after[0])
            journey_dim = journey_dim.filter(start.isNull() | (start <= seen))
            behind = start.isNull() | (start < seen) | ((start == seen) & (F.col("journey_id") > last))
    once = _distinct_journeys(journey, journey_dim, thing_dim, date_dim, thing_id, group_id, type_id)
    wanted = materialise(once.filter(behind).orderBy(*_journey_order()).limit(size))
    return _with_paths(journey_dim, wanted).select("journey_id", *JOURNEY_FIELDS)


def _journey_order() -> list[Column]:
    return [F.col("start_time").desc(), F.col("journey_id")]


def _distinct_journeys(journey, journey_dim, thing_dim, date_dim, thing_id, group_id, type_id) -> DataFrame:
    """Equal journeys once, without their paths.

    Journeys are compared by digests of their path, which combine before a shuffle.
    """
    ends = ["start_point", "end_point", "start_time", "end_time"]
    digests = ["_digest1", "_digest2"]
    compared = journey_dim.groupBy("journey_id", *ends).agg(
        F.bit_xor(F.xxhash64("part", "path")).alias("_digest1"),
        F.bit_xor(F.xxhash64(F.lit("path"), "path", "part")).alias("_digest2"),
    )
    rows = _journeys(journey, compared, thing_dim, date_dim, thing_id, group_id, type_id)
    shown = [c for c in JOURNEY_FIELDS if c not in ("part", "path")]
    once = rows.groupBy("year", *digests, *shown).agg(F.min("journey_id").alias("journey_id"))
    return once.select("journey_id", *shown)


def _with_paths(journey_dim: DataFrame, wanted: DataFrame) -> DataFrame:
    """The journeys of a page with their paths, one row per part."""
    # A page holds few rows, so it is broadcast and the dimension is not shuffled.
    paths = journey_dim.select("journey_id", "part", "path")
    return paths.join(F.broadcast(wanted), "journey_id").orderBy(*_journey_order(), "part")


def journey_count(
    journey: DataFrame,
    journey_dim: DataFrame,
    thing_dim: DataFrame,
    date_dim: DataFrame,
    thing_id: int | None = None,
    group_id: int | None = None,
    type_id: int | None = None,
) -> DataFrame:
    dims = journey_dim.select("journey_id")
    rows = _journeys(journey, dims, thing_dim, date_dim, thing_id, group_id, type_id)
    return rows.groupBy("year").agg(F.count("journey_id").alias("journey_count"))


# --- live state -------------------------------------------------------------------------


def active_count(live_state: DataFrame) -> DataFrame:
    return live_state.agg(F.count("thing_id").alias("active_count"))


def live_latest(trace: DataFrame, thing_id: int | None = None) -> DataFrame:
    """Newest trace row, of one vehicle or of each."""
    # The fields that the route returns.
    columns = [
        "thing_id", "trace_date", "trace_id", "engine_status", "fuel_liters", "fuel_percent",
        "latitude", "longitude", "speed", "oil_value", "battery",
    ]
    newest = latest_by_key(_only(trace, thing_id).select(*columns), ["thing_id"], LIVE_ORDER)
    return newest.drop("trace_id").withColumnsRenamed(
        {"trace_date": "timestamp", "engine_status": "status"}
    )


def live_position(trace: DataFrame, thing_id: int | None = None) -> DataFrame:
    return live_latest(trace, thing_id).select("thing_id", "timestamp", "latitude", "longitude", "speed")


def live_vehicles(
    live_state: DataFrame,
    thing_id: int | None = None,
    type_id: int | None = None,
    group_id: int | None = None,
) -> DataFrame:
    """Live state of all vehicles, of one, else of a type, else of a group."""
    for column, value in (("thing_id", thing_id), ("type_id", type_id), ("group_id", group_id)):
        if value is not None:
            live_state = live_state.filter(F.col(column) == value)
            break
    return live_state.select(
        "latitude", "longitude", "thing_id", "thing_name", "active_time", "avg_speed", "max_speed"
    )


def live_vehicle_rul(live_state: DataFrame, thing_id: int | None = None) -> DataFrame:
    return _only(live_state, thing_id).select(
        "latitude", "longitude", "thing_id", "active_time", "avg_speed", "max_speed",
        F.col("maintenance").alias("prediction"), F.ceil("rul").cast("long").alias("rul"),
    )


def sensor_history(
    trace: DataFrame, sensor: str, thing_id: int | None = None, limit: int = 100
) -> DataFrame:
    """The newest readings of one sensor, of one vehicle or of each."""
    order = [F.col(c).desc() for c in LIVE_ORDER]
    rows = trace.select("thing_id", sensor, *LIVE_ORDER)
    if thing_id is None:
        newest = top_per_key(rows, ["thing_id"], order, limit)
    else:
        newest = _only(rows, thing_id).orderBy(*order).limit(limit)
    return newest.withColumn("label", F.date_format("trace_date", "mm:ss"))


def engine_on_points(trace: DataFrame, thing_id: int | None = None) -> DataFrame:
    """Positions with the engine on, in time order."""
    on = _only(trace, thing_id).filter(F.col("engine_status") == 1)
    return on.orderBy("thing_id", *LIVE_ORDER).select("thing_id", "trace_date", "latitude", "longitude")


# --- maintenance list -------------------------------------------------------------------


def maintenance_open(maintenance: DataFrame) -> DataFrame:
    """Entries that are not done; an entry without a status is left out."""
    return maintenance.filter(F.col("maintenance") != "done").select(
        "name", "maintenance", "maintenance_date", "thing_id"
    )


def maintenance_mark_done(maintenance: DataFrame, thing_id: int) -> DataFrame:
    """The list with a vehicle's entries done; the caller writes it as a new version."""
    return maintenance.withColumn(
        "maintenance",
        F.when(F.col("thing_id") == thing_id, F.lit("done")).otherwise(F.col("maintenance")),
    )


def maintenance_add(maintenance: DataFrame, thing_id: int, as_of: dt.datetime) -> DataFrame:
    entry = maintenance.sparkSession.range(1).select(
        F.lit(thing_id).alias("thing_id"),
        F.lit(f"car{thing_id}").alias("name"),
        F.lit("Soon").alias("maintenance"),
        F.lit(as_of).cast("timestamp").alias("maintenance_date"),
    )
    return maintenance.unionByName(entry, allowMissingColumns=True)
