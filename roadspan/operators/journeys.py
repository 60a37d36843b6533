"""Journeys: engine-on stretches of a vehicle's trace.

All steps work on rows keyed by (vehicle, segment), where the segment number is the
running count of engine starts. Only bounded pieces are ever collected into arrays.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadspan.functions.scalars import seconds_between
from roadspan.operators.facts import with_date_id
from roadspan.operators.paths import path_text
from roadspan.operators.places import place_lookup
from roadspan.operators.scaling import materialise
from roadspan.operators.timeline import AUTO, Cuts, Timeline, cuts_for, hot_cuts

SOURCE_COLUMNS = [
    "thing_id", "date_id", "trace_date", "engine_status", "latitude", "longitude", "journey", "speed",
]
SOURCE_ORDER = [
    "trace_date", "engine_status", "latitude", "longitude", "journey", "speed", "date_id",
]

# Vehicles per block when journey ids are summed up; see journey_ids.
VEHICLES_PER_BLOCK = 4096


def journey_source(
    trace: DataFrame,
    date_dim: DataFrame,
    after_date_id: int | None = None,
    max_date_id: int | None = None,
    max_thing_id: int | None = None,
    cuts: Cuts = AUTO,
) -> DataFrame:
    """Distinct dated trace rows within the given windows.

    Without a large vehicle the rows are placed by vehicle before duplicates go, so
    the windows that follow need no second shuffle.
    """
    if max_thing_id is not None:
        trace = trace.filter(F.col("thing_id") <= max_thing_id)
    calendar = date_dim
    if after_date_id is not None:
        calendar = calendar.filter(F.col("date_id") > after_date_id)
    if max_date_id is not None:
        calendar = calendar.filter(F.col("date_id") <= max_date_id)
    rows = with_date_id(trace, calendar).select(*SOURCE_COLUMNS)
    if cuts_for(trace, ["thing_id"], "trace_date", cuts) is None:
        rows = rows.repartition("thing_id")
    return rows.distinct()


def _status_before(w):
    return {
        "prev_engine_status": F.lag("engine_status").over(w),
        "_status_before_prev": F.lag("engine_status", 2).over(w),
    }


def _with_edges(df: DataFrame) -> DataFrame:
    def edge(before: str, now: str, start: int):
        return F.coalesce((F.col(before) == start) & (F.col(now) == 1 - start), F.lit(False))

    return df.withColumns(
        {
            "rise": edge("prev_engine_status", "engine_status", 0),
            "fall": edge("prev_engine_status", "engine_status", 1),
            "_after_fall": edge("_status_before_prev", "prev_engine_status", 1),
        }
    ).drop("_status_before_prev")


def _timeline(source: DataFrame, cuts: Cuts) -> Timeline:
    line = Timeline(
        source, ["thing_id"], SOURCE_ORDER, cuts_for(source, ["thing_id"], "trace_date", cuts)
    )
    return line.frame(2, 0, _status_before).map(_with_edges)


def engine_edges(source: DataFrame, cuts: Cuts = AUTO) -> DataFrame:
    """Rows where the engine goes on (rise) or off (fall); a first row is never one."""
    rows = _timeline(source, cuts).df.drop("_after_fall")
    return rows.filter(F.col("rise") | F.col("fall"))


def segment_rows(source: DataFrame, cuts: Cuts = AUTO) -> DataFrame:
    """Rows from each engine start up to the stop that follows, both included.

    ``segment`` counts the vehicle's engine starts and ``position`` its rows.
    """
    running = _timeline(source, cuts).running(
        {
            "segment": ("sum", F.col("rise").cast("long")),
            "position": ("count", F.lit(1)),
            "_open": ("last", F.when(F.col("rise"), True).when(F.col("_after_fall"), False)),
        }
    )
    return running.df.filter(F.col("_open")).drop("_open", "_after_fall")


def journey_segments(rows: DataFrame) -> DataFrame:
    """One row per engine start; ``end_time`` is NULL while the journey is not closed.

    A segment has one rise and at most one fall, so plain conditional aggregates pick
    their values and combine before the shuffle.
    """

    def at(edge: str, column: str):
        return F.max(F.when(F.col(edge), F.col(column)))

    return rows.groupBy("thing_id", "segment").agg(
        at("rise", "trace_date").alias("start_time"),
        at("rise", "journey").alias("start_journey"),
        at("rise", "latitude").alias("start_latitude"),
        at("rise", "longitude").alias("start_longitude"),
        at("rise", "position").alias("start_position"),
        at("fall", "trace_date").alias("end_time"),
        at("fall", "journey").alias("end_journey"),
        at("fall", "latitude").alias("end_latitude"),
        at("fall", "longitude").alias("end_longitude"),
        at("fall", "date_id").alias("date_id"),
        F.count("*").alias("n_points"),
    )


def journey_ids(segments: DataFrame, last_id: int = 0) -> DataFrame:
    """Number every engine start over (vehicle, time), continuing after ``last_id``.

    The id is the number of starts of all lower vehicles plus the segment number. The
    sum over lower vehicles goes by blocks of vehicles, so no window spans them all.
    The segments are read three times here; give a stored frame.
    """
    block = F.floor(F.col("thing_id") / VEHICLES_PER_BLOCK)
    per_thing = (
        segments.groupBy("thing_id").agg(F.max("segment").alias("_starts")).withColumn("_block", block)
    )
    blocks = per_thing.groupBy("_block").agg(F.sum("_starts").alias("_in_block"))
    lower = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("_block", F.coalesce(F.sum("_in_block").over(lower), F.lit(0)).alias("_base"))
    within = Window.partitionBy("_block").orderBy("thing_id").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        per_thing.withColumn("_within", F.coalesce(F.sum("_starts").over(within), F.lit(0)))
        .join(blocks, "_block")
        .select("thing_id", (F.col("_base") + F.col("_within")).alias("_offset"))
    )
    return (
        segments.join(offsets, "thing_id")
        .withColumn("journey_id", (F.col("_offset") + F.col("segment") + last_id).cast("long"))
        .drop("_offset")
    )


def closed_journeys(numbered: DataFrame) -> DataFrame:
    """Closed journeys with a known start odometer."""
    return numbered.filter(F.col("end_time").isNotNull() & F.col("start_journey").isNotNull())


def journey_measures(journeys: DataFrame) -> DataFrame:
    """Kilometres by odometer, active minutes, and the day of the last row."""
    return journeys.select(
        "journey_id",
        "thing_id",
        (F.col("end_journey") - F.col("start_journey")).alias("traveled_distance"),
        F.lit(0.0).alias("idle_time"),
        (seconds_between(F.col("start_time"), F.col("end_time")) / 60.0).alias("active_time"),
        "date_id",
        "start_time",
        "end_time",
    )


def journey_speed_stats(
    trace: DataFrame, journeys: DataFrame, moving_only: bool = False, cuts: Cuts = AUTO
) -> DataFrame:
    """Mean and top speed over all raw rows of the vehicle within the journey's times.

    Journeys of a vehicle follow each other, so a row is inside the newest journey that
    has started, and beside it only inside journeys that end in the row's very second.
    Both are running values over the vehicle's rows mixed with journey starts and ends:
    the work grows with rows plus journeys, however dense the journeys of a vehicle.
    With a large vehicle the rows are summed per second first, which takes copies out.
    """
    if moving_only:
        trace = trace.filter(F.col("max_speed") > 0)
    cuts = cuts_for(trace, ["thing_id"], "trace_date", cuts)
    speed = F.col("speed").cast("double")
    sums = [F.sum("_sum").alias("_sum"), F.sum("_count").alias("_count"), F.max("_max").alias("_max")]
    rows = trace.select(
        "thing_id",
        "trace_date",
        speed.alias("_sum"),
        F.when(speed.isNotNull(), 1).otherwise(0).cast("long").alias("_count"),
        speed.alias("_max"),
    )
    if cuts is not None:
        rows = rows.groupBy("thing_id", "trace_date").agg(*sums)

    # Within a second come the ends, then the starts (the longest journey last), then
    # the rows.
    starts = journeys.select(
        "thing_id", F.col("start_time").alias("trace_date"), F.lit(1).alias("_kind"),
        F.col("end_time").alias("_until"), F.col("journey_id").alias("_id"),
    )
    ends = journeys.select("thing_id", F.col("end_time").alias("trace_date"), F.lit(0).alias("_kind"))
    mixed = (
        rows.withColumn("_kind", F.lit(2))
        .unionByName(starts, allowMissingColumns=True)
        .unionByName(ends, allowMissingColumns=True)
    )
    newest = F.when(F.col("_kind") == 1, F.struct("_id", "_until"))
    ended = F.when(F.col("_kind") == 0, F.col("trace_date"))
    placed = (
        Timeline(mixed, ["thing_id"], ["trace_date", "_kind", "_until", "_id"], cuts)
        .running({"_newest": ("last", newest), "_ended": ("last", ended)})
        .df.filter(F.col("_kind") == 2)
    )
    # One row per journey and per second in which a journey ends.
    summed = materialise(
        placed.select(
            "thing_id",
            F.col("_newest._id").alias("_newest_id"),
            (F.col("trace_date") <= F.col("_newest._until")).alias("_inside"),
            F.when(F.col("_ended") == F.col("trace_date"), F.col("trace_date")).alias("_end_second"),
            "_sum", "_count", "_max",
        )
        .filter(F.col("_inside") | F.col("_end_second").isNotNull())
        .groupBy("thing_id", "_newest_id", "_inside", "_end_second")
        .agg(*sums)
    )
    parts = ["journey_id", "_sum", "_count", "_max"]
    inside = summed.filter("_inside").withColumnRenamed("_newest_id", "journey_id").select(*parts)
    ending = (
        summed.filter("_end_second IS NOT NULL")
        .join(
            journeys.select("journey_id", "thing_id", F.col("end_time").alias("_end_second")),
            ["thing_id", "_end_second"],
        )
        .filter(F.col("journey_id") != F.col("_newest_id"))
        .select(*parts)
    )
    stats = (
        inside.unionByName(ending)
        .groupBy("journey_id")
        .agg(
            (F.sum("_sum") / F.sum("_count")).alias("avg_speed"), F.max("_max").alias("max_speed")
        )
    )
    return journeys.select("journey_id", "thing_id").join(stats, "journey_id", "left")


def journey_points(rows: DataFrame, journeys: DataFrame) -> DataFrame:
    """The points of each journey in order, one row per point, from 0."""
    keys = journeys.select("journey_id", "thing_id", "segment", "start_position")
    return rows.join(keys, ["thing_id", "segment"]).select(
        F.col("journey_id").alias("path_id"),
        (F.col("position") - F.col("start_position")).alias("seq"),
        "latitude",
        "longitude",
    )


def journey_endpoints(journeys: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Place of the first and of the last point, as 'town, state, country'."""
    placed = place_lookup(journeys, gazetteer, "start_latitude", "start_longitude", "start_")
    placed = place_lookup(placed, gazetteer, "end_latitude", "end_longitude", "end_")

    def named(prefix: str):
        return F.concat_ws(", ", *[f"{prefix}{f}" for f in ("town", "state", "country")])

    return placed.select(
        "journey_id", named("start_").alias("start_point"), named("end_").alias("end_point")
    )


def journey_dim(journeys: DataFrame, endpoints: DataFrame, paths: DataFrame) -> DataFrame:
    """The journey dimension. ``part`` numbers the path texts of a journey: always 0,
    unless the path has more than POINTS_PER_PART points and continues in 1, 2, …"""
    return (
        journeys.select("journey_id", "start_time", "end_time")
        .join(endpoints, "journey_id")
        .join(paths.select(F.col("path_id").alias("journey_id"), "part", "path"), "journey_id")
        .select("journey_id", "start_point", "end_point", "start_time", "end_time", "part", "path")
    )


def journey(measures: DataFrame, speeds: DataFrame) -> DataFrame:
    """The journey fact."""
    return measures.join(speeds.drop("thing_id"), "journey_id").select(
        "journey_id", "thing_id", "traveled_distance", "idle_time", "active_time",
        "avg_speed", "max_speed", "date_id",
    )


def delete_empty_paths(dim: DataFrame) -> DataFrame:
    """The journeys with a point in any part of their path, with all their parts."""
    left = dim.groupBy("journey_id").agg(F.max(F.col("path") != "").alias("_any")).filter("_any")
    return dim.join(left.select("journey_id"), "journey_id", "left_semi")


def delete_orphan_journeys(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Facts whose journey is still in the dimension."""
    return fact.join(dim.select("journey_id"), "journey_id", "left_semi")



class JourneyRun:
    """One pass from the trace to the journey tables.

    The trace is shuffled once. What several tables need is written to the checkpoint
    folder: the segments (one row per journey), and with ``keep_rows`` also the rows
    inside journeys, from which paths are made.
    """

    def __init__(
        self,
        trace: DataFrame,
        date_dim: DataFrame,
        last_id: int = 0,
        keep_rows: bool = False,
        **windows: int | None,
    ):
        self.trace, self.last_id, self.keep_rows = trace, last_id, keep_rows
        self.cuts = hot_cuts(trace, ["thing_id"], "trace_date")
        self.source = journey_source(trace, date_dim, cuts=self.cuts, **windows)

    @cached_property
    def rows(self) -> DataFrame:
        rows = segment_rows(self.source, self.cuts)
        if not self.keep_rows:
            return rows
        return materialise(rows.drop("engine_status", "prev_engine_status", "speed"))

    @cached_property
    def numbered(self) -> DataFrame:
        return materialise(journey_ids(materialise(journey_segments(self.rows)), self.last_id))

    @cached_property
    def closed(self) -> DataFrame:
        return closed_journeys(self.numbered)

    def speeds(self) -> DataFrame:
        return journey_speed_stats(self.trace, self.closed, cuts=self.cuts)

    def fact(self) -> DataFrame:
        return journey(journey_measures(self.closed), self.speeds())

    def points(self) -> DataFrame:
        return journey_points(self.rows, self.closed)

    def paths(self, decimals: int | None = None) -> DataFrame:
        return path_text(self.points(), decimals)

    def endpoints(self, gazetteer: DataFrame) -> DataFrame:
        return journey_endpoints(self.closed, gazetteer)

    def dim(self, gazetteer: DataFrame, decimals: int | None = None) -> DataFrame:
        return journey_dim(self.closed, self.endpoints(gazetteer), self.paths(decimals))
