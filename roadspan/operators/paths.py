"""Paths: ordered points, their text form, and the greedy cleaning filters.

A path is a set of rows (path_id, seq, latitude, longitude). Where an array is
needed the path is cut into parts of at most POINTS_PER_PART points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadspan.functions.scalars import haversine_km
from roadspan.operators.scaling import materialise

POINTS_PER_PART = 512
MIN_STEP_KM = 0.01
MAX_JUMP_KM = 1.0


def format_path(points: Column, decimals: int | None = None) -> Column:
    """Array of (lat, lon) to 'lat,lon;lat,lon'."""

    def number(value: Column) -> Column:
        return value.cast("string") if decimals is None else F.format_string(f"%.{decimals}f", value)

    return F.array_join(
        F.transform(points, lambda p: F.concat(number(p["lat"]), F.lit(","), number(p["lon"]))), ";"
    )


def parse_path(path: Column) -> Column:
    """'lat,lon;lat,lon' to an array of (lat, lon); NULL when a number does not parse."""

    def point(text: Column) -> Column:
        pair = F.split(text, ",")
        return F.struct(
            F.get(pair, 0).try_cast("double").alias("lat"), F.get(pair, 1).try_cast("double").alias("lon")
        )

    points = F.transform(F.split(path, ";"), point)
    broken = F.exists(points, lambda p: p["lat"].isNull() | p["lon"].isNull())
    return F.when(~broken, points)


def path_parts(points: DataFrame, points_per_part: int = POINTS_PER_PART) -> DataFrame:
    """(path_id, part, pts): consecutive points gathered into bounded arrays."""
    return (
        points.withColumn("part", F.floor(F.col("seq") / points_per_part))
        .groupBy("path_id", "part")
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct("seq", F.col("latitude").alias("lat"), F.col("longitude").alias("lon"))
                )
            ).alias("pts")
        )
    )


def path_text(
    points: DataFrame, decimals: int | None = None, points_per_part: int = POINTS_PER_PART
) -> DataFrame:
    """(path_id, part, n_points, path) with the text of each part."""
    return path_parts(points, points_per_part).select(
        "path_id", "part", F.size("pts").alias("n_points"), format_path(F.col("pts"), decimals).alias("path")
    )


POINT = "struct<seq:bigint,lat:double,lon:double>"


def _goes_on(last: Column, point: Column, keep) -> Column:
    distance = haversine_km(last["lat"], last["lon"], point["lat"], point["lon"])
    return last.isNull() | keep(distance)


def _last_kept(points: Column, carry: Column, keep) -> Column:
    """The last kept point after the part, starting from ``carry``."""
    return F.aggregate(points, carry, lambda last, p: F.when(_goes_on(last, p, keep), p).otherwise(last))


def _kept(points: Column, carry: Column, keep) -> Column:
    """The part's points kept one after the other, starting from ``carry``."""
    start = F.struct(F.array().cast(f"array<{POINT}>").alias("kept"), carry.alias("last"))

    def step(state: Column, point: Column) -> Column:
        taken = F.struct(F.concat(state["kept"], F.array(point)).alias("kept"), point.alias("last"))
        return F.when(_goes_on(state["last"], point, keep), taken).otherwise(state)

    return F.aggregate(points, start, step)["kept"]


def greedy_filter(points: DataFrame, keep, points_per_part: int = POINTS_PER_PART) -> DataFrame:
    """Keep the first point of each path, then each point for which ``keep(distance to
    the last kept point)`` holds.

    Every part of a path is filtered on its own, starting from the last kept point of
    the part before. That point is unknown at first, so the starts of long paths are
    settled in rounds until none changes, which is the exact result. The filter
    forgets its start after a few points, so a few rounds are the rule. Between rounds
    one slim row per part is written; the points themselves are written once.
    """
    unknown = F.lit(None).cast(POINT)
    parts = materialise(path_parts(points, points_per_part))
    long_paths = parts.filter("part > 0").select("path_id").distinct()
    if long_paths.isEmpty():
        kept = parts.select("path_id", _kept(F.col("pts"), unknown, keep).alias("kept"))
    else:
        starts = _settled_starts(parts.join(long_paths, "path_id", "left_semi"), keep)
        kept = parts.join(starts, ["path_id", "part"], "left").select(
            "path_id", _kept(F.col("pts"), F.col("start"), keep).alias("kept")
        )
    return kept.select("path_id", F.explode("kept").alias("p")).select(
        "path_id", "p.seq", F.col("p.lat").alias("latitude"), F.col("p.lon").alias("longitude")
    )


def _settled_starts(parts: DataFrame, keep) -> DataFrame:
    """(path_id, part, start): the last kept point before each part.

    A part that keeps nothing hands its start on, so the start proposed for a part is
    the last point of the nearest earlier part that keeps something. The parts before
    the first one whose start differs from the proposal are settled. Each round tries
    every open part with two starts: the point that leaves the settled parts, which
    settles all following parts that keep nothing after it (a parked vehicle, or a
    bad first fix that holds everything back) and the one after them, and the
    proposed start, by which moving stretches settle side by side.
    """
    keys = ["path_id", "part"]
    earlier = Window.partitionBy("path_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    own = Window.partitionBy("path_id")
    unknown = F.lit(None).cast(POINT)
    state = materialise(
        parts.select(
            *keys,
            unknown.alias("start"),
            _last_kept(F.col("pts"), unknown, keep).alias("last"),
            F.lit(False).alias("through"),
        )
    )
    while True:
        leaving = F.last(F.when(~F.col("through"), F.col("last")), ignorenulls=True)
        proposed = state.select(*keys, "start", leaving.over(earlier).alias("given"))
        differs = ~F.col("given").eqNullSafe(F.col("start"))
        first = F.min(F.when(differs, F.struct("part", "given"))).over(own)
        todo = materialise(
            proposed.withColumn("_first", first)
            .filter(F.col("part") >= F.col("_first.part"))
            .select(*keys, "given", F.col("_first.given").alias("frontier"))
        )
        if todo.isEmpty():
            return state.select(*keys, "start")
        tried = parts.join(todo, keys).select(
            *keys,
            "given",
            "frontier",
            _last_kept(F.col("pts"), F.col("frontier"), keep).alias("_at_frontier"),
            _last_kept(F.col("pts"), F.col("given"), keep).alias("_at_given"),
        )
        stops = F.min(F.when(F.col("_at_frontier") != F.col("frontier"), F.col("part"))).over(own)
        reached = F.coalesce(F.col("part") <= F.col("_stop"), F.lit(True))
        redone = tried.withColumn("_stop", stops).select(
            *keys,
            F.when(reached, F.col("frontier")).otherwise(F.col("given")).alias("new_start"),
            F.when(reached, F.col("_at_frontier")).otherwise(F.col("_at_given")).alias("new_last"),
        )
        state = materialise(
            state.join(redone, keys, "left").select(
                *keys,
                F.coalesce("new_start", "start").alias("start"),
                F.coalesce("new_last", "last").alias("last"),
                F.coalesce(F.col("new_start") == F.col("new_last"), F.col("through")).alias("through"),
            )
        )


def filter_dense_clusters(
    points: DataFrame, min_km: float = MIN_STEP_KM, points_per_part: int = POINTS_PER_PART
) -> DataFrame:
    """Drop points closer than ``min_km`` to the last kept one."""
    return greedy_filter(points, lambda km: km >= min_km, points_per_part)


def filter_large_jumps(
    points: DataFrame, max_km: float = MAX_JUMP_KM, points_per_part: int = POINTS_PER_PART
) -> DataFrame:
    """Drop points farther than ``max_km`` from the last kept one."""
    return greedy_filter(points, lambda km: km <= max_km, points_per_part)


def path_clean(
    paths: DataFrame, decimals: int | None = None, points_per_part: int = POINTS_PER_PART
) -> DataFrame:
    """Replace each stored path by its cleaned form: dense clusters, then large jumps.

    ``paths`` holds (path_id, part, path) text. A path that does not parse stays as
    it is.
    """
    parsed = paths.withColumn("_points", parse_path(F.col("path"))).withColumn(
        "_count", F.size("_points")
    )
    usable = parsed.groupBy("path_id").agg(
        (F.count("*") == F.count("_points")).alias("_usable")
    )
    earlier = Window.partitionBy("path_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parsed.select(
        "path_id", "part", F.coalesce(F.sum("_count").over(earlier), F.lit(0)).alias("_base")
    )
    points = (
        parsed.join(usable.filter("_usable"), "path_id", "left_semi")
        .join(bases, ["path_id", "part"])
        .select("path_id", "part", "_base", F.posexplode("_points").alias("_pos", "_p"))
        .select(
            "path_id",
            (F.col("_base") + F.col("_pos")).alias("seq"),
            F.col("_p.lat").alias("latitude"),
            F.col("_p.lon").alias("longitude"),
        )
    )
    dense = filter_dense_clusters(points, points_per_part=points_per_part)
    cleaned = filter_large_jumps(dense, points_per_part=points_per_part)
    text = path_text(cleaned, decimals, points_per_part).select("path_id", "part", "path")
    unusable = paths.join(usable.filter("_usable"), "path_id", "left_anti")
    return text.unionByName(unusable.select("path_id", "part", "path"))
