"""Queries over journeys and paths, and the serving queries that need them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadspan.operators import journeys, live, paths, serving
from roadspan.operators.dims import alert_degree_dim
from roadspan.operators.facts import alert_fact
from roadspan.operators.scaling import materialise
from roadspan.operators.timeline import Timeline, hot_cuts
from roadspan.plans import kpi_queries, warehouse
from roadspan.plans.fixtures import AS_OF, Inputs
from roadspan.plans.oracle import r6
from roadspan.plans.registry import query, register, rounded

DECIMALS = 6


def run_of(i: Inputs, keep_rows: bool = False) -> journeys.JourneyRun:
    return journeys.JourneyRun(i.trace_week, warehouse.date_dim(i), keep_rows=keep_rows)


def thing_points(i: Inputs) -> DataFrame:
    """One path per vehicle, over all its trace rows."""
    rows = i.trace_week.select("thing_id", "trace_date", "trace_id", "latitude", "longitude")
    timeline = Timeline(
        rows, ["thing_id"], ["trace_date", "trace_id"], hot_cuts(rows, ["thing_id"], "trace_date")
    )
    return timeline.running({"position": ("count", F.lit(1))}).df.select(
        F.col("thing_id").alias("path_id"), (F.col("position") - 1).alias("seq"), "latitude", "longitude"
    )


@query("journey_source", "SELECT * FROM jsource")
def _source(i: Inputs) -> DataFrame:
    return run_of(i).source


@query(
    "engine_edges",
    """SELECT thing_id, date_id, trace_date, engine_status, latitude, longitude, journey, speed,
    prev_engine_status, rise, fall FROM jrows WHERE rise OR fall""",
)
def _edges(i: Inputs) -> DataFrame:
    run = run_of(i)
    return journeys.engine_edges(run.source, run.cuts)


@query(
    "journey_segments",
    """SELECT thing_id, segment, trace_date AS start_time, end_time, journey AS start_journey,
    end_journey, end_date_id AS date_id, end_pos - pos + 1 AS n_points FROM jstarts WHERE closed""",
)
def _segments(i: Inputs) -> DataFrame:
    closed = journeys.journey_segments(run_of(i).rows).filter("end_time IS NOT NULL")
    return closed.select(
        "thing_id", "segment", "start_time", "end_time", "start_journey", "end_journey", "date_id",
        "n_points",
    )


@query("journey_ids", "SELECT journey_id, thing_id, segment, trace_date AS start_time FROM jstarts")
def _ids(i: Inputs) -> DataFrame:
    return run_of(i).numbered.select("journey_id", "thing_id", "segment", "start_time")


@query(
    "journey_measures",
    f"""SELECT journey_id, thing_id, {r6('end_journey - journey', 'traveled_distance')},
    CAST(0 AS DOUBLE) AS idle_time,
    {r6("date_diff('second', trace_date, end_time) / CAST(60 AS DOUBLE)", 'active_time')},
    end_date_id AS date_id, trace_date AS start_time, end_time FROM jclosed""",
)
def _measures(i: Inputs) -> DataFrame:
    return rounded(journeys.journey_measures(run_of(i).closed), "traveled_distance", "active_time")


@query(
    "journey_speed_stats",
    f"""SELECT c.journey_id, c.thing_id, {r6('avg_speed', 'avg_speed')}, max_speed
    FROM jclosed c LEFT JOIN jspeeds s ON c.journey_id = s.journey_id""",
)
def _speeds(i: Inputs) -> DataFrame:
    return rounded(run_of(i).speeds(), "avg_speed")


@query("journey_path", "SELECT journey_id, part, n_points, path FROM jpaths")
def _paths(i: Inputs) -> DataFrame:
    return run_of(i, keep_rows=True).paths(DECIMALS).withColumnRenamed("path_id", "journey_id")


@query("journey_endpoints", "SELECT journey_id, start_point, end_point FROM jdim")
def _endpoints(i: Inputs) -> DataFrame:
    return run_of(i).endpoints(i.gazetteer)


@query(
    "journey_dim",
    "SELECT journey_id, start_point, end_point, start_time, end_time, part, path FROM jdim",
)
def _dim(i: Inputs) -> DataFrame:
    return run_of(i, keep_rows=True).dim(i.gazetteer, DECIMALS)


FACT_SQL = f"""journey_id, thing_id, {r6('traveled_distance', 'traveled_distance')}, idle_time,
{r6('active_time', 'active_time')}, {r6('avg_speed', 'avg_speed')}, max_speed, date_id"""


@query("journey", f"SELECT {FACT_SQL} FROM jfact")
def _fact(i: Inputs) -> DataFrame:
    return rounded(run_of(i).fact(), "traveled_distance", "active_time", "avg_speed")


@query(
    "parse_path",
    """SELECT journey_id, CAST(seq AS INT) AS pos, CAST(printf('%.6f', latitude) AS DOUBLE) AS lat,
    CAST(printf('%.6f', longitude) AS DOUBLE) AS lon FROM jpoints""",
)
def _parse_path(i: Inputs) -> DataFrame:
    parsed = run_of(i, keep_rows=True).paths(DECIMALS).select(
        F.col("path_id").alias("journey_id"),
        "part",
        F.posexplode(paths.parse_path(F.col("path"))).alias("_pos", "_p"),
    )
    position = (F.col("part") * paths.POINTS_PER_PART + F.col("_pos")).cast("int")
    return parsed.select("journey_id", position.alias("pos"), "_p.lat", "_p.lon")


@query(
    "format_path",
    "SELECT thing_id, trace_id, printf('%.6f,%.6f', latitude, longitude) AS path FROM trace_src",
)
def _format_path(i: Inputs) -> DataFrame:
    point = F.array(F.struct(F.col("latitude").alias("lat"), F.col("longitude").alias("lon")))
    return i.trace_src.select(
        "thing_id", "trace_id", paths.format_path(point, DECIMALS).alias("path")
    )


@query(
    "filter_dense_clusters",
    f"""SELECT thing_id AS path_id, q.seq AS seq, {r6('q.lat', 'latitude')}, {r6('q.lon', 'longitude')}
    FROM (SELECT thing_id, unnest(p) AS q FROM thing_dense)""",
)
def _dense(i: Inputs) -> DataFrame:
    return rounded(paths.filter_dense_clusters(thing_points(i)), "latitude", "longitude")


@query(
    "filter_large_jumps",
    f"""SELECT thing_id AS path_id, q.seq AS seq, {r6('q.lat', 'latitude')}, {r6('q.lon', 'longitude')}
    FROM (SELECT thing_id, unnest(p) AS q FROM thing_clean)""",
)
def _jumps(i: Inputs) -> DataFrame:
    dense = paths.filter_dense_clusters(thing_points(i))
    return rounded(paths.filter_large_jumps(dense), "latitude", "longitude")


@query(
    "path_clean",
    """SELECT journey_id, CAST(0 AS BIGINT) AS part, list_aggregate(list_transform(p,
    lambda x: printf('%.6f,%.6f', x.lat, x.lon)), 'string_agg', ';') AS path FROM journey_cleaned""",
)
def _path_clean(i: Inputs) -> DataFrame:
    stored = run_of(i, keep_rows=True).paths(DECIMALS).select("path_id", "part", "path")
    return paths.path_clean(stored, DECIMALS).withColumnRenamed("path_id", "journey_id")


def emptied(dim: DataFrame) -> DataFrame:
    """The dimension as it is after a run that left short paths empty, over all their parts."""
    points = dim.groupBy("journey_id").agg(F.sum(F.size(F.split("path", ";"))).alias("_points"))
    return dim.join(points, "journey_id").withColumn(
        "path", F.when(F.col("_points") < 3, F.lit("")).otherwise(F.col("path"))
    ).drop("_points")


@query("delete_empty_paths", "SELECT journey_id, path FROM jdim WHERE n_points >= 3")
def _delete_empty(i: Inputs) -> DataFrame:
    return journeys.delete_empty_paths(emptied(run_of(i, keep_rows=True).dim(i.gazetteer, DECIMALS))).select("journey_id", "path")


@query(
    "delete_orphan_journeys",
    f"""SELECT {FACT_SQL} FROM jfact WHERE journey_id NOT IN (
    SELECT journey_id FROM jdim WHERE n_points < 3)""",
)
def _delete_orphans(i: Inputs) -> DataFrame:
    run = run_of(i, keep_rows=True)
    stored = run.paths(DECIMALS).withColumnRenamed("path_id", "journey_id")
    left = journeys.delete_empty_paths(emptied(stored))
    fact = journeys.delete_orphan_journeys(run.fact(), left)
    return rounded(fact, "traveled_distance", "active_time", "avg_speed")


# --- serving --------------------------------------------------------------------------------


def _things(name: str, oracle: str, build) -> None:
    register(name, lambda i: build(warehouse.thing_dim(i)), oracle)


_things("things_all", "SELECT * FROM thing_dim", serving.things_all)
_things(
    "thing_by_id",
    "SELECT thing_id, thing_designation FROM thing_dim WHERE thing_id = 7",
    lambda d: serving.thing_by_id(d, 7),
)
_things(
    "thing_search",
    "SELECT DISTINCT thing_id, thing_designation FROM thing_dim WHERE thing_designation LIKE '%00012%'",
    lambda d: serving.thing_search(d, "00012"),
)
_things("thing_types", "SELECT DISTINCT type_id, thing_type_designation AS type_name FROM thing_dim", serving.thing_types)
_things(
    "thing_groups",
    "SELECT DISTINCT group_id, group_name FROM thing_dim ORDER BY group_id, group_name LIMIT 10",
    serving.thing_groups,
)
_things(
    "thing_count",
    "SELECT COUNT(thing_id) AS thing_count FROM thing_dim",
    serving.thing_count,
)
_things(
    "thing_count_for_group",
    "SELECT COUNT(thing_id) AS thing_count FROM thing_dim WHERE group_id = 3",
    lambda d: serving.thing_count(d, group_id=3),
)
_things(
    "things_page",
    """SELECT thing_designation AS name, thing_id, thing_plate AS plate FROM thing_dim
    ORDER BY thing_id LIMIT 15 OFFSET 10""",
    lambda d: serving.things_page(d, number=2),
)
_things(
    "things_brief",
    "SELECT thing_designation AS name, thing_id, thing_plate AS plate FROM thing_dim",
    serving.things_brief,
)


@query(
    "years_with_data",
    """SELECT DISTINCT v.thing_id, d.year FROM vehicle_daily v JOIN date_dim d ON v.date_id = d.date_id
    JOIN thing_dim t ON v.thing_id = t.thing_id""",
)
def _years(i: Inputs) -> DataFrame:
    return serving.years_with_data(
        warehouse.vehicle_daily(i), warehouse.date_dim(i), warehouse.thing_dim(i)
    )


@query(
    "alerts_by_type",
    """SELECT type_id, COUNT(alert_count) AS alert_count FROM (
    SELECT alert_degre_id AS type_id, COUNT(*) AS alert_count FROM alert_counted
    GROUP BY thing_id, alert_degre_id, event_id, point_id) f
    JOIN alert_degre d ON f.type_id = d.alert_degre_id GROUP BY type_id""",
)
def _alerts_by_type(i: Inputs) -> DataFrame:
    fact = alert_fact(i.alert, i.alert_thing, i.alert_event, i.alert_point, i.point, i.alert_degre)
    return serving.alerts_by_type(fact, alert_degree_dim(i.alert_degre))


@query(
    "fuel_total",
    "SELECT CAST(floor(SUM(fuel)) AS BIGINT) AS fuel_consumption FROM vehicle_fuel",
)
def _fuel_total(i: Inputs) -> DataFrame:
    return serving.fuel_total(kpi_queries.vehicle_fact(i), warehouse.thing_dim(i))


def _fuel_total_for(kind: str, value: int) -> None:
    register(
        f"fuel_total_for_{kind}",
        lambda i: serving.fuel_total(
            kpi_queries.vehicle_fact(i), warehouse.thing_dim(i), **{f"{kind}_id": value}
        ),
        f"""SELECT CAST(floor(SUM(fuel)) AS BIGINT) AS fuel_consumption FROM vehicle_fuel v
        JOIN thing_dim t ON v.thing_id = t.thing_id WHERE t.{kind}_id = {value}""",
    )


for _kind, _value in (("thing", 7), ("group", 3), ("type", 2)):
    _fuel_total_for(_kind, _value)


def page_sql(first: int, condition: str = "", also: str = "") -> str:
    return f"""SELECT {also}f.thing_id, {r6('f.active_time', 'active_time')},
    {r6('f.avg_speed', 'avg_speed')}, f.max_speed, start_point, end_point, start_time, end_time, part, path
    FROM jfact f JOIN jdim m ON f.journey_id = m.journey_id WHERE f.journey_id IN (
    SELECT f.journey_id FROM jfact f JOIN thing_dim t ON f.thing_id = t.thing_id
    JOIN jclosed c ON f.journey_id = c.journey_id{condition}
    ORDER BY c.trace_date DESC, f.journey_id LIMIT 5 OFFSET {first})"""


def journey_tables(i: Inputs) -> list[DataFrame]:
    """Fact and dimensions as the pages of journeys take them."""
    run = run_of(i, keep_rows=True)
    return [run.fact(), run.dim(i.gazetteer, DECIMALS), warehouse.thing_dim(i), warehouse.date_dim(i)]


def _journey_page(name: str, condition: str = "", **choice: int) -> None:
    register(
        name,
        lambda i: rounded(serving.journeys_page(*journey_tables(i), **choice), "active_time", "avg_speed"),
        page_sql(0, condition),
    )


_journey_page("journeys_page")
_journey_page("journeys_page_for_thing", " WHERE f.thing_id = 7", thing_id=7)
_journey_page("journeys_page_for_group", " WHERE t.group_id = 3", group_id=3)
_journey_page("journeys_page_for_type", " WHERE t.type_id = 2", type_id=2)


@query("journeys_after", page_sql(5, also="f.journey_id, "))
def _journeys_after(i: Inputs) -> DataFrame:
    """The second page, reached from the last journey of the first one."""
    fact, dim, *others = journey_tables(i)
    tables = [materialise(fact), materialise(dim), *others]
    first = serving.journeys_after(*tables).select("start_time", "journey_id").distinct()
    # Five rows at most.
    last = first.orderBy(F.col("start_time"), F.col("journey_id").desc()).first()
    return rounded(serving.journeys_after(*tables, after=last and tuple(last)), "active_time", "avg_speed")


def _journey_count(name: str, condition: str = "", **choice: int) -> None:
    def build(i: Inputs) -> DataFrame:
        run = run_of(i)
        return serving.journey_count(
            run.fact(), run.closed, warehouse.thing_dim(i), warehouse.date_dim(i), **choice
        )

    register(
        name,
        build,
        f"""SELECT d.year, COUNT(f.journey_id) AS journey_count FROM jfact f
        JOIN thing_dim t ON f.thing_id = t.thing_id JOIN date_dim d ON f.date_id = d.date_id{condition}
        GROUP BY d.year""",
    )


_journey_count("journey_count")
_journey_count("journey_count_for_thing", " WHERE f.thing_id = 7", thing_id=7)
_journey_count("journey_count_for_group", " WHERE t.group_id = 3", group_id=3)
_journey_count("journey_count_for_type", " WHERE t.type_id = 2", type_id=2)


# --- live state -----------------------------------------------------------------------------

LIVE_VEHICLE_SQL = """(SELECT s.*, thing_designation AS thing_name, t.type_id, t.group_id,
CASE WHEN battery < 13 THEN 1 ELSE 0 END AS maintenance,
CASE WHEN oil_value IS NOT NULL THEN fuel_liters / 3 END AS rul
FROM live_state s JOIN thing_dim t ON s.thing_id = t.thing_id) l"""


def live_state(i: Inputs) -> DataFrame:
    """Live state of all vehicles with their names, a service flag and a remaining life."""
    state = live.vehicle_state(i.trace_src, also=("oil_value", "fuel_liters", "battery"))
    names = warehouse.thing_dim(i).select(
        "thing_id", F.col("thing_designation").alias("thing_name"), "type_id", "group_id"
    )
    return state.join(names, "thing_id").withColumns(
        {
            "maintenance": F.when(F.col("battery") < 13, 1).otherwise(0),
            "rul": F.when(F.col("oil_value").isNotNull(), F.col("fuel_liters") / 3),
        }
    )


@query("active_count", "SELECT COUNT(thing_id) AS active_count FROM live_state")
def _active(i: Inputs) -> DataFrame:
    return serving.active_count(live.vehicle_state(i.trace_src))


@query(
    "live_latest",
    """SELECT thing_id, trace_date AS timestamp, engine_status AS status, fuel_liters, fuel_percent,
    latitude, longitude, speed, oil_value, battery FROM live_state""",
)
def _live_latest(i: Inputs) -> DataFrame:
    return serving.live_latest(i.trace_src)


@query(
    "live_position",
    "SELECT thing_id, trace_date AS timestamp, latitude, longitude, speed FROM live_state",
)
def _live_position(i: Inputs) -> DataFrame:
    return serving.live_position(i.trace_src)


LIVE_SQL = f"""latitude, longitude, thing_id, active_time, {r6('avg_speed', 'avg_speed')}, max_speed"""


@query("live_vehicles", f"SELECT {LIVE_SQL}, thing_name FROM {LIVE_VEHICLE_SQL}")
def _live_vehicles(i: Inputs) -> DataFrame:
    return rounded(serving.live_vehicles(live_state(i)), "avg_speed")


def _live_vehicles_for(kind: str, value: int) -> None:
    register(
        f"live_vehicles_for_{kind}",
        lambda i: rounded(serving.live_vehicles(live_state(i), **{f"{kind}_id": value}), "avg_speed"),
        f"SELECT {LIVE_SQL}, thing_name FROM {LIVE_VEHICLE_SQL} WHERE {kind}_id = {value}",
    )


for _kind, _value in (("thing", 7), ("group", 3), ("type", 2)):
    _live_vehicles_for(_kind, _value)


@query(
    "live_vehicle_rul",
    f"""SELECT {LIVE_SQL}, maintenance AS prediction, CAST(ceil(rul) AS BIGINT) AS rul
    FROM {LIVE_VEHICLE_SQL}""",
)
def _live_rul(i: Inputs) -> DataFrame:
    return rounded(serving.live_vehicle_rul(live_state(i)), "avg_speed")


def _history_query(sensor: str):
    oracle = f"""SELECT thing_id, {sensor}, trace_date, trace_id, strftime(trace_date, '%M:%S') AS label
    FROM (SELECT *, row_number() OVER (PARTITION BY thing_id ORDER BY trace_date DESC, trace_id DESC)
    AS rn FROM trace_src) WHERE rn <= 100"""
    return lambda i: serving.sensor_history(i.trace_src, sensor), oracle


for _name, _sensor in (("oil", "oil_value"), ("fuel", "fuel_liters"), ("battery", "battery")):
    register(f"sensor_history_{_name}", *_history_query(_sensor))


@query(
    "engine_on_points",
    "SELECT thing_id, trace_date, latitude, longitude FROM trace_src WHERE engine_status = 1",
)
def _engine_on(i: Inputs) -> DataFrame:
    return serving.engine_on_points(i.trace_src)


@query(
    "maintenance_open",
    """SELECT name, maintenance, maintenance_date, thing_id FROM maintenance
    WHERE maintenance <> 'done'""",
)
def _open(i: Inputs) -> DataFrame:
    return serving.maintenance_open(i.maintenance)


@query(
    "maintenance_mark_done",
    """SELECT id, thing_id, name, CASE WHEN thing_id = 5 THEN 'done' ELSE maintenance END AS maintenance,
    maintenance_date FROM maintenance""",
)
def _mark_done(i: Inputs) -> DataFrame:
    return serving.maintenance_mark_done(i.maintenance, 5)


@query(
    "maintenance_add",
    f"""SELECT id, thing_id, name, maintenance, maintenance_date FROM maintenance UNION ALL
    SELECT NULL, 5, 'car5', 'Soon', CAST('{AS_OF} 00:00:00' AS TIMESTAMP)""",
)
def _add(i: Inputs) -> DataFrame:
    return serving.maintenance_add(i.maintenance, 5, dt.datetime(AS_OF.year, AS_OF.month, AS_OF.day))
