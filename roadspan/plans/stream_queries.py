"""Queries over messages, and streaming jobs run to the end of their input."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadspan import schemas
from roadspan.operators import models
from roadspan.operators.scaling import materialise, shared_folder
from roadspan.plans.fixtures import AS_OF, VIEWS, Inputs
from roadspan.plans.oracle import r6
from roadspan.plans.registry import query, rounded
from roadspan.sources.tables import KeyedTable
from roadspan.streaming import jobs

MESSAGE_FIELDS = [
    "trace_id", "thing_id", "trace_date", "longitude", "latitude", "speed", "engine_status",
    "oil_value", "fuel_liters", "fuel_percent", "battery",
]


def position_messages(trace: DataFrame) -> DataFrame:
    """Trace rows as the single-quoted texts a producer sends."""
    stamped = trace.select(*MESSAGE_FIELDS).withColumn(
        "trace_date", F.date_format("trace_date", "yyyy-MM-dd HH:mm:ss.SSS")
    )
    return stamped.select(F.translate(F.to_json(F.struct(*MESSAGE_FIELDS)), '"', "'").alias("value"))


def alert_messages(alerts: DataFrame) -> DataFrame:
    fields = F.struct(
        F.col("alert_degre_id").alias("type_id"),
        F.col("thing_id").alias("user_id"),
        F.date_format("alert_time", "yyyy-MM-dd HH:mm:ss").alias("event_date"),
        "longitude",
        "latitude",
        "event_id",
    )
    return alerts.select(F.translate(F.to_json(fields), '"', "'").alias("value"))


def streamed_events(i: Inputs) -> DataFrame:
    """The events file, read as a stream."""
    return (
        i.spark.readStream.schema(i.events.schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(i.sf_dir)
    )


def streamed(i: Inputs, view: str) -> DataFrame:
    """A view over the events file, read as a stream."""
    return i.spark.sql(VIEWS[view], events=streamed_events(i))


def run_folder(i: Inputs, name: str) -> str:
    return f"{shared_folder(i.spark)}/{name}-{uuid.uuid4().hex}"


@query(
    "json_decode_flatten",
    """SELECT trace_id, thing_id, trace_date, longitude, latitude, speed, engine_status, oil_value,
    fuel_liters, fuel_percent, battery FROM trace_src""",
)
def _decode(i: Inputs) -> DataFrame:
    return jobs.positions(position_messages(i.trace_src)).drop("thing_name")


@query(
    "raw_stream_landing",
    "SELECT concat('iotevents-0-', CAST(event_id AS VARCHAR)) AS id, props AS text FROM events",
)
def _landing(i: Inputs) -> DataFrame:
    messages = streamed_events(i).select(
        F.lit("iotevents").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("props").alias("value"),
    )
    folder = run_folder(i, "landing")
    jobs.landing_job(messages, f"{folder}/texts", f"{folder}/checkpoint", every=None).awaitTermination()
    return i.spark.read.schema("id STRING, text STRING").parquet(f"{folder}/texts")


STATE_DOUBLES = ["avg_speed", "max_speed", "fuel", "traveled_distance", "km_after_last_maintenance"]


@query(
    "vehicle_state_stream",
    f"""SELECT thing_id, trace_date, latitude, longitude, CAST(idle_time AS DOUBLE) AS idle_time,
    CAST(active_time AS DOUBLE) AS active_time, {r6('avg_speed', 'avg_speed')},
    {r6('max_speed', 'max_speed')}, {r6('fuel', 'fuel')}, {r6('traveled_distance', 'traveled_distance')},
    {r6('traveled_distance', 'km_after_last_maintenance')}, CAST(trace_date AS DATE) AS full_date
    FROM live_state""",
)
def _state_stream(i: Inputs) -> DataFrame:
    folder = run_folder(i, "vehicle-state")
    table = KeyedTable(f"{folder}/table", ["thing_id"], ["trace_date"])
    messages = position_messages(streamed(i, "trace_src"))
    jobs.vehicle_state_job(messages, table, f"{folder}/checkpoint", every=None).awaitTermination()
    rows = table.read(i.spark, schemas.live_schema("vehicle_performance")).select(
        "thing_id", "trace_date", "latitude", "longitude", "idle_time", "active_time",
        *STATE_DOUBLES, "full_date",
    )
    return rounded(rows, *STATE_DOUBLES)


@query(
    "alert_stream",
    """SELECT type_id, event_id, user_id, COUNT(*) AS alert_number,
    CAST(MAX(alert_day) AS DATE) AS full_date FROM counted_alerts GROUP BY type_id, event_id, user_id""",
)
def _alert_stream(i: Inputs) -> DataFrame:
    folder = run_folder(i, "alerts")
    table = KeyedTable(f"{folder}/table", jobs.ALERT_KEYS, ["alert_number"])
    messages = alert_messages(streamed(i, "alert_src"))
    jobs.alert_job(messages, table, i.gazetteer, f"{folder}/checkpoint", every=None).awaitTermination()
    days = table.read(i.spark, schemas.live_schema("alert"))
    return days.groupBy("type_id", "event_id", "user_id").agg(
        F.sum("alert_number").alias("alert_number"), F.max("full_date").alias("full_date")
    )


def _live_table(i: Inputs, name: str, keys: list[str], order: list[str], run) -> KeyedTable:
    """A live table of the as-of day, written by its job once per session and data folder."""
    wanted = (i.spark.sparkContext.applicationId, i.sf_dir, name)
    if wanted not in LIVE_TABLES:
        folder = run_folder(i, name)
        table = KeyedTable(f"{folder}/table", keys, order)
        run(table, f"{folder}/checkpoint")
        LIVE_TABLES[wanted] = table
    return LIVE_TABLES[wanted]


LIVE_TABLES: dict[tuple, KeyedTable] = {}


def live_vehicle_days(i: Inputs) -> DataFrame:
    """The live rows (thing_id, full_date) that the state job keeps."""

    def run(table: KeyedTable, checkpoint: str) -> None:
        today = streamed(i, "trace_src").filter(F.col("trace_date_day") == F.lit(AS_OF))
        jobs.vehicle_state_job(position_messages(today), table, checkpoint, every=None).awaitTermination()

    table = _live_table(i, "vehicle-days", ["thing_id", "full_date"], ["trace_date"], run)
    return table.read(i.spark, schemas.live_schema("vehicle_performance"))


def live_alert_days(i: Inputs) -> DataFrame:
    """The live rows (type, event, user, full_date) that the alert job keeps."""

    def run(table: KeyedTable, checkpoint: str) -> None:
        today = streamed(i, "alert_src").filter(F.col("alert_day") == F.lit(AS_OF))
        jobs.alert_job(alert_messages(today), table, i.gazetteer, checkpoint, every=None).awaitTermination()

    table = _live_table(i, "alert-days", jobs.ALERT_KEYS, ["alert_number"], run)
    return table.read(i.spark, schemas.live_schema("alert"))


@query(
    "rul_score_stream",
    """SELECT thing_id, trace_date, CAST(trace_date AS DATE) AS full_date, true AS within_labels FROM live_state""",
)
def _score(i: Inputs) -> DataFrame:
    """The live row of each vehicle as the state job writes it, scored by a model fitted on all
    rows; a score lies between the least and the largest label, which a first reading has."""
    rows = materialise(models.rul_features(i.trace_src))
    model = models.rul_train(rows)
    folder = run_folder(i, "scored-state")
    table = KeyedTable(f"{folder}/table", ["thing_id"], ["trace_date"])
    messages = position_messages(streamed(i, "trace_src"))
    jobs.vehicle_state_job(messages, table, f"{folder}/checkpoint", model, every=None).awaitTermination()
    most = rows.agg(F.max("label").alias("most"))
    live_rows = table.read(i.spark, schemas.live_schema("vehicle_performance"))
    return live_rows.join(F.broadcast(most)).select(
        "thing_id", "trace_date", "full_date", F.col("rul").between(F.lit(0), F.col("most")).alias("within_labels")
    )
