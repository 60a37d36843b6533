"""The streaming jobs: positions, vehicle state, alerts, raw texts, and messages that do not parse.

Each takes a stream of messages from any source, a folder for its checkpoint (which
is mandatory, so that a restart loses nothing) and the table it maintains. Sinks are
repeatable: a batch that runs again replaces what it wrote, or changes nothing once a keyed
table has committed it.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from roadspan import schemas
from roadspan.functions.scalars import with_date_attributes
from roadspan.operators import live, models
from roadspan.operators.loading import conform_to_schema
from roadspan.operators.places import place_lookup
from roadspan.operators.scaling import broadcast_if_small
from roadspan.sources.tables import KeyedTable
from roadspan.streaming import decode
from roadspan.streaming.state import fold_events, state_ddl, window_features

# Processing-time triggers.
POSITION_TRIGGER = "10 seconds"
STATE_TRIGGER = "10 seconds"
ALERT_TRIGGER = "2 seconds"
# How far an alert may lag behind the newest one.
ALERT_LATENESS = "1 day"
ALERT_KEYS = ["type_id", "event_id", "user_id", "full_date"]

LAST_SPEED_SCHEMA = "thing_id INT, last_speed INT, trace_date TIMESTAMP, trace_id STRING"


def positions(messages: DataFrame) -> DataFrame:
    """Decoded position events with event time in whole seconds."""
    rows = decode.good(decode.json_decode_flatten(messages, schemas.POSITION_MESSAGE))
    return decode.with_event_time(rows, "trace_date")


def _trigger(every: str | None) -> dict:
    """Without ``every``, take what is there and stop."""
    return {"availableNow": True} if every is None else {"processingTime": every}


def _start(stream: DataFrame, sink, checkpoint: str, mode: str, every: str | None) -> StreamingQuery:
    """Run ``sink`` per micro-batch."""
    return (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(every))
        .foreachBatch(sink)
        .start()
    )


def trace_ingest_job(
    messages: DataFrame,
    trace_path: str,
    speeds: KeyedTable,
    checkpoint: str,
    every: str | None = POSITION_TRIGGER,
) -> StreamingQuery:
    """Store positions; an impossible speed becomes the vehicle's last stored one.

    The last speeds are kept as a table of their own with one row per vehicle, so a
    batch does not read the stored trace.
    """
    stored = StructType.fromDDL(LAST_SPEED_SCHEMA)

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        known = speeds.read(spark, stored, before=batch_id).select("thing_id", "last_speed")
        usable = batch.join(known, "thing_id", "left").withColumn(
            "speed",
            F.when(F.col("speed") > live.SPEED_LIMIT, F.col("last_speed")).otherwise(F.col("speed")),
        )
        ingested = live.trace_ingest(usable.drop("last_speed"))
        conform_to_schema(ingested, schemas.live_schema("trace")).write.mode("overwrite").parquet(
            f"{trace_path}/batch_id={batch_id}"
        )
        speeds.upsert(
            usable.select(
                "thing_id", F.col("speed").alias("last_speed"), "trace_date", "trace_id"
            ).filter("thing_id IS NOT NULL"),
            batch_id,
        )
        batch.unpersist()

    return _start(positions(messages), sink, checkpoint, "append", every)


def vehicle_state_job(
    messages: DataFrame,
    table: KeyedTable,
    checkpoint: str,
    model: PipelineModel | None = None,
    every: str | None = STATE_TRIGGER,
) -> StreamingQuery:
    """Maintain one live row per key of the table, (thing_id) or (thing_id, full_date).

    The fold is resumed from the states of the batches before, which are a keyed table of their
    own beside the live one; a batch that runs again starts from the same states. With a fitted model, rows get a predicted remaining life; the model is held
    by the job, not loaded per row.
    """
    schema, keys = schemas.live_schema("vehicle_performance"), table.keys
    kept = StructType.fromDDL(state_ddl(keys))
    states = KeyedTable(f"{table.path}/state", keys, ["trace_date"], table.full_every)

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        events = batch.filter("thing_id is not null and trace_date is not null")
        events = events.withColumn("full_date", F.to_date("trace_date")).persist()
        touched = broadcast_if_small(events.select(*keys).distinct())
        known = states.read(spark, kept, before=batch_id, only=touched)
        states.upsert(conform_to_schema(fold_events(events, known, keys), kept), batch_id)
        events.unpersist()
        rows = live.constant_features(window_features(states.changes(spark, kept, batch_id)))
        rows = rows.withColumn("km_after_last_maintenance", F.col("traveled_distance"))
        if model is not None:
            filled = rows.fillna(0.0, subset=[c for c in models.RUL_FEATURES if c != "thing_id"])
            rows = models.rul_score(model, filled)
        rows = with_date_attributes(rows, F.to_date("trace_date"), quarter_as_text=False)
        table.upsert(conform_to_schema(rows, schema), batch_id)

    return _start(positions(messages), sink, checkpoint, "append", every)


def alert_job(
    messages: DataFrame,
    table: KeyedTable,
    gazetteer: DataFrame,
    checkpoint: str,
    every: str | None = ALERT_TRIGGER,
    late: str = ALERT_LATENESS,
) -> StreamingQuery:
    """Count alerts per (type, event, user) and day, and keep the newest one's place.

    The count is a built-in streaming aggregate: it combines before the shuffle, so a key with
    very many alerts is no heavier than another. A day's counts leave the state once the event
    time has passed its end by ``late``; alerts of such a day that come later still are left
    out. The live table keeps what was counted; its key is (type, event, user, full_date).
    """
    schema = schemas.live_schema("alert")
    rows = decode.good(decode.json_decode_flatten(messages, schemas.ALERT_MESSAGE))
    rows = decode.with_event_time(rows, "event_date").withWatermark("event_date", late)
    newest = F.max_by(F.struct("latitude", "longitude"), F.col("event_date"))
    counted = rows.groupBy("type_id", "event_id", "user_id", F.window("event_date", "1 day")).agg(
        F.count("*").alias("alert_number"),
        F.max("event_date").alias("_newest"),
        newest.alias("_place"),
    )

    def sink(batch: DataFrame, batch_id: int) -> None:
        placed = place_lookup(batch.select("*", "_place.*").drop("_place", "window"), gazetteer)
        dated = with_date_attributes(placed, F.to_date("_newest"), quarter_as_text=False)
        named = dated.withColumnsRenamed({"town": "municipality", "state": "province"})
        table.upsert(conform_to_schema(named, schema), batch_id)

    return _start(counted, sink, checkpoint, "update", every)


def landing_job(
    messages: DataFrame, path: str, checkpoint: str, every: str | None = POSITION_TRIGGER
) -> StreamingQuery:
    """Keep each message as (id, text) in Parquet files. A batch's files count once they are all
    written, so a restart neither loses nor doubles a message."""
    return (
        decode.raw_stream_landing(messages)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(every))
        .start()
    )


def rejects_job(
    messages: DataFrame,
    ddl: str,
    path: str,
    checkpoint: str,
    every: str | None = POSITION_TRIGGER,
) -> StreamingQuery:
    """Keep the text of messages that do not parse by ``ddl``, one folder per batch.

    The other jobs leave these messages out; this one reads the same source beside
    them with a checkpoint of its own. Batches without rejects write no folder.
    """
    rows = decode.rejects(decode.json_decode_flatten(messages, ddl)).withColumnRenamed(decode.CORRUPT, "text")

    def sink(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return _start(rows, sink, checkpoint, "append", every)
