"""Messages to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt"


def json_decode_flatten(messages: DataFrame, ddl: str) -> DataFrame:
    """Parse message text by schema and flatten it.

    Single-quoted text parses. A value that does not fit its type is NULL, the other
    fields stay. A message that does not parse at all gives NULL fields; its text is
    in ``_corrupt``, see :func:`good` and :func:`rejects`.
    """
    schema = T.StructType([*T.StructType.fromDDL(ddl).fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(
        F.col("value").cast("string"), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )
    return messages.select(parsed.alias("data")).select("data.*")


def _unreadable(rows: DataFrame) -> Column:
    fields = [F.col(c) for c in rows.columns if c != CORRUPT]
    return F.coalesce(*[f.cast("string") for f in fields]).isNull()


def good(rows: DataFrame) -> DataFrame:
    """Rows with at least one readable field."""
    return rows.filter(~_unreadable(rows)).drop(CORRUPT)


def rejects(rows: DataFrame) -> DataFrame:
    """The text of messages that do not parse."""
    return rows.filter(_unreadable(rows)).select(CORRUPT)


def raw_stream_landing(messages: DataFrame) -> DataFrame:
    """(id, text) of each message; the id is its place in the topic, so a replay gives
    the same ids. Sources without places get a hash of the text."""
    text = F.col("value").cast("string")
    if {"topic", "partition", "offset"} <= set(messages.columns):
        place = F.concat_ws("-", "topic", F.col("partition").cast("string"), F.col("offset").cast("string"))
    else:
        place = F.sha2(text, 256)
    return messages.select(place.alias("id"), text.alias("text"))


def with_event_time(rows: DataFrame, column: str) -> DataFrame:
    """Time text (with or without fraction) as a timestamp of whole seconds."""
    return rows.withColumn(
        column, F.date_trunc("second", F.col(column).try_cast("timestamp")).cast("timestamp")
    )
