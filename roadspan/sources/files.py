"""CSV and JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REJECT = "_rejected_line"


def csv_read_inferred(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header and inferred types; costs one extra pass, prefer a schema."""
    return spark.read.csv(path, header=True, inferSchema=True)


def csv_load_reject_bad(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected lines) of a CSV with a header.

    A line with fewer or more fields than the schema, or with a value that does not
    parse, is rejected and kept as text. ``multi_line`` allows line breaks inside
    quotes, which makes each file one task; turn it off for large files without them.
    """
    lines = (
        spark.read.schema(T.StructType([*schema.fields, T.StructField(REJECT, T.StringType())]))
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", REJECT)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .csv(path)
    )
    good = lines.filter(F.col(REJECT).isNull()).drop(REJECT)
    return good, lines.filter(F.col(REJECT).isNotNull())


def wide_table_column_count(df: DataFrame) -> int:
    return len(df.columns)


GAZETTEER_RECORD = (
    "place_id BIGINT, osm_id BIGINT, lat STRING, lon STRING, class STRING, type STRING, "
    "place_rank INT, importance DOUBLE, addresstype STRING, name STRING, display_name STRING, "
    "boundingbox ARRAY<STRING>, geojson STRING"
)


def gazetteer_load(spark: SparkSession, path: str) -> DataFrame:
    """Place records with numeric position and box; the geometry stays JSON text.

    The box is given as south, north, west, east.
    """
    box = [F.get("boundingbox", k).cast("double") for k in range(4)]
    return (
        spark.read.schema(GAZETTEER_RECORD)
        .option("multiLine", True)
        .json(path)
        .withColumns(
            {
                "lat": F.col("lat").cast("double"),
                "lon": F.col("lon").cast("double"),
                **dict(zip(("south", "north", "west", "east"), box, strict=True)),
            }
        )
        .drop("boundingbox")
    )


def places_from_gazetteer(records: DataFrame) -> DataFrame:
    """Boxes as the place lookup takes them, with names from the display name's parts."""
    parts = F.split("display_name", r",\s*")
    return records.select(
        "south",
        "north",
        "west",
        "east",
        F.col("name").alias("town"),
        F.coalesce(F.get(parts, F.size(parts) - 2), F.col("name")).alias("state"),
        F.get(parts, F.size(parts) - 1).alias("country"),
    )
