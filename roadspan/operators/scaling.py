"""Size checks, reliable checkpoints and dense numbering that hold at cluster scale."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SMALL_ROWS = 200_000
BROADCAST_BYTES = 32 * 1024 * 1024
BROADCAST_ROWS = 500_000


def estimated_bytes(df: DataFrame) -> int:
    """Size estimate the optimizer holds for the frame; starts no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def shared_folder(spark: SparkSession) -> str:
    """The folder for checkpoints and stream state, named by ``spark.checkpoint.dir``."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if named:
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    return tempfile.mkdtemp(prefix="roadspan-")


def materialise(df: DataFrame) -> DataFrame:
    """Write the frame to the shared checkpoint folder and read it back from there."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint behind a size check; a larger frame is left to a shuffle join.

    When the optimizer's estimate already proves the size, no job runs.
    Otherwise the frame is written once to the checkpoint folder and counted.
    """
    if estimated_bytes(df) <= BROADCAST_BYTES:
        return F.broadcast(df)
    stored = materialise(df)
    return F.broadcast(stored) if stored.count() <= max_rows else stored


def dense_ids(
    df: DataFrame,
    id_col: str,
    order: list[Column],
    start: Column | int = 0,
    bounded: bool = False,
) -> DataFrame:
    """Number the rows 1, 2, 3 … in ``order``, continuing after ``start``.

    ``order`` must identify a row. A frame of proven small size (``bounded`` or by
    a count) is numbered by one window. A larger one is range-partitioned, sorted
    and written to the checkpoint folder with its position in the partition; the
    partition sizes then give each partition its offset, so no task sees the whole.
    """
    start = F.lit(start) if isinstance(start, int) else start
    if bounded or df.count() <= SMALL_ROWS:
        position = F.row_number().over(Window.orderBy(*order))
        return df.withColumn(id_col, (position + start).cast("long"))

    placed = materialise(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
    ).withColumns(
        {
            "_part": F.shiftright("_place", 33),
            "_index": F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)),
        }
    )
    # One row per partition: the window below spans a few thousand rows.
    sizes = placed.groupBy("_part").agg((F.max("_index") + 1).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    return (
        placed.join(broadcast_if_small(offsets), "_part")
        .withColumn(id_col, (F.col("_offset") + F.col("_index") + 1 + start).cast("long"))
        .drop("_part", "_offset", "_index", "_place", "_size")
    )
