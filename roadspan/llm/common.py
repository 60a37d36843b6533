"""What the operators share: stored steps, size-checked joins, skew-safe joins on keys."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadspan.operators.scaling import shared_folder

# A side is broadcast only after a count has shown it to hold no more rows than this.
BROADCAST_ROWS = 200_000
# A key is hot when it holds more than this share of all rows; so there are at most 1,000.
HOT_SHARE = 1000


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder under the one named by ``spark.checkpoint.dir``."""
    return f"{shared_folder(spark)}/roadspan/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write the frame to the shared folder and read it back: lineage is cut there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Steps:
    """The stored steps of one operator, in one folder that goes when the result is stored."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder = spark, scratch_path(spark, name)

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def remove(self) -> None:
        remove_folder(self.spark, self.folder)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library has made."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def sized(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Broadcast a stored frame of narrow rows if its count allows, else leave it to a shuffle.

    ``rows`` is the count, or a number that it does not exceed, where that is known.
    """
    return F.broadcast(df) if (df.count() if rows is None else rows) <= BROADCAST_ROWS else df


def join_with_hot_keys(
    left: DataFrame, right: DataFrame, key: str, copies: str, total: int
) -> DataFrame:
    """Left join of ``left`` with ``right``, whose ``key`` is unique and never null.

    ``copies`` counts the rows of ``left`` with the key, ``total`` all of them. Hot keys
    are at most HOT_SHARE and go by broadcast; the others meet by shuffle, where no key
    holds more than a thousandth of the rows.
    """
    hot = F.col(copies) * HOT_SHARE > total
    marked = left.join(
        F.broadcast(right.filter(hot).withColumn("_hot", F.lit(True))), key, "left"
    )
    rest = marked.filter("_hot is null").select(*left.columns)
    return (
        marked.filter("_hot")
        .drop("_hot")
        .unionByName(rest.join(right.filter(~hot), key, "left"))
    )


def without(docs: DataFrame, id_col: str, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id is not among the stored ``ids`` (one column ``_id``)."""
    return docs.join(sized(ids), docs[id_col] == ids["_id"], "left_anti")


def crc_remainder(id_col: Column | str, parts: int) -> Column:
    """crc32 of the id written as text, modulo ``parts``."""
    id_col = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(id_col.cast("string").cast("binary")) % parts
