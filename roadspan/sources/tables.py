"""Parquet tables: reads, replacement, appends and a keyed table."""

from __future__ import annotations

import time
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadspan.operators.loading import conform_to_schema, latest_by_key


def static_table_read(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """A table as it is now; read it again to see later writes."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def table_replace(
    df: DataFrame, path: str, schema: T.StructType | None = None, partition_by: tuple[str, ...] = ()
) -> None:
    """Drop and refill a table from a frame that does not read the table itself.

    With partition columns only the partitions present in the frame are replaced, so
    the load of one day can be repeated.
    """
    rows = df if schema is None else conform_to_schema(df, schema)
    writer = rows.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def table_append(df: DataFrame, path: str, schema: T.StructType | None = None) -> None:
    rows = df if schema is None else conform_to_schema(df, schema)
    rows.write.mode("append").parquet(path)


def insert_rows(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType, path: str) -> None:
    """Append literal rows."""
    table_append(spark.createDataFrame(list(rows), schema), path)


class KeyedTable:
    """A table whose append is an upsert by key, for numbered batches 0, 1, 2, …

    Batch N writes only its own newest row per key, into ``changes/batch_id=N``, so a write
    costs the size of the batch; every ``full_every`` batches the newest rows over all batches
    go to ``full/batch_id=N``. The empty file ``commits/N`` is made last, in one step: from then
    on version N is the table, which is the newest full folder up to N and the changes after it.

    Committed folders are not written again. A reader thus sees one version, also while a batch
    or a full folder is being written, and a batch that is committed already changes nothing
    when it comes again. With each full folder, versions that stopped being the newest one more
    than ``keep_hours`` ago are removed; the version before the newest always stays, as a batch
    that runs again starts from it.
    """

    def __init__(self, path: str, keys: list[str], order: list[str], full_every: int = 100, keep_hours: float = 1.0):
        self.path, self.keys, self.order = path, keys, order
        self.full_every, self.keep_hours = full_every, keep_hours

    def upsert(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        files, commit = self._files(spark, f"commits/{batch_id}")
        if files.exists(commit):
            return
        newest = latest_by_key(batch, self.keys, self.order)
        newest.write.mode("overwrite").parquet(f"{self.path}/changes/batch_id={batch_id}")
        if batch_id % self.full_every == 0:
            changed = self.changes(spark, batch.schema, batch_id)
            before = self._before(spark, batch.schema, batch_id)
            rows = before.unionByName(changed.withColumn("batch_id", F.lit(batch_id).cast("long")))
            self._newest(rows).write.mode("overwrite").parquet(f"{self.path}/full/batch_id={batch_id}")
        files.createNewFile(commit)
        if batch_id % self.full_every == 0:
            self._remove_old(spark, batch_id)

    def changes(self, spark: SparkSession, schema: T.StructType, batch_id: int) -> DataFrame:
        """The rows that one batch has written."""
        return spark.read.schema(schema).parquet(f"{self.path}/changes/batch_id={batch_id}")

    def version(self, spark: SparkSession) -> int | None:
        """The newest committed batch; None while there is none."""
        return max(self._listed(spark, "commits"), default=None)

    def read(
        self, spark: SparkSession, schema: T.StructType, before: int | None = None, only: DataFrame | None = None
    ) -> DataFrame:
        """Newest rows of the newest version; with ``before`` only of the batches below that
        number, with ``only`` just those whose keys are in that frame."""
        if before is None:
            newest = self.version(spark)
            before = 0 if newest is None else newest + 1
        rows = self._before(spark, schema, before)
        return self._newest(rows if only is None else rows.join(only, self.keys, "left_semi"))

    def _newest(self, rows: DataFrame) -> DataFrame:
        return latest_by_key(rows, self.keys, [*self.order, "batch_id"]).drop("batch_id")

    def _stored(self, spark, schema: T.StructType, kind: str, paths: list[str]) -> DataFrame:
        stored = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
        return spark.read.schema(stored).option("basePath", f"{self.path}/{kind}").parquet(*paths)

    def _before(self, spark, schema: T.StructType, batch_id: int) -> DataFrame:
        if batch_id == 0:
            stored = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
            return spark.createDataFrame([], stored)
        full = (batch_id - 1) // self.full_every * self.full_every
        rows = self._stored(spark, schema, "full", [f"{self.path}/full/batch_id={full}"])
        later = [f"{self.path}/changes/batch_id={n}" for n in range(full + 1, batch_id)]
        if later:
            rows = rows.unionByName(self._stored(spark, schema, "changes", later))
        return rows

    def _files(self, spark: SparkSession, name: str):
        """The file system of the table and a path in it."""
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path.getFileSystem(spark._jsc.hadoopConfiguration()), path

    def _listed(self, spark: SparkSession, kind: str) -> dict[int, int]:
        """Batch numbers under a folder, each with its time in milliseconds."""
        files, folder = self._files(spark, kind)
        if not files.exists(folder):
            return {}
        found = {}
        for status in files.listStatus(folder):
            number = status.getPath().getName().removeprefix("batch_id=")
            if number.isdigit():
                found[int(number)] = status.getModificationTime()
        return found

    def _remove_old(self, spark: SparkSession, batch_id: int) -> None:
        commits = self._listed(spark, "commits")
        limit = (time.time() - self.keep_hours * 3600) * 1000
        # The version that was the newest one at the limit may still be read.
        current = max((n for n, made in commits.items() if made <= limit), default=min(commits))
        oldest = min(current, batch_id - 1)
        full = oldest // self.full_every * self.full_every
        # Markers go first, so that none names a folder that is gone.
        for kind, first in (("commits", oldest), ("changes", full), ("full", full)):
            for n in self._listed(spark, kind):
                if n < first:
                    files, path = self._files(spark, f"{kind}/{n}" if kind == "commits" else f"{kind}/batch_id={n}")
                    files.delete(path, True)
