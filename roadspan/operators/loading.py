"""Incremental loading, schema conformance and keyed merges."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadspan.operators.scaling import dense_ids


def high_watermark(target: DataFrame, key: str, default: Any) -> DataFrame:
    """One row with the largest loaded key, or ``default`` while the target is empty."""
    kind = target.schema[key].dataType
    return target.agg(
        F.coalesce(F.max(key), F.lit(default).cast(kind)).alias("watermark")
    )


def read_watermark(target: DataFrame, key: str, default: Any) -> Any:
    """The watermark as a value, to be used as a literal that reaches the scan."""
    return high_watermark(target, key, default).first()["watermark"]


def incremental_filter(source: DataFrame, key: str, watermark: Any) -> DataFrame:
    """Rows with a key strictly above the watermark."""
    return source.filter(F.col(key) > F.lit(watermark))


def load_if_empty(source: DataFrame, target: DataFrame) -> DataFrame:
    """All source rows while the target has none, else no rows."""
    return source if target.isEmpty() else source.limit(0)


def surrogate_key(
    df: DataFrame,
    id_col: str,
    natural_key: list[str],
    current_max: Column | int = 0,
    bounded: bool = False,
) -> DataFrame:
    """Dense integer key in natural-key order, continuing after ``current_max``."""
    return dense_ids(df, id_col, [F.col(c) for c in natural_key], current_max, bounded)


def conform_to_schema(
    df: DataFrame, schema: T.StructType, renames: dict[str, str] | None = None
) -> DataFrame:
    """Rename, cast and project to a declared schema; absent columns become NULL."""
    if renames:
        df = df.withColumnsRenamed(renames)
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def latest_by_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The newest row of each key.

    An aggregate rather than a window: it keeps one row per key and map task
    before the shuffle, so a key with very many rows costs nothing extra.
    """
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(newest).select(*keys, "_row.*").select(*df.columns)


def upsert(old: DataFrame, new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Union of both, keeping for each key the row that is newest by ``order``."""
    return latest_by_key(old.unionByName(new, allowMissingColumns=True), keys, order)


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each key; Spark trims every map task to ``n`` per key first."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= n).drop("_rank")
