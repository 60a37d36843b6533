"""JDBC reads and writes. Address, driver and credentials always come from the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, SparkSession


def jdbc_read_query(
    spark: SparkSession,
    url: str,
    driver: str,
    query: str | None = None,
    dbtable: str | None = None,
    split_by: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
    **properties: str,
) -> DataFrame:
    """Read a query or a table.

    With ``split_by``, ``bounds`` and ``partitions`` the rows are read by that many
    tasks, each with its own range of the column; otherwise one task reads them all.
    """
    if (query is None) == (dbtable is None):
        raise ValueError("give either a query or a table")
    reader: DataFrameReader = (
        spark.read.format("jdbc")
        .option("url", url)
        .option("driver", driver)
        .option("fetchsize", fetch_size)
        .options(**properties)
    )
    if split_by is None:
        source = {"query": query} if query is not None else {"dbtable": dbtable}
        return reader.options(**source).load()
    if bounds is None:
        raise ValueError("a split read needs the bounds of its column")
    # A split read takes a table expression, so a query is wrapped as a subquery.
    return (
        reader.option("dbtable", dbtable if query is None else f"({query}) AS q")
        .option("partitionColumn", split_by)
        .option("lowerBound", str(bounds[0]))
        .option("upperBound", str(bounds[1]))
        .option("numPartitions", partitions)
        .load()
    )


def jdbc_write_append(
    df: DataFrame,
    url: str,
    driver: str,
    table: str,
    partitions: int | None = None,
    batch_size: int = 10_000,
    **properties: str,
) -> None:
    """Append a frame to a table; ``partitions`` bounds the parallel connections."""
    writer = (
        df.write.format("jdbc")
        .mode("append")
        .option("url", url)
        .option("driver", driver)
        .option("dbtable", table)
        .option("batchsize", batch_size)
        .options(**properties)
    )
    if partitions is not None:
        writer = writer.option("numPartitions", partitions)
    writer.save()
