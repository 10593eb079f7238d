"""Database snapshots as an input for snapshot comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_snapshot(
    spark: SparkSession,
    url: str,
    table: str,
    key: str,
    lower: int,
    upper: int,
    partitions: int,
    **options: str,
) -> DataFrame:
    """Read a table in parallel key ranges; rows outside the bounds are still
    read, by the first and the last range."""
    return (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("partitionColumn", key)
        .option("lowerBound", lower)
        .option("upperBound", upper)
        .option("numPartitions", partitions)
        .options(**options)
        .load()
    )
