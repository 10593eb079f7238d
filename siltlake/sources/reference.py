"""Reference tables that streams and batches are joined with."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def reference_table(
    spark: SparkSession, path: str, key: str, columns: Sequence[str], file_format: str = "parquet"
) -> DataFrame:
    """The key and the given columns of a stored dimension.

    It is not cached: a stream re-plans the join for every batch, sees the
    files that are there then, and reads only these columns. Spark broadcasts
    it while the files stay below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    return spark.read.format(file_format).load(path).select(key, *columns)
