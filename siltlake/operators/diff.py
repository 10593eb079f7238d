"""Change feed from two snapshots of a table.

``snapshot_diff`` joins all rows. Where little changes, ``write_snapshot`` stores a
snapshot by ranges of key hashes, with a digest of each range and of each group of
ranges; ``diff_stored`` compares digests from the top and reads, and joins, the rows
of those ranges only that differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Ranges of key hashes and groups of them; both numbers are fixed for a table.
RANGES, GROUPS = 4096, 64
RANGE = "_range"


def snapshot_diff(before: DataFrame, after: DataFrame, key: str, ts_ms: Column) -> DataFrame:
    """Rows that differ between two snapshots, as ``c``/``u``/``d`` changes.

    ``key`` must be unique in each snapshot. A delete carries the last known
    row. Columns only one snapshot has compare as NULL in the other.
    """
    names = [key] + list(dict.fromkeys(c for c in [*before.columns, *after.columns] if c != key))
    old = _row(before, key, names, "b")
    new = _row(after, key, names, "a")
    op = (
        F.when(F.col("b").isNull(), F.lit("c"))
        .when(F.col("a").isNull(), F.lit("d"))
        .when(~F.col("a").eqNullSafe(F.col("b")), F.lit("u"))
    )
    changed = old.join(new, key, "full_outer").withColumn("op", op).filter(F.col("op").isNotNull())
    image = F.coalesce(F.col("a"), F.col("b"))
    return changed.withColumn("_image", image).select(
        *[F.col(f"_image.{name}").alias(name) for name in names], "op", ts_ms.cast("bigint").alias("ts_ms")
    )


def _row(snapshot: DataFrame, key: str, names: list[str], alias: str) -> DataFrame:
    have = set(snapshot.columns)
    fields = [F.col(n) if n in have else F.lit(None).alias(n) for n in names]
    return snapshot.select(F.col(key), F.struct(*fields).alias(alias))


def range_of(key: str, ranges: int = RANGES) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(ranges)).cast("int")


def digests(rows: DataFrame, ranges: int = RANGES) -> DataFrame:
    """A digest of 192 bits for each range: the number of its rows, and the sum and
    the exclusive or of two row hashes, so that the order of rows does not matter.
    NULL is a value of its own. Combined on the map side: the shuffle has a row for
    each range and task."""
    values = [F.col(f"`{name}`") for name in sorted(rows.columns) if name != RANGE]
    marked = [x for value in values for x in (value, value.isNull())]
    return rows.groupBy(RANGE).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64(*marked).cast("decimal(38,0)")).alias("total"),
        F.bit_xor(F.xxhash64(F.lit("second"), *marked)).alias("mixed"),
    )


def write_snapshot(rows: DataFrame, path: str, key: str, ranges: int = RANGES) -> None:
    """Store a snapshot by range, and its digests."""
    ranged = rows.withColumn(RANGE, range_of(key, ranges))
    ranged.repartition(RANGE).write.partitionBy(RANGE).parquet(f"{path}/rows")
    stored = rows.sparkSession.read.schema(ranged.schema).parquet(f"{path}/rows")
    digests(stored, ranges).coalesce(1).write.parquet(f"{path}/digests")


def changed_ranges(spark: SparkSession, before: str, after: str, groups: int = GROUPS) -> list[int]:
    """The ranges in which two stored snapshots differ: those of groups whose
    digests differ are looked at one by one. The driver gets their numbers."""
    read = lambda path: spark.read.parquet(f"{path}/digests").withColumn("side", F.lit(path == after))
    both = read(before).unionByName(read(after))
    group = F.pmod(F.col(RANGE), F.lit(groups)).alias("group")
    # Sides with equal digests cancel out, in a group as in a range.
    sign = F.when(F.col("side"), 1).otherwise(-1)
    open_ = lambda df: df.agg(F.sum(sign * F.col("n")).alias("n"), F.sum(sign * F.col("total")).alias("total"), F.bit_xor("mixed").alias("mixed")).filter("n <> 0 OR total <> 0 OR mixed <> 0")
    differ = open_(both.groupBy(group)).select("group")
    inside = both.withColumn("group", group).join(differ, "group", "left_semi")
    return sorted(row[RANGE] for row in open_(inside.groupBy(RANGE)).select(RANGE).collect())


def diff_stored(spark: SparkSession, before: str, after: str, key: str, ts_ms: Column) -> DataFrame:
    """``snapshot_diff`` of two stored snapshots; folders of equal ranges are not read."""
    ranges = changed_ranges(spark, before, after)

    def rows(path: str) -> DataFrame:
        return spark.read.parquet(f"{path}/rows").filter(F.col(RANGE).isin(ranges)).drop(RANGE)

    return snapshot_diff(rows(before), rows(after), key, ts_ms)
