"""Left join of events with the version of a reference that held at their time.

Events and versions of a key are sorted together by time, and a scan carries the
last version forward: no event meets more than one version, however many there are.

A key with very many rows is split by time. Borders are cut through the rows of hot
keys, so that a part holds a bounded number of them; the last version of each part
is found by aggregation and carried into the parts that follow, one row for each key
and part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltlake.spec import POSITION

# Rows of one key that a task sorts, and borders at most (beyond, parts grow).
HOT_ROWS, MOST_BORDERS = 1_000_000, 1023


def enrich_as_of(
    events: DataFrame,
    history: DataFrame,
    on: Column,
    at: Column,
    columns: Sequence[str],
    prefix: str,
    reference_key: str = "id",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``events`` with ``columns`` of the last change of ``history`` (in bronze
    form) whose ``ts_ms`` is not after ``at``; NULL without one, and where that
    change is a delete. Of changes of one instant the last position counts, a
    delete after others. Events without a key or time find nothing; changes
    without them are left out.
    """
    order = [F.col(POSITION)] if POSITION in history.columns else []
    version = F.struct(*order, F.col("op").eqNullSafe(F.lit("d")).alias("gone"), *[F.col(c).alias(f"v_{c}") for c in columns])
    versions = (
        history.filter(F.col(reference_key).isNotNull() & F.col("ts_ms").isNotNull())
        .groupBy(F.col(reference_key).alias("_key"), F.col("ts_ms").alias("_at"))
        .agg(F.max(version).alias("_version"))
    )
    asked = events.select(F.struct(*[F.col(f"`{c}`") for c in events.columns]).alias("_row"), on.alias("_key"), at.cast("bigint").alias("_at"))
    known = F.col("_key").isNotNull() & F.col("_at").isNotNull()
    timed, loose = asked.filter(known), asked.filter(~known)

    cuts = borders(timed.select("_key", "_at").unionAll(versions.select("_key", "_at")), hot_rows)
    part = _part(F.col("_at"), cuts)
    nothing = F.lit(None).cast(versions.schema["_version"].dataType)
    left = versions.select("_key", part.alias("_part"), "_at", F.lit(0).alias("_kind"), "_version", F.lit(None).cast(asked.schema["_row"].dataType).alias("_row"))
    right = timed.select("_key", part.alias("_part"), "_at", F.lit(1).alias("_kind"), nothing.alias("_version"), "_row")
    rows = left.unionAll(right)
    if cuts:
        rows = rows.unionAll(_carried(rows))
    scan = Window.partitionBy("_key", "_part").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    found = rows.withColumn("_found", F.last("_version", ignorenulls=True).over(scan)).filter("_kind = 1")
    value = lambda c: F.when(~F.col("_found.gone"), F.col(f"_found.v_{c}")).alias(f"{prefix}{c}")
    joined = found.select("_row.*", *[value(c) for c in columns])
    kinds = dict(zip(joined.columns, joined.schema.fields))
    empty = [F.lit(None).cast(kinds[f"{prefix}{c}"].dataType).alias(f"{prefix}{c}") for c in columns]
    return joined.unionAll(loose.select("_row.*", *empty))


def borders(rows: DataFrame, hot_rows: int) -> list[int]:
    """Times that cut the rows of hot keys into parts of about ``hot_rows``; none
    if there are no hot keys. The driver gets the borders and two numbers."""
    hot = rows.groupBy("_key").agg(F.count(F.lit(1)).alias("n"), F.min("_at").alias("a"), F.max("_at").alias("b")).filter(F.col("n") > hot_rows)
    n, first, last = hot.agg(F.sum("n"), F.min("a"), F.max("b")).first()
    if not n or first == last:
        return []
    parts = min(MOST_BORDERS + 1, -(-n // hot_rows))
    shares = [k / parts for k in range(1, parts)]
    keys = hot.select("_key")
    found = rows.join(keys, "_key", "left_semi").agg(F.percentile_approx("_at", shares, 10_000)).first()[0]
    return sorted({t for t in found if t > first})


def _part(at: Column, cuts: list[int]) -> Column:
    """How many of the sorted ``cuts`` are not after ``at``, by halving."""

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(at < cuts[middle], search(low, middle)).otherwise(search(middle + 1, high))

    return search(0, len(cuts))


def _carried(rows: DataFrame) -> DataFrame:
    """For each key and part the last version of the parts before."""
    last = F.max(F.when(F.col("_version").isNotNull(), F.struct("_at", "_version")))
    per_part = rows.groupBy("_key", "_part").agg(last.alias("_last"))
    before = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_part.withColumn("_carry", F.last("_last", ignorenulls=True).over(before)).filter("_carry IS NOT NULL")
    return carried.select(
        "_key", "_part", F.col("_carry._at").alias("_at"), F.lit(0).alias("_kind"), F.col("_carry._version").alias("_version"),
        F.lit(None).cast(rows.schema["_row"].dataType).alias("_row"),
    )
