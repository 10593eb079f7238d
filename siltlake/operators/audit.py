"""Audit queries over the change history."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltlake.spec import POSITION


def recent_rows(history: DataFrame, n: int = 20, by: str = "processed_at", tie: str | None = None) -> DataFrame:
    """The ``n`` last rows to arrive."""
    return history.orderBy(*_last_first(history, by, tie)).limit(n)


def recent_by_op(
    history: DataFrame, op: str, n: int = 10, columns: Sequence[str] | None = None, tie: str | None = None
) -> DataFrame:
    """The ``n`` last changes of one operation by source time."""
    rows = history.filter(F.col("op") == op).orderBy(*_last_first(history, "ts_ms", tie)).limit(n)
    return rows.select(*columns) if columns else rows


def recent_rows_bounded(history, n: int = 20, tie: str | None = None) -> DataFrame:
    """``recent_rows`` of a stored history that is partitioned by day of arrival:
    from the latest days that together have ``n`` rows. Older folders are not read."""
    rows, left = history.read(), n
    for day, (count, _) in sorted(((d, b) for d, b in history.bounds().items() if d is not None), reverse=True):
        left -= count
        if left <= 0:
            rows = rows.filter(F.col(history.partition_by) >= day)
            break
    return recent_rows(rows, n, tie=tie)


def recent_by_op_bounded(
    history, op: str, n: int = 10, columns: Sequence[str] | None = None, tie: str | None = None
) -> DataFrame:
    """``recent_by_op`` of a stored history: days are read in the order of their
    latest source time, twice as many each time, until the last row found is later
    than all that is unread."""
    unknown = float("-inf")
    days = sorted(history.bounds().items(), key=lambda x: unknown if x[1][1] is None else x[1][1], reverse=True)
    rows, take = history.read(), 1
    while take < len(days):
        chosen = [day for day, _ in days[:take]]
        among = F.col(history.partition_by).isin([day for day in chosen if day is not None])
        part = rows.filter(among | F.col(history.partition_by).isNull() if None in chosen else among)
        found = recent_by_op(part, op, n, tie=tie)
        count, least = found.agg(F.count(F.lit(1)), F.min("ts_ms")).first()
        bound = days[take][1][1]
        if count == n and least is not None and (bound is None or least > bound):
            return found.select(*columns) if columns else found
        take *= 2
    return recent_by_op(rows, op, n, columns, tie)


def _last_first(history: DataFrame, by: str, tie: str | None) -> list[Column]:
    """Rows of one batch share their arrival and ids repeat in a history, so
    ties are broken by position, source time and id, unless one is named."""
    ties = [tie] if tie else [name for name in (POSITION, "ts_ms", "id") if name in history.columns]
    return [F.desc(name) for name in dict.fromkeys([by, *ties])]


def op_counts(history: DataFrame) -> DataFrame:
    return history.groupBy("op").agg(F.count(F.lit(1)).alias("cnt")).orderBy(F.desc("cnt"), "op")


def table_event_audit(histories: dict[str, DataFrame]) -> DataFrame:
    """Events, inserts, updates and deletes, one row per table.

    Each history is reduced to one row by its own map tasks before the union,
    so only a row per task is shuffled; an empty table still gets its row.
    """
    parts = [
        history.agg(
            F.count(F.lit(1)).alias("total_events"),
            _ops("c").alias("inserts"),
            _ops("u").alias("updates"),
            _ops("d").alias("deletes"),
        ).select(F.lit(name).alias("table_name"), "*")
        for name, history in histories.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _ops(code: str) -> Column:
    return F.count_if(F.col("op") == code)


def layer_counts(layers: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """Rows of each (table, layer); silver tables also give their active rows."""
    parts = []
    for (table, layer), df in layers.items():
        active = F.count_if(F.col("is_active")) if layer == "silver" else F.lit(None).cast("bigint")
        parts.append(
            df.agg(F.count(F.lit(1)).alias("row_count"), active.alias("active_rows")).select(
                F.lit(table).alias("table_name"), F.lit(layer).alias("layer"), "row_count", "active_rows"
            )
        )
    return reduce(DataFrame.unionByName, parts)


def windowed_op_counts(
    events: DataFrame, time: str, duration: str, slide: str | None = None, watermark: str | None = None
) -> DataFrame:
    """Events per operation in tumbling or sliding windows of event time.

    On a stream ``watermark`` bounds the state and closes windows.
    """
    if watermark:
        events = events.withWatermark(time, watermark)
    window = F.window(time, duration, slide) if slide else F.window(time, duration)
    return (
        events.groupBy(window.alias("w"), "op")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "op", "cnt")
    )
