"""Writing the bronze and silver layers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltlake.operators.merge import LATE_WINS, SOFT, prepare_changes
from siltlake.spec import ARRIVAL, BATCH, DAY, POSITION, STREAM, TableSpec


def append_bronze(table, changes: DataFrame, stream: str | None = None, batch: int | None = None) -> int:
    """Add changes to the history, partitioned by day of arrival; returns how many.

    The rows are written as they come, without a shuffle: a batch arrives on
    one day, so each task writes one file.
    """
    day = F.date_format(F.col(ARRIVAL), "yyyy-MM-dd").alias(DAY)
    return table.append(changes.select("*", day), stream, batch)


def upsert_silver(
    table,
    changes: DataFrame,
    spec: TableSpec,
    run_ts: Column,
    delete_mode: str = SOFT,
    late_delete: str = LATE_WINS,
    stream: str | None = None,
    batch: int | None = None,
) -> None:
    """Merge changes, any number per key, into the stored silver table."""
    if stream is not None and table.marks().get(stream, -1) >= batch:
        return
    marks = None if stream is None else {stream: batch}
    table.merge(prepare_changes(changes, spec, run_ts), spec, delete_mode, late_delete, marks)


def merge_new_bronze(
    bronze,
    silver,
    spec: TableSpec,
    run_ts: Column,
    delete_mode: str = SOFT,
    late_delete: str = LATE_WINS,
    cut: int | None = None,
) -> bool:
    """Merge all bronze rows that silver has not seen, as one batch; whether
    there were any.

    Bronze takes every small batch at the cost of its own rows, silver is
    rewritten once for many of them. With ``cut`` rows from that position on are
    held back until a later cut, or a merge without one, lets them pass; rows
    without a position are not held back.
    """
    seen, newest = silver.marks(), bronze.marks()
    held = silver.held()
    new = any(seen.get(stream, -1) < last for stream, last in newest.items())
    if cut is None and not held.get("pending"):
        if not new:
            return False
        changes = bronze.read_since(seen, newest)
        silver.merge(prepare_changes(changes, spec, run_ts), spec, delete_mode, late_delete, newest)
        return True
    before = held.get("cut")
    if cut is not None and before is not None:
        cut = max(cut, before)
    if not new and cut == before and cut is not None:
        return False
    changes, waiting = _up_to(bronze, seen, newest, held, cut)
    pending = {stream: first for stream, first in waiting.groupBy(STREAM).agg(F.min(BATCH)).collect()}
    prepared = prepare_changes(changes.drop(STREAM, BATCH), spec, run_ts)
    silver.merge(prepared, spec, delete_mode, late_delete, newest, {"cut": cut, "pending": pending})
    return True


def _up_to(
    bronze, seen: Mapping[str, int], newest: Mapping[str, int], held: dict, cut: int | None
) -> tuple[DataFrame, DataFrame]:
    """The rows that a cut lets pass, and those that it holds back, of new batches
    and of those from the first one on that has rows held back."""
    rows, before = bronze.tagged(), held.get("cut")
    waits = F.lit(False) if cut is None else F.coalesce(F.col(POSITION) >= cut, F.lit(False))
    wanted, again = F.lit(False), F.lit(False)
    for stream, last in newest.items():
        own = (F.col(STREAM) == stream) & (F.col(BATCH) <= last)
        done = seen.get(stream, -1)
        wanted = wanted | (own & (F.col(BATCH) > done))
        if stream in held.get("pending", {}):
            again = again | (own & (F.col(BATCH) >= held["pending"][stream]) & (F.col(BATCH) <= done))
    late = again & F.coalesce(F.col(POSITION) >= (before if before is not None else 0), F.lit(False)) if held.get("pending") else again
    open_rows = rows.filter(wanted | late)
    return open_rows.filter(~waits), open_rows.filter(waits)


def evolve_silver(bronze, silver, spec: TableSpec, run_ts: Column) -> None:
    """Give silver the columns its specification has now, filled from the whole
    history up to what silver has merged, as one batch. Changes that were held
    back stay so."""
    held = silver.held()
    marks = silver.marks()
    changes = bronze.read_since({}, marks)
    if held.get("cut") is not None:
        changes = changes.filter(F.coalesce(F.col(POSITION) < held["cut"], F.lit(True)))
    silver.rebuild(prepare_changes(changes, spec, run_ts), marks, spec.buckets)


def state_at(bronze, spec: TableSpec, marks: Mapping[str, int], run_ts: Column) -> DataFrame:
    """Silver rows as they follow from the history up to the given batches."""
    return prepare_changes(bronze.read_since({}, marks), spec, run_ts)


def export_days(bronze, path: str) -> None:
    """The whole history once more, each day in files of a usual size, for
    readers that many small batches would slow down."""
    bronze.read().hint("rebalance", DAY).write.mode("overwrite").partitionBy(DAY).parquet(path)
