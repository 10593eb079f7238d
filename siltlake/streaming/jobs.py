"""Streaming jobs: change intake, routing, enrichment and window counts.

A batch that is delivered again after a failure replaces what it wrote to a
history, and is skipped by a state that has merged it. With ``dedup_delay``
records that a source sends again within that time are dropped at the intake.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from siltlake.operators.dedup import once
from siltlake.operators.enrich import enrich
from siltlake.operators.merge import LATE_WINS, SOFT
from siltlake.operators.route import as_messages, route
from siltlake.plans.lake import QUARANTINE_COLUMNS, Lake
from siltlake.plans.layers import append_bronze, upsert_silver
from siltlake.plans.seen import Seen, identity_of
from siltlake.session import scratch_path
from siltlake.sources.envelope import parse_envelopes, table_changes, unclaimed
from siltlake.sources.flat import normalise, stream_changes
from siltlake.spec import SPECS, TableSpec
from siltlake.tables.files import Files

Trigger = Mapping[str, object]
AVAILABLE_NOW: Trigger = {"availableNow": True}
# Files to a batch, so that a backlog does not become one batch.
MAX_FILES = 1000
# Staging folder of events that belong to no declared table.
UNCLAIMED = "_unclaimed"


def _now() -> Column:
    now = dt.datetime.now(dt.timezone.utc)
    return F.timestamp_micros(F.lit(int(now.timestamp() * 1_000_000)))


def ingest_files(
    lake: Lake,
    spec: TableSpec,
    path: str,
    checkpoint: str,
    delete_mode: str = SOFT,
    late_delete: str = LATE_WINS,
    trigger: Trigger = AVAILABLE_NOW,
    max_files_per_trigger: int | None = MAX_FILES,
    archive: str | None = None,
    dedup_delay: str | None = None,
    merge_each_batch: bool = True,
    dedup_any_age: bool = False,
) -> StreamingQuery:
    """Flat change files into bronze and silver, each file once.

    ``merge_each_batch=False`` leaves the merge to ``run_silver``, which rewrites
    silver once for all batches since the last time. With ``dedup_any_age`` records
    that bronze has already are dropped, however long ago they came.
    """
    identity = identity_of(spec, positions=True) if dedup_any_age else None
    raw = stream_changes(lake.spark, path, spec, max_files_per_trigger, archive)
    records = once(raw, raw.columns, dedup_delay)

    def take(batch: DataFrame, stream: str, number: int) -> None:
        changes = normalise(batch, spec, _now())
        apply_batch(lake, spec, changes, stream, number, delete_mode, late_delete, merge_each_batch, identity)

    return _each_batch(records, take, checkpoint, trigger, f"ingest_{spec.name}")


def ingest_bronze(
    lake: Lake,
    spec: TableSpec,
    path: str,
    checkpoint: str,
    trigger: Trigger = AVAILABLE_NOW,
    max_files_per_trigger: int | None = MAX_FILES,
    archive: str | None = None,
    dedup_delay: str | None = None,
    dedup_any_age: bool = False,
) -> StreamingQuery:
    """Flat change files into bronze only."""
    return ingest_files(
        lake, spec, path, checkpoint, trigger=trigger, max_files_per_trigger=max_files_per_trigger,
        archive=archive, dedup_delay=dedup_delay, merge_each_batch=False, dedup_any_age=dedup_any_age,
    )


def ingest_messages(
    lake: Lake,
    messages: DataFrame,
    checkpoint: str,
    specs: Iterable[TableSpec] = tuple(SPECS.values()),
    delete_mode: str = SOFT,
    late_delete: str = LATE_WINS,
    trigger: Trigger = AVAILABLE_NOW,
    dedup_delay: str | None = None,
    merge_each_batch: bool = True,
    dedup_any_age: bool = False,
) -> StreamingQuery:
    """Enveloped messages of several tables into their bronze and silver tables.

    A batch is parsed once, into the shared scratch folder with one folder per
    table; each table then reads its own and decodes its images. What no table
    takes goes to the quarantine table. With ``dedup_any_age`` changes that bronze has
    already, at whatever offset, are dropped, however long ago they came.
    """
    specs = list(specs)
    files = Files(lake.spark)

    def take(batch: DataFrame, stream: str, number: int) -> None:
        parsed = parse_envelopes(batch, _now(), keep_text=True)
        rest = unclaimed(specs)
        events = parsed.withColumns(
            {
                "_table": F.when(rest, F.lit(UNCLAIMED)).otherwise(F.col("source_table")),
                "_text": F.when(rest, F.col("_text")),
            }
        )
        staged_at = scratch_path(lake.spark, "events")
        try:
            events.write.partitionBy("_table").parquet(staged_at)
            staged = lake.spark.read.schema(events.schema).parquet(staged_at)
            found = {folder.split("=", 1)[1] for folder in files.sizes(staged_at) if "=" in folder}

            def apply_table(spec: TableSpec) -> None:
                rows = table_changes(staged.filter(F.col("_table") == spec.name), spec)
                identity = identity_of(spec, positions=False) if dedup_any_age else None
                apply_batch(lake, spec, rows, stream, number, delete_mode, late_delete, merge_each_batch, identity)

            _side_by_side(lake, apply_table, [spec for spec in specs if spec.name in found])
            if UNCLAIMED in found:
                left = staged.filter(F.col("_table") == UNCLAIMED).withColumnRenamed("_text", "value")
                columns = [name for name, _ in QUARANTINE_COLUMNS]
                lake.quarantine().append(left.select(*columns), stream, number)
        finally:
            files.delete(staged_at)

    return _each_batch(once(messages, ["topic", "value"], dedup_delay), take, checkpoint, trigger, "ingest_messages")


def apply_batch(
    lake: Lake,
    spec: TableSpec,
    changes: DataFrame,
    stream: str,
    number: int,
    delete_mode: str = SOFT,
    late_delete: str = LATE_WINS,
    merge: bool = True,
    identity: Sequence[str] | None = None,
) -> None:
    """One batch into bronze, then from its bronze files into silver.

    Silver reads the columnar files just written, so the batch is parsed once
    and both layers see the same arrival time, also after a retry. With
    ``identity`` changes that bronze has by these columns are left out.
    """
    bronze, silver = lake.bronze(spec), lake.silver(spec)
    if not bronze.has_applied(stream, number):
        if identity is None:
            append_bronze(bronze, changes, stream, number)
        else:
            Seen(bronze, identity).append_unseen(changes, stream, number)
    if merge:
        written = bronze.read_batch(stream, number)
        upsert_silver(silver, written, spec, _now(), delete_mode, late_delete, stream, number)


def append_stream(
    frame: DataFrame,
    table,
    checkpoint: str,
    per_batch: Callable[[DataFrame], DataFrame] | None = None,
    trigger: Trigger = AVAILABLE_NOW,
) -> StreamingQuery:
    """Append a stream to a history, each batch once. ``per_batch`` runs on every
    batch and may read tables anew."""

    def take(batch: DataFrame, stream: str, number: int) -> None:
        if not table.has_applied(stream, number):
            table.append(per_batch(batch) if per_batch else batch, stream, number)

    return _each_batch(frame, take, checkpoint, trigger, None)


def enrich_with_current(
    events: DataFrame,
    current: Callable[[], DataFrame],
    table,
    checkpoint: str,
    on: Column,
    columns: list[str],
    prefix: str,
    reference_key: str = "id",
    trigger: Trigger = AVAILABLE_NOW,
) -> StreamingQuery:
    """Join each batch with the state a changing table has at that moment."""

    def join_now(batch: DataFrame) -> DataFrame:
        return enrich(batch, current(), on, columns, prefix, reference_key)

    return append_stream(events, table, checkpoint, join_now, trigger)


def route_to_kafka(
    events: DataFrame, routes: Mapping[str, str], servers: str, checkpoint: str, trigger: Trigger | None = None
) -> StreamingQuery:
    """Routed events to their topics, from one query that reads the source once."""
    writer = (
        as_messages(route(events, routes))
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return _start(writer, trigger)


def route_to_files(
    events: DataFrame,
    routes: Mapping[str, str],
    path: str,
    checkpoint: str,
    trigger: Trigger | None = AVAILABLE_NOW,
) -> StreamingQuery:
    """Routed events as JSON messages in one folder per topic."""
    writer = (
        as_messages(route(events, routes))
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy("topic")
        .outputMode("append")
    )
    return _start(writer, trigger)


def _side_by_side(lake: Lake, work: Callable[[TableSpec], None], specs: list[TableSpec]) -> None:
    """Run the jobs of several tables at the same time, each in a thread that
    inherits the job settings of this one; the first error is raised."""
    inherit = inheritable_thread_target(lake.spark)
    with ThreadPoolExecutor(max(len(specs), 1)) as pool:
        futures = [pool.submit(inherit(work), spec) for spec in specs]
    for future in futures:
        future.result()


def _each_batch(
    frame: DataFrame,
    take: Callable[[DataFrame, str, int], None],
    checkpoint: str,
    trigger: Trigger | None,
    name: str | None,
) -> StreamingQuery:
    """Run ``take`` on every batch with the id of the query and the number.

    The id lives in the checkpoint. A new checkpoint, even at the old path,
    starts a new id, and its batches are not taken for repeated ones.
    """

    def call(batch: DataFrame, number: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        take(batch, stream or checkpoint, number)

    writer = frame.writeStream.foreachBatch(call).option("checkpointLocation", checkpoint)
    return _start(writer.queryName(name) if name else writer, trigger)


def _start(writer: DataStreamWriter, trigger: Trigger | None) -> StreamingQuery:
    return (writer.trigger(**trigger) if trigger else writer).start()
