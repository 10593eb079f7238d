"""Enveloped change records: JSON with ``before``/``after`` images on a topic."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltlake.functions.classes import is_delete, routing_key
from siltlake.functions.values import typed
from siltlake.sources.drift import undeclared
from siltlake.sources.flat import kept_aside
from siltlake.spec import ARRIVAL, CORRUPT, POSITION, TableSpec


def kafka_changes(
    spark: SparkSession,
    servers: str,
    topics: Iterable[str],
    starting_offsets: str = "latest",
    fail_on_data_loss: bool = False,
    **options: str,
) -> DataFrame:
    """Subscribe to change topics (needs the Kafka connector on the classpath).

    By default the stream goes on when the topic no longer has offsets it has
    not read; ``fail_on_data_loss`` makes that an error.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
    )
    return reader.options(**options).load()


# The row images stay JSON text until the table, and so its columns, is known.
IMAGES = ("before_state", "after_state")
ENVELOPE = "before STRING, after STRING, op STRING, ts_ms STRING, source STRUCT<db: STRING, table: STRING>"


def parse_envelopes(
    messages: DataFrame, processed_at: Column | None = None, keep_text: bool = False
) -> DataFrame:
    """Topic messages to flat event rows, for batch and streaming frames alike.

    A value that is not an envelope gives NULL fields and keeps its text in
    ``_corrupt_record``; an empty value (a tombstone) gives NULL fields only.
    ``keep_text`` adds every message's text as ``_text``. The envelope comes out
    of a generator, below which no filter is pushed, so it is parsed once.
    """
    text = F.col("value").cast("string")
    arrival = F.current_timestamp() if processed_at is None else processed_at
    payload = messages.select(
        "topic",
        "partition",
        "offset",
        "timestamp",
        text.alias("_text"),
        F.explode(F.array(F.from_json(text, ENVELOPE))).alias("_payload"),
    )
    unreadable = (
        F.col("_text").isNotNull()
        & F.col("_payload.op").isNull()
        & F.col("_payload.before").isNull()
        & F.col("_payload.after").isNull()
        & F.col("_payload.ts_ms").isNull()
        & F.col("_payload.source").isNull()
    )
    return payload.select(
        "topic",
        "partition",
        "offset",
        "timestamp",
        F.col("_payload.op").alias("operation"),
        F.col("_payload.before").alias("before_state"),
        F.col("_payload.after").alias("after_state"),
        typed(F.col("_payload.ts_ms"), "bigint").alias("source_timestamp"),
        F.col("_payload.source.db").alias("source_database"),
        F.col("_payload.source.table").alias("source_table"),
        arrival.cast("timestamp").alias(ARRIVAL),
        routing_key(F.col("_payload.source.table"), F.col("_payload.op")).alias("routing_key"),
        is_delete(F.col("_payload.op")).alias("is_delete"),
        F.when(unreadable, F.col("_text")).alias(CORRUPT),
        *(["_text"] if keep_text else []),
    )


def table_changes(events: DataFrame, spec: TableSpec) -> DataFrame:
    """The events of one table as bronze rows, the same shape flat files give.

    The row image is ``after``, or ``before`` for a delete. The topic offset
    becomes the position that breaks ties between equal source times.
    """
    names = [name for name, _ in spec.landing_columns if name not in ("op", "ts_ms")]
    text = F.coalesce("after_state", "before_state")
    image = F.from_json(text, ", ".join(f"`{name}` STRING" for name in names))
    rows = events.filter(F.col("source_table") == spec.name).withColumn("_image", F.explode(F.array(image)))
    sent = {name: F.col(f"_image.{name}") for name in names}
    aside = kept_aside(spec, sent, undeclared(text, names) if spec.capture else None)
    if spec.placeholder is not None:
        sent = {name: F.nullif(value, F.lit(spec.placeholder)) for name, value in sent.items()}
    columns = []
    for name, kind in spec.landing_columns:
        if name == "op":
            columns.append(F.col("operation").alias("op"))
        elif name == "ts_ms":
            columns.append(F.col("source_timestamp").alias("ts_ms"))
        else:
            columns.append(typed(sent[name], kind).alias(name))
    return rows.select(
        *columns, ARRIVAL, F.col("offset").cast("bigint").alias(POSITION), F.col(CORRUPT), *aside
    )


def unclaimed(specs: Iterable[TableSpec]) -> Column:
    """True for events (with their text) that belong to none of the given
    tables: unreadable, without a table, or of a table nobody declared. Empty
    messages, the tombstones of a compacted topic, carry nothing to keep."""
    known = F.coalesce(F.col("source_table").isin([spec.name for spec in specs]), F.lit(False))
    return ~known & F.col("_text").isNotNull()
