"""Removal of replayed changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltlake.operators.latest import least_row
from siltlake.spec import ARRIVAL

IDENTITY = ("source_table", "id", "ts_ms", "op")


def dedup_changes(changes: DataFrame, identity: Sequence[str] = IDENTITY) -> DataFrame:
    """The first arrival of each change. Copies are reduced on the map side,
    so a change replayed very often does not fill one task."""
    return least_row(changes, list(identity), [ARRIVAL])


def dedup_stream(
    changes: DataFrame,
    time: str,
    delay: str,
    identity: Sequence[str] = IDENTITY,
    salts: int = 32,
) -> DataFrame:
    """First arrival of each change on a stream, within ``delay`` of event time.

    The streaming operator has no map-side step, so all copies of one change
    would meet in one task. A first pass per (change, source task modulo
    ``salts``) spreads them; the second pass then sees at most ``salts`` of
    them per batch.
    """
    salted = changes.withWatermark(time, delay).withColumn(
        "_salt", F.pmod(F.spark_partition_id(), F.lit(salts))
    )
    thinned = salted.dropDuplicatesWithinWatermark([*identity, "_salt"]).drop("_salt")
    return thinned.dropDuplicatesWithinWatermark(list(identity))


def once(frame: DataFrame, identity: Sequence[str], delay: str | None) -> DataFrame:
    """Rows of a stream whose ``identity`` did not arrive within ``delay`` before.

    The clock is that of arrival, so no row is late and none is lost; without a
    delay all rows pass. State holds a digest of 128 bits for each row, whatever
    the identity is made of.
    """
    if delay is None:
        return frame
    arrived = frame.withColumns({"_arrived": F.current_timestamp(), "_digest": digest(identity)})
    return dedup_stream(arrived, "_arrived", delay, ["_digest"]).drop("_arrived", "_digest")


def digest(columns: Sequence[str]) -> Column:
    """128 bits for the values of the columns; NULL is a value of its own."""
    return F.unhex(F.md5(F.to_json(F.struct(*columns))))
