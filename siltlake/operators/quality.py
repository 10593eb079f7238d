"""Quality scores, delete alerts and the pipeline gate."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltlake.functions.classes import KNOWN_OPS, quality_score
from siltlake.spec import ARRIVAL, CORRUPT


# The operation of rows that an initial snapshot read.
SNAPSHOT_OP = "r"
QUARANTINED = "_quarantined"


class QualityGateError(RuntimeError):
    """The bronze layer broke a threshold."""


@dataclass(frozen=True)
class GateLimits:
    """Largest accepted share of each kind of bad row, and largest lag."""

    corrupt: float = 0.01
    null_key: float = 0.01
    unknown_op: float = 0.01
    quarantined: float = 0.01
    lag_ms: int | None = None


def score_events(events: DataFrame) -> DataFrame:
    return events.withColumn("quality_score", quality_score(F.col("operation")))


def delete_alerts(events: DataFrame) -> DataFrame:
    """Deletes with the row they removed, as JSON."""
    return events.filter("is_delete").select(
        "source_table", "operation", F.col("before_state").alias("deleted_record"), "timestamp"
    )


def gate_metrics(
    history: DataFrame, key: str = "id", group: str | None = None, quarantine: DataFrame | None = None
) -> DataFrame:
    """Counts of rows and of bad rows, and the largest arrival lag, in one pass.

    With ``quarantine`` also the messages there, which no history could take.
    """
    if quarantine is None:
        grouped = history.groupBy(group) if group else history.groupBy()
        return grouped.agg(*gate_aggregates(key))
    columns = [F.col(name) for name in dict.fromkeys([key, "op", "ts_ms", ARRIVAL, CORRUPT])]
    kept = history.select(*columns, F.lit(False).alias(QUARANTINED))
    blank = [F.lit(None).cast(kind).alias(name) for name, kind in kept.dtypes if name != QUARANTINED]
    both = kept.unionByName(quarantine.select(*blank, F.lit(True).alias(QUARANTINED)))
    return both.agg(
        *gate_aggregates(key, ~F.col(QUARANTINED)),
        F.count_if(F.col(QUARANTINED)).alias("quarantined_rows"),
    )


def gate_aggregates(
    key: str = "id",
    among: Column | None = None,
    known_ops: Sequence[str] = (*KNOWN_OPS, SNAPSHOT_OP),
) -> list[Column]:
    """The gate as aggregates, also usable with ``DataFrame.observe``. Rows of an
    initial snapshot are known; only their score stays 0."""
    readable = F.col(CORRUPT).isNull()
    among = F.lit(True) if among is None else among
    return [
        F.count_if(among).alias("rows"),
        F.count_if(among & ~readable).alias("corrupt_rows"),
        F.count_if(among & readable & F.col(key).isNull()).alias("null_keys"),
        F.count_if(among & readable & ~F.coalesce(F.col("op").isin(*known_ops), F.lit(False))).alias("unknown_ops"),
        F.max(F.unix_millis(F.col(ARRIVAL)) - F.col("ts_ms")).alias("max_lag_ms"),
    ]


def check_gate(metrics: dict, limits: GateLimits = GateLimits()) -> None:
    """Raise when a metric row is over its limits."""
    rows = metrics["rows"] or 0
    quarantined = metrics.get("quarantined_rows") or 0
    broken = []
    for name, limit in (
        ("corrupt_rows", limits.corrupt),
        ("null_keys", limits.null_key),
        ("unknown_ops", limits.unknown_op),
    ):
        if rows and metrics[name] / rows > limit:
            broken.append(f"{name}={metrics[name]} of {rows}")
    if quarantined and quarantined / (rows + quarantined) > limits.quarantined:
        broken.append(f"quarantined_rows={quarantined} next to {rows}")
    lag = metrics["max_lag_ms"]
    if limits.lag_ms is not None and lag is not None and lag > limits.lag_ms:
        broken.append(f"max_lag_ms={lag}")
    if broken:
        raise QualityGateError("; ".join(broken))
