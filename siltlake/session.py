"""Session settings and the shared scratch folder."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import SparkSession

# Every epoch and day key is computed in UTC; ANSI stays on so that overflow
# and bad casts are loud wherever the code does not ask for ``try_``.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}


# Stored (compressed) bytes one shuffle partition should stand for.
BYTES_PER_SHUFFLE_PARTITION = 64 * 1024 * 1024


def build_session(app_name: str = "siltlake", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> None:
    """Settings that results depend on, for a session built elsewhere."""
    for key in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled"):
        spark.conf.set(key, SETTINGS[key])


def fork_session(spark: SparkSession, **overrides: str) -> SparkSession:
    """A session of the same application with the same settings but for
    ``overrides``, so that jobs running side by side do not disturb each other."""
    fork = spark.newSession()
    for key, value in {**spark.conf.getAll, **overrides}.items():
        if spark.conf.isModifiable(key):
            fork.conf.set(key, value)
    return fork


def sized_session(spark: SparkSession, stored_bytes: int) -> SparkSession:
    """A session whose shuffles are wide enough for inputs of a known size.

    Adaptive execution merges partitions that turn out small, but it does not
    split the partitions of an aggregate, so the first width has to fit.
    """
    width = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(stored_bytes / BYTES_PER_SHUFFLE_PARTITION)
    )
    return fork_session(spark, **{"spark.sql.shuffle.partitions": str(width)})


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own: on a cluster
    the executors would not see it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    local = tempfile.mkdtemp(prefix="siltlake-")
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the scratch root; nothing is created yet."""
    return f"{scratch_root(spark)}/siltlake/{purpose}-{uuid.uuid4().hex}"
