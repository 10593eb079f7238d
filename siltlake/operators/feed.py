"""Both images of what a commit changes, from the pass that computes its rows.

Whoever combines stored rows with changes can leave each row packed: its keys and
bucket, for which rows changes came, which rows stay, and the other columns before
and after. ``fed`` yields from that the rows of the table and those of its feed, so
that one write makes both.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltlake.spec import BUCKET, SIGN

CAME, KEPT, BEFORE, AFTER = "_came", "_kept", "_before", "_after"


def images(came: Column, kept: Column, before: Column, after: Column) -> list[Column]:
    """``before`` is NULL for a row that was not there."""
    return [came.alias(CAME), kept.alias(KEPT), before.alias(BEFORE), after.alias(AFTER)]


def feed_bucket(bucket: Column) -> Column:
    """The folder number of a bucket's feed, and back: -1, -2, ... for 0, 1, ..."""
    return (F.lit(-1) - bucket).cast("int")


def unpacked(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """The rows that stay."""
    return rows.filter(KEPT).select(*_columns(rows, names, AFTER))


def fed(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """The rows that stay, with sign 0, and the feed: rows that were taken out (-1)
    or put in (1), under their feed bucket. Rows that stay as they are feed nothing."""
    kept, before, after = F.col(KEPT), F.col(BEFORE), F.col(AFTER)
    changed = F.col(CAME) & ~(kept & after.eqNullSafe(before))

    def image(row: Column, sign: int) -> Column:
        return F.struct(row.alias("_row"), F.lit(sign).cast("bigint").alias(SIGN))

    found = F.array(
        F.when(kept, image(after, 0)),
        F.when(changed & before.isNotNull(), image(before, -1)),
        F.when(changed & kept, image(after, 1)),
    )
    flat = rows.select(*_common(rows), F.inline(found)).filter(F.col(SIGN).isNotNull())
    bucket = F.when(F.col(SIGN) == 0, F.col(BUCKET)).otherwise(feed_bucket(F.col(BUCKET)))
    return flat.withColumn(BUCKET, bucket).select(*_columns(rows, names, "_row"), SIGN)


def _common(rows: DataFrame) -> list[str]:
    return [name for name in rows.columns if name not in (CAME, KEPT, BEFORE, AFTER)]


def _columns(rows: DataFrame, names: Sequence[str], packed: str) -> list[Column]:
    common = _common(rows)
    return [F.col(name) if name in common else F.col(f"{packed}.{name}") for name in names]
