"""Totals by group, kept as rows of a stored table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltlake.operators.feed import images
from siltlake.spec import BUCKET

_STORED = "_stored"


def add_totals(
    old: DataFrame, new: DataFrame, keys: Sequence[str], sums: Sequence[str], rows: str | None = None, with_images: bool = False
) -> DataFrame:
    """Stored totals and what changes add to them, one row per group on each side.

    Both are aggregated together, by hash, instead of being sorted and joined. A
    group whose count ``rows`` becomes zero goes; with images all come, packed for
    a feed.
    """
    kinds = {field.name: field.dataType for field in new.schema}
    both = old.withColumn(_STORED, F.lit(True)).unionByName(new.withColumn(_STORED, F.lit(False)))
    stored = F.col(_STORED)
    found = [F.sum(s).cast(kinds[s]).alias(s) for s in sums]
    if with_images:
        found += [F.sum(F.when(stored, F.col(s))).cast(kinds[s]).alias(f"_old_{s}") for s in sums]
        found += [F.count_if(stored).alias("_olds"), F.count_if(~stored).alias("_news")]
    added = both.groupBy(BUCKET, *keys).agg(*found)
    kept = F.lit(True) if rows is None else F.col(rows) != 0
    if not with_images:
        return added.filter(kept).select(*new.columns)
    before = F.when(F.col("_olds") > 0, F.struct(*[F.col(f"_old_{s}").alias(s) for s in sums]))
    return added.select(BUCKET, *keys, *images(F.col("_news") > 0, kept, before, F.struct(*sums)))
