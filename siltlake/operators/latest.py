"""Greatest or least row per group, by aggregation.

``max(struct(...))`` combines on the map side, so a key that holds a large
share of all rows arrives at its reducer as one row per map task. A window
with ``row_number`` would sort every row of the key twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltlake.spec import POSITION


def greatest_row(df: DataFrame, group: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """The row of each group that is greatest by ``order_by`` (NULLs least).

    The remaining columns follow in the ordering, so the result is the same
    for every row order even when ``order_by`` ties.
    """
    return _extreme_row(df, group, order_by, F.max)


def least_row(df: DataFrame, group: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    return _extreme_row(df, group, order_by, F.min)


def _extreme_row(df, group, order_by, pick) -> DataFrame:
    order = [F.col(c) if isinstance(c, str) else c.alias(f"_rank{i}") for i, c in enumerate(order_by)]
    rest = [F.col(c) for c in df.columns if c not in group and c not in _plain_names(order_by)]
    best = df.groupBy(*group).agg(pick(F.struct(*order, *rest)).alias("_best"))
    return best.select(*[F.col(c) if c in group else F.col(f"_best.{c}").alias(c) for c in df.columns])


def _plain_names(order_by: Sequence[str | Column]) -> set[str]:
    """Plain columns of an ordering; they need no second place in the row."""
    return {c for c in order_by if isinstance(c, str)}


def latest_per_key(changes: DataFrame, key: str = "id") -> DataFrame:
    """The last change of each key: by source time, then source position, a
    delete after other changes of its instant, then by the other columns."""
    order = ["ts_ms"] + ([POSITION] if POSITION in changes.columns else [])
    return greatest_row(changes, [key], [*order, F.col("op").eqNullSafe(F.lit("d"))])


def top_product_per_day(product_revenue: DataFrame) -> DataFrame:
    """Best-selling product of each day; the smaller id wins a tie."""
    best = greatest_row(
        product_revenue.select("date_key", "product_id", "product_revenue"),
        ["date_key"],
        ["product_revenue", -F.col("product_id")],
    )
    return best.select("date_key", F.col("product_id").alias("top_product"))
