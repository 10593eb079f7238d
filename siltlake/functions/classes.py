"""Threshold classes and row flags as plain column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Class bounds and labels.
PRICE_TIERS = [("Low", 50), ("Medium", 200)]
PRICE_TOP = "High"
ORDER_VALUE_TIERS = [("Small", 100), ("Medium", 500)]
ORDER_VALUE_TOP = "Large"
USER_SEGMENTS = [("Premium", 1000), ("Regular", 500)]
USER_BASE = "New"
PRODUCT_CLASSES = [("Top Performer", 5000), ("Good", 1000)]
PRODUCT_BASE = "Average"
LIFETIME_CLASSES = [("VIP", 10000), ("Gold", 1000)]
LIFETIME_BASE = "Silver"
KNOWN_OPS = ["c", "u", "d"]


def class_below(
    value: Column, bounds: Sequence[tuple[str, float]], top: str, null_label: str | None = None
) -> Column:
    """First label whose upper bound is greater than ``value``, else ``top``.

    An unknown value also falls to ``top`` unless ``null_label`` is given.
    """
    branches = [(value < bound, label) for label, bound in bounds]
    if null_label is not None:
        branches.insert(0, (value.isNull(), null_label))
    return _first_match(branches, top)


def class_above(value: Column, bounds: Sequence[tuple[str, float]], base: str) -> Column:
    """First label whose lower bound is strictly less than ``value``, else ``base``."""
    return _first_match([(value > bound, label) for label, bound in bounds], base)


def _first_match(branches: list[tuple[Column, str]], fallback: str) -> Column:
    (condition, label), *rest = branches
    out = F.when(condition, F.lit(label))
    for condition, label in rest:
        out = out.when(condition, F.lit(label))
    return out.otherwise(F.lit(fallback))


def price_tier(price: Column, bounds=PRICE_TIERS, null_label: str | None = None) -> Column:
    return class_below(price, bounds, PRICE_TOP, null_label)


def order_value_tier(amount: Column, bounds=ORDER_VALUE_TIERS, null_label: str | None = None) -> Column:
    return class_below(amount, bounds, ORDER_VALUE_TOP, null_label)


def user_segment(spent: Column, bounds=USER_SEGMENTS) -> Column:
    return class_above(spent, bounds, USER_BASE)


def product_class(revenue: Column, bounds=PRODUCT_CLASSES) -> Column:
    return class_above(revenue, bounds, PRODUCT_BASE)


def lifetime_class(value: Column, bounds=LIFETIME_CLASSES) -> Column:
    return class_above(value, bounds, LIFETIME_BASE)


def is_active(op: Column) -> Column:
    """False for deletes; any other code, an unknown one included, is live."""
    return ~op.eqNullSafe(F.lit("d"))


def is_delete(op: Column) -> Column:
    """Three-valued: an unknown operation stays unknown."""
    return op == F.lit("d")


def quality_score(op: Column) -> Column:
    return F.when(op.isin(KNOWN_OPS), F.lit(1.0)).otherwise(F.lit(0.0))


def routing_key(source_table: Column, op: Column) -> Column:
    """``table_op``; NULL when either part is NULL."""
    return F.concat(source_table, F.lit("_"), op)
