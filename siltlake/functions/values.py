"""Casts, epoch time and order-independent sums."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Microseconds per unit of a source clock.
EPOCH_UNITS = {"s": 1_000_000, "ms": 1_000, "us": 1}

# Decimal places that sums of amounts keep.
AMOUNT_SCALE = 6


def typed(value: Column, type_name: str) -> Column:
    """Lenient cast: what cannot be read as ``type_name`` becomes NULL.

    Whole-number types also accept ``1.0`` and ``1.7E12``, the forms JSON
    writers use for large or computed integers; the fraction is cut off.
    """
    plain = value.try_cast(type_name)
    if type_name in ("bigint", "int"):
        return F.coalesce(plain, value.try_cast("decimal(38,6)").try_cast(type_name))
    return plain


def email_domain(email: Column) -> Column:
    """Text after the first ``@``; empty when there is none, NULL for NULL."""
    return F.regexp_extract(email, "@(.+)", 1)


def epoch_timestamp(value: Column, unit: str = "ms") -> Column:
    if unit == "s":
        return F.timestamp_seconds(value)
    return F.timestamp_millis(value) if unit == "ms" else F.timestamp_micros(value)


def day_of(value: Column, unit: str = "ms") -> Column:
    """UTC day of an epoch value as a DATE, flooring before 1970 too."""
    return F.to_date(epoch_timestamp(value, unit))


def day_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def day_key(value: Column, unit: str = "ms") -> Column:
    """UTC day ``yyyy-MM-dd`` of an epoch value."""
    return day_text(day_of(value, unit))


def exact_sum(amount: Column, scale: int = AMOUNT_SCALE) -> Column:
    """Sum of a DOUBLE money column that does not depend on row order.

    Values are added as wide decimals of ``scale`` places; finer fractions are
    rounded to them, one value at a time. Under ANSI a sum, or a value, of 10^32
    or more raises. A value that is no number (NaN, infinite) makes the sum NaN.
    """
    finite = F.abs(amount) < F.lit(float("inf"))
    exact = F.sum(F.when(finite, amount).cast(f"decimal(38,{scale})")).cast("double")
    return F.when(F.bool_or(~finite), F.lit(float("nan"))).otherwise(exact)


def exact_avg(amount: Column, scale: int = AMOUNT_SCALE) -> Column:
    """Mean of the non-NULL values, from ``exact_sum``; NULL for none."""
    return exact_sum(amount, scale) / F.nullif(F.count(amount), F.lit(0)).cast("double")
