"""Fields that no specification declares: kept at the intake, and promoted to
columns when they have proved themselves.

An intake that captures keeps undeclared fields as a map from name to JSON text, so
nothing of a record is lost and its types are still known. Each text has a kind;
the kinds of a field join to the least type that holds them all:

    boolean     bigint < double        any two others, text, objects: string

Whole numbers that a double cannot hold join with fractions to a string, so that a
wider type never changes a value. The join is an OR of bits: it combines on the map
side and does not depend on order.

A promoted field stays in the map. Its column is read from there, so files that are
older than the promotion, or than a wider type, read like new ones and are never
rewritten.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltlake.spec import REST, TableSpec

# One bit for each kind of JSON value; null has none.
BOOLEAN, WHOLE, WIDE, FRACTION, TEXT, NESTED = (1 << i for i in range(6))
# Whole numbers up to this size are exact as doubles.
EXACT_DOUBLE = 1 << 53


def undeclared(text: Column, declared: Iterable[str]) -> Column:
    """The fields of a JSON object that are not declared, as JSON texts; NULL for
    none, and for text that is no object."""
    fields = F.from_json(text, "map<string, variant>")
    rest = F.map_filter(fields, lambda name, _: ~name.isin(list(declared)))
    texts = F.transform_values(rest, lambda _, value: F.to_json(value))
    return F.when(F.size(rest) > 0, texts)


def kind_bits(token: Column) -> Column:
    """The kind of a JSON value, as a bit; 0 for null."""
    whole = token.rlike(r"^-?[0-9]+$")
    number = token.try_cast("decimal(38,0)")
    return (
        F.when(token.isNull() | (token == "null"), F.lit(0))
        .when(token.isin("true", "false"), F.lit(BOOLEAN))
        .when(token.startswith('"'), F.lit(TEXT))
        .when(token.startswith("{") | token.startswith("["), F.lit(NESTED))
        .when(whole & token.try_cast("bigint").isNull(), F.lit(TEXT))  # no type holds it
        .when(whole & (F.abs(number) > EXACT_DOUBLE), F.lit(WIDE))
        .when(whole, F.lit(WHOLE))
        .otherwise(F.lit(FRACTION))
    )


def join_kinds(bits: int) -> str | None:
    """The least type that holds values of all kinds; None while all were null."""
    if not bits:
        return None
    if bits == BOOLEAN:
        return "boolean"
    if not bits & ~(WHOLE | WIDE):
        return "bigint"
    if not bits & ~(WHOLE | FRACTION):
        return "double"
    return "string"


def profile(rows: DataFrame) -> DataFrame:
    """field, seen (rows that have it), valued (with a value), bits (their kinds,
    joined), of rows with a map of undeclared fields."""
    fields = rows.filter(F.col(REST).isNotNull()).select(F.explode(REST).alias("field", "token"))
    bits = kind_bits(F.col("token"))
    return fields.groupBy("field").agg(
        F.count(F.lit(1)).alias("seen"), F.count_if(bits > 0).alias("valued"), F.bit_or(bits).alias("bits")
    )


@dataclass(frozen=True)
class Promotion:
    """A field becomes a column when ``least_rows`` rows have a value of it and
    they are ``least_share`` of all rows. Names that a specification uses itself, and
    more than ``most_columns`` columns in all, are not taken: they stay in the map."""

    least_rows: int = 100
    least_share: float = 0.01
    most_columns: int = 1000


def promote(spec: TableSpec, found: DataFrame, n_rows: int, policy: Promotion = Promotion()) -> TableSpec:
    """The specification with the columns that the profile ``found`` asks for, and
    with wider types where promoted columns have outgrown theirs.

    A column is never taken back, nor its type narrowed. The driver gets one row for
    each field that qualifies, ``most_columns`` at most.
    """
    known = dict(spec.promoted)
    taken = {name for name, _ in spec.silver_columns} - set(known)
    free = F.col("field").rlike("^[A-Za-z][A-Za-z0-9_]*$") & ~F.lower("field").isin([name.lower() for name in taken])
    enough = (F.col("valued") >= max(1, policy.least_rows)) & (F.col("valued") >= policy.least_share * n_rows)
    old = F.col("field").isin(list(known)) if known else F.lit(False)
    wanted = found.filter(free & (enough | old) & (F.col("bits") > 0)).orderBy(F.desc(old), F.desc("valued"), "field")
    lower = {name.lower() for name in known}
    for row in wanted.limit(policy.most_columns).collect():
        name, kind = row["field"], join_kinds(row["bits"])
        if name in known:
            known[name] = wider(known[name], kind)
        elif name.lower() not in lower:  # names that differ in case only are one column
            known[name] = kind
            lower.add(name.lower())
    return spec.with_options(promoted=tuple(sorted(known.items())))


def wider(old: str, new: str) -> str:
    """The least type that holds both. A column that was a bigint may hold numbers
    that a double cannot, unless the profile says otherwise by being whole."""
    if old == new or {old, new} == {"bigint", "double"}:
        return new if new != "bigint" else old
    return "string"


def with_promoted(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """``rows`` with the promoted columns, read from the map; a text that the type
    cannot hold is NULL there and stays in the map."""
    missing = {name: kind for name, kind in spec.promoted if name not in rows.columns}
    value = lambda name, kind: F.try_variant_get(F.try_parse_json(F.col(REST)[name]), "$", kind)
    return rows.withColumns({name: value(name, kind) for name, kind in missing.items()}) if missing else rows
