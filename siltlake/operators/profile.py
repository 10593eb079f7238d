"""Profiles of columns that add up, and how far two of them lie apart.

A profile of a column has counts and bounds, a sketch of its different values and,
for numbers, one of its quantiles. All parts merge, so a profile of many batches
comes from those of each, and a batch is read once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from siltlake.operators.quality import QualityGateError

PROFILE_COLUMNS = [
    ("column", "string"), ("rows", "bigint"), ("nulls", "bigint"), ("low", "double"), ("high", "double"),
    ("distinct", "binary"), ("quantiles", "binary"),
]
# Points at which distributions are compared.
POINTS = tuple(k / 20 for k in range(1, 20))


@dataclass(frozen=True)
class ShapeLimits:
    """Largest accepted distance from the last profile that passed: between the
    cumulative distributions (0 to 1) and between the shares of NULL. Batches of
    fewer rows than ``least_rows`` say too little and pass."""

    shift: float = 0.2
    nulls: float = 0.1
    least_rows: int = 200


def profile(rows: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """A row for each of ``columns``, and each group of ``by``, in one pass."""
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    parts = []
    for name in columns:
        value = F.col(name)
        number = value.cast("double") if isinstance(kinds[name], NumericType) else F.lit(None).cast("double")
        usable = F.when(F.abs(number) < F.lit(float("inf")), number)
        parts += [
            F.struct(
                F.count(F.lit(1)).alias("rows"), F.count_if(value.isNull()).alias("nulls"),
                F.min(usable).alias("low"), F.max(usable).alias("high"),
                F.hll_sketch_agg(value.cast("string")).alias("distinct"), F.kll_sketch_agg_double(usable).alias("quantiles"),
            ).alias(f"p_{name}")
        ]
    found = rows.groupBy(*by).agg(*parts)
    named = [F.struct(F.lit(name).alias("column"), F.col(f"p_{name}").alias("p")) for name in columns]
    return found.select(*by, F.explode(F.array(*named)).alias("c")).select(*by, "c.column", "c.p.*")


def merged(profiles: DataFrame) -> DataFrame:
    """One profile for each column, of all the rows that ``profiles`` stand for."""
    return profiles.groupBy("column").agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.hll_union_agg("distinct").alias("distinct"), F.kll_merge_agg_double("quantiles").alias("quantiles"),
    )


def n_distinct(sketch: Column) -> Column:
    return F.hll_sketch_estimate(sketch)


def distance(new: DataFrame, old: DataFrame) -> DataFrame:
    """column, rows, shift and nulls: how far each new profile is from the old one.

    ``shift`` is the largest difference of the cumulative distributions, at the
    quantiles of both, so that values which are very frequent do not count as a
    shift; NULL where a side has no numbers. A column without an old profile has
    no distance."""
    both = new.alias("a").join(old.alias("b"), F.col("a.column") == F.col("b.column"))
    # Ranks are taken at literals only: the points, a few for each column, pass
    # through the driver.
    numbers = both.filter(F.col("a.low").isNotNull() & F.col("b.low").isNotNull())
    probes = F.array(*[F.lit(p) for p in POINTS])
    at = [F.kll_sketch_get_quantile_double(f"{side}.quantiles", probes).alias(side) for side in "ab"]
    shift = F.lit(None).cast("double")
    for row in numbers.select("a.column", *at).collect():
        points = F.array(*[F.lit(x) for x in sorted({*row["a"], *row["b"]})])
        ranks = [F.kll_sketch_get_rank_double(f"{side}.quantiles", points) for side in "ab"]
        shift = F.when(F.col("a.column") == row["column"], F.array_max(F.zip_with(*ranks, lambda x, y: F.abs(x - y)))).otherwise(shift)
    share = lambda side: F.col(f"{side}.nulls") / F.nullif(F.col(f"{side}.rows"), F.lit(0))
    return both.select(
        "a.column", "a.rows", shift.alias("shift"), F.abs(share("a") - share("b")).alias("nulls")
    )


def check_shape(distances: DataFrame, limits: ShapeLimits = ShapeLimits()) -> None:
    """Raise when a column has moved too far; the driver gets a row for each."""
    broken = []
    for row in distances.filter(F.col("rows") >= limits.least_rows).orderBy("column").collect():
        if row["shift"] is not None and row["shift"] > limits.shift:
            broken.append(f"{row['column']} shifted by {row['shift']:.2f}")
        if row["nulls"] is not None and row["nulls"] > limits.nulls:
            broken.append(f"NULLs of {row['column']} changed by {row['nulls']:.2f}")
    if broken:
        raise QualityGateError("; ".join(broken))
