"""Merge of partial row images.

A source that leaves unchanged large values out of its change records sends a
placeholder in their place. Such a value is not a value: the column keeps the last
one that was sent. So every column has an order of its own, that of the change
which set it, and changes are merged column by column: each takes the last present
value, in the order of source time, position and deletes. The row's operation and
times are those of its last change.

Taking a maximum for each column is associative, so the state does not depend on
how changes were split into batches, or in which order they came.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltlake.functions.classes import is_active
from siltlake.operators.feed import images
from siltlake.spec import ARRIVAL, AUDIT, BUCKET, CELLS, POSITION, UNSENT, TableSpec


def _order() -> list[Column]:
    return [F.col("ts_ms"), F.col(POSITION), F.col("op").eqNullSafe(F.lit("d")).alias("deletes")]


def prepare_partial(changes: DataFrame, spec: TableSpec, run_ts: Column) -> DataFrame:
    """One silver row per key: of each column the last value sent, and when.

    A column of which no change has a value is NULL and has no order. Rows without
    a key are left out. All maxima combine on the map side.
    """
    unsent = F.coalesce(F.col(UNSENT), F.array().cast("array<string>"))
    cells = {
        name: F.max(F.when(~F.array_contains(unsent, name), F.struct(*_order(), F.col(name).alias("value"))))
        for name in spec.cell_columns
    }
    last = F.max(F.struct(*_order(), "op", ARRIVAL)).alias("_last")
    found = (
        changes.filter(F.col(spec.key).isNotNull())
        .groupBy(spec.key)
        .agg(last, *[cell.alias(f"_cell_{name}") for name, cell in cells.items()])
    )
    orders = [
        F.when(F.col(f"_cell_{name}").isNotNull(), F.struct(*[F.col(f"_cell_{name}.{part}") for part in ("ts_ms", POSITION, "deletes")])).alias(name)
        for name in spec.cell_columns
    ]
    rows = found.select(
        spec.key,
        *[F.col(f"_cell_{name}.value").alias(name) for name in spec.cell_columns],
        *[F.col(f"_last.{name}").alias(name) for name in ("op", "ts_ms", ARRIVAL, POSITION)],
        F.struct(*orders).alias(CELLS),
    )
    return _finished(rows, spec, run_ts.cast("timestamp"))


def merge_partial(target: DataFrame, latest: DataFrame, spec: TableSpec, with_images: bool = False) -> DataFrame:
    """Merge prepared changes, one per key, into silver rows, column by column."""
    key = spec.key
    same = (F.col(f"t.{key}") == F.col(f"s.{key}")) & (F.col(f"t.{BUCKET}") == F.col(f"s.{BUCKET}"))
    joined = target.alias("t").join(latest.alias("s"), same, "full_outer")

    def later(mine: Column, other: Column) -> Column:
        """Whether the change has an order, and a greater one than the row."""
        return F.coalesce(mine > other, mine.isNotNull() & other.isNull())

    def row_order(side: str) -> Column:
        parts = [F.col(f"{side}.ts_ms"), F.col(f"{side}.{POSITION}"), F.col(f"{side}.op").eqNullSafe(F.lit("d")), F.col(f"{side}.op")]
        return F.when(F.col(f"{side}.{key}").isNotNull(), F.struct(*parts, F.col(f"{side}.{ARRIVAL}")))

    values, orders = [], []
    for name in spec.cell_columns:
        # Ties go to the greater value, as in the aggregate; a value that no change
        # sent has no order.
        mine, other = (F.when(F.col(f"{x}.{CELLS}.{name}").isNotNull(), F.struct(F.col(f"{x}.{CELLS}.{name}").alias("o"), F.col(f"{x}.{name}").alias("v"))) for x in "st")
        take = later(mine, other)
        values.append(F.when(take, F.col(f"s.{name}")).otherwise(F.col(f"t.{name}")).alias(name))
        orders.append(F.when(take, F.col(f"s.{CELLS}.{name}")).otherwise(F.col(f"t.{CELLS}.{name}")).alias(name))
    take = later(row_order("s"), row_order("t"))
    rest = [F.when(take, F.col(f"s.{name}")).otherwise(F.col(f"t.{name}")).alias(name) for name in ("op", "ts_ms", ARRIVAL, POSITION)]
    touched = F.coalesce(F.col(f"s.{AUDIT}"), F.col(f"t.{AUDIT}"))
    names = [name for name in spec.silver_schema().fieldNames() if name not in (key, BUCKET)]
    came, before = F.col(f"s.{key}").isNotNull(), F.when(F.col(f"t.{key}").isNotNull(), F.struct(*[F.col(f"t.{name}") for name in names]))
    rows = joined.select(
        F.coalesce(f"s.{key}", f"t.{key}").alias(key), *values, *rest, F.struct(*orders).alias(CELLS), touched.alias("_audit"),
        *([came.alias("_new"), before.alias("_old")] if with_images else []),
    )
    if not with_images:
        return _finished(rows, spec, F.col("_audit"))
    done = _finished(rows, spec, F.col("_audit"), ["_new", "_old"])
    return done.select(key, BUCKET, *images(F.col("_new"), F.lit(True), F.col("_old"), F.struct(*names)))


def _finished(rows: DataFrame, spec: TableSpec, audit: Column, more: Sequence[str] = ()) -> DataFrame:
    """Silver rows: derived columns follow from the merged values."""
    derived = {d.name: d.build() for d in spec.derived}
    silver = rows.withColumns({**derived, "is_active": is_active(F.col("op")), AUDIT: audit})
    return silver.select(*[name for name, _ in spec.silver_columns], spec.bucket().alias(BUCKET), *more)
