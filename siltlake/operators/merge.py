"""Keyed merge of changes into the current state of a table.

Both sides are joined once, on bucket and key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltlake.functions.classes import is_active
from siltlake.operators.feed import images, unpacked
from siltlake.operators.latest import latest_per_key
from siltlake.operators.partial import merge_partial, prepare_partial
from siltlake.sources.drift import with_promoted
from siltlake.spec import ARRIVAL, AUDIT, BUCKET, POSITION, TableSpec

SOFT, HARD = "soft", "hard"
LATE_WINS, LATE_IGNORED = "win", "ignore"
# All values of a row but its key and bucket, while it is merged.
ROW = "_row"


def prepare_changes(changes: DataFrame, spec: TableSpec, run_ts: Column) -> DataFrame:
    """Reduce changes to one silver row per key, derived columns added.

    Rows without a key cannot be merged; they stay in bronze and are counted
    by the quality gate. Images of a source that leaves values out are reduced
    column by column.
    """
    keyed = with_promoted(changes, spec).filter(F.col(spec.key).isNotNull())
    if POSITION not in keyed.columns:
        keyed = keyed.withColumn(POSITION, F.lit(None).cast("bigint"))
    if spec.placeholder is not None:
        return prepare_partial(keyed, spec, run_ts)
    kept = [*spec.business, "created_at", "updated_at", "op", "ts_ms", ARRIVAL, POSITION]
    latest = latest_per_key(keyed.select(kept), spec.key)
    silver = latest.withColumns(
        {
            **{d.name: d.build() for d in spec.derived},
            "is_active": is_active(F.col("op")),
            AUDIT: run_ts.cast("timestamp"),
        }
    )
    return silver.select(*[name for name, _ in spec.silver_columns], spec.bucket().alias(BUCKET))


def merge_changes(
    target: DataFrame,
    changes: DataFrame,
    spec: TableSpec,
    run_ts: Column,
    delete_mode: str = SOFT,
    late_delete: str = LATE_WINS,
) -> DataFrame:
    """State of ``target`` after ``changes``, any number per key."""
    return merge_latest(target, prepare_changes(changes, spec, run_ts), spec, delete_mode, late_delete)


def merge_latest(
    target: DataFrame,
    latest: DataFrame,
    spec: TableSpec,
    delete_mode: str = SOFT,
    late_delete: str = LATE_WINS,
    with_images: bool = False,
) -> DataFrame:
    """Merge prepared changes, one per key, into silver rows.

    Soft mode, first match wins: a newer change (``newer_sql``) replaces the row;
    a delete that is not newer still marks the row inactive and leaves its
    values (``late_delete="ignore"`` drops it instead); anything else leaves the
    row; an unknown key is inserted, a delete as an inactive row.

    Hard mode has no time guard: a delete removes the row, another known
    operation replaces it, and a delete of an unknown key inserts nothing.

    Where values may have been left out, rows are merged column by column, in an
    order that no split of the changes alters; that has no hard mode.

    With images, rows that are removed come too, and all stay packed for a feed.
    """
    if spec.placeholder is not None:
        if delete_mode == HARD:
            raise ValueError(f"{spec.name} has partial images: a row that was removed could not be completed later")
        return merge_partial(target, latest, spec, with_images)
    key, names = spec.key, spec.silver_schema().fieldNames()
    rest = F.struct(*[name for name in names if name not in (key, BUCKET)]).alias(ROW)
    old, new = (side.select(key, BUCKET, rest).alias(name) for side, name in ((target, "t"), (latest, "s")))
    same = (F.col(f"t.{key}") == F.col(f"s.{key}")) & (F.col(f"t.{BUCKET}") == F.col(f"s.{BUCKET}"))
    rows = _resolve(old.join(new, same, "full_outer"), spec, delete_mode, late_delete)
    return rows if with_images else unpacked(rows, names)


def newer_sql(spec: TableSpec, late_delete: str = LATE_WINS, sides: tuple[str, str] = ("s", "t")) -> str:
    """Whether change ``s`` is later than row ``t``, in the order that
    ``latest_per_key`` has: source time, position, deletes last.

    When late deletes are ignored, the other columns break the ties that are
    left and an unknown time is the earliest, so that the state does not depend
    on how changes were split. Otherwise such ties, and unknown times, leave
    the row as it is.
    """
    names = ["ts_ms", POSITION]
    others = spec.order_columns if late_delete == LATE_IGNORED else []

    def order(side: str) -> str:
        columns = [*[f"{side}.`{n}`" for n in names], f"({side}.op <=> 'd')", *[f"{side}.`{n}`" for n in others]]
        return f"struct({', '.join(columns)})"

    new, old = sides
    known = "" if late_delete == LATE_IGNORED else f"{new}.ts_ms >= {old}.ts_ms AND "
    return f"coalesce({known}{order(new)} > {order(old)}, false)"


def _resolve(joined: DataFrame, spec: TableSpec, delete_mode: str, late_delete: str) -> DataFrame:
    """Pick the surviving row of joined rows ``t`` (old) and ``s`` (new), each with
    its values packed: one choice moves them all."""
    has_old, has_new = F.col(f"t.{spec.key}").isNotNull(), F.col(f"s.{spec.key}").isNotNull()
    mine, other = F.col(f"s.{ROW}"), F.col(f"t.{ROW}")
    op = mine.getField("op")
    deletes = F.coalesce(op == "d", F.lit(False))
    kept = F.lit(True)
    if delete_mode == HARD:
        kept = ~(has_new & deletes)
        replaces = F.coalesce(op != "d", F.lit(False))
    else:
        replaces = F.expr(newer_sql(spec, late_delete, (f"s.{ROW}", f"t.{ROW}")))
    after = F.when(~has_old | (has_new & replaces), mine)
    if delete_mode != HARD and late_delete == LATE_WINS:
        marked = other.withField("is_active", F.lit(False)).withField("op", F.lit("d")).withField(AUDIT, mine.getField(AUDIT))
        after = after.when(has_new & deletes, marked)
    common = [F.coalesce(f"s.{name}", f"t.{name}").alias(name) for name in (spec.key, BUCKET)]
    return joined.select(*common, *images(has_new, kept, other, after.otherwise(other)))
