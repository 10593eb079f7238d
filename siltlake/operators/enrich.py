"""Left joins of change events with reference tables.

No join is forced: a reference below Spark's broadcast threshold is joined
map-side, a larger one by shuffle, where adaptive execution splits the event
partitions of hot keys (also for stateless streams).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltlake.functions.values import typed

# Reference columns added per table.
REFERENCE_COLUMNS = {"users": ["name", "email"], "products": ["name", "category", "price"]}


def event_key(table: str, foreign_keys: dict[str, str] | None = None) -> Column:
    """The reference key an event points to: its own id for events of that
    table, the declared foreign key for events of other tables, else NULL."""
    key = F.when(F.col("source_table") == table, F.get_json_object("after_state", "$.id"))
    for source, column in (foreign_keys or {}).items():
        key = key.when(F.col("source_table") == source, F.get_json_object("after_state", f"$.{column}"))
    return typed(key, "bigint")


def enrich(
    events: DataFrame,
    reference: DataFrame,
    on: Column,
    columns: Sequence[str],
    prefix: str,
    reference_key: str = "id",
) -> DataFrame:
    """Events with ``columns`` of the matching reference row, NULL without one.

    ``reference_key`` is unique in the reference. The added columns are
    prefixed, so several references can be chained.
    """
    lookup = reference.select(
        F.col(reference_key).alias("_ref_key"), *[F.col(c).alias(f"{prefix}{c}") for c in columns]
    )
    keyed = events.withColumn("_event_key", on)
    return keyed.join(lookup, keyed["_event_key"] == lookup["_ref_key"], "left").drop("_event_key", "_ref_key")


def enrich_table(
    events: DataFrame, reference: DataFrame, table: str, foreign_keys: dict[str, str] | None = None
) -> DataFrame:
    """Enrich with the ``users`` or ``products`` reference."""
    return enrich(
        events, reference, event_key(table, foreign_keys), REFERENCE_COLUMNS[table], prefix=f"{table}_"
    )
