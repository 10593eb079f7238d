"""Fan-out of events to topics by SQL predicates."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltlake.sources.envelope import IMAGES

# The default routes.
TABLE_ROUTES = {
    "processed.users": "source_table = 'users'",
    "processed.products": "source_table = 'products'",
    "processed.orders": "source_table = 'orders'",
}


def route(events: DataFrame, routes: Mapping[str, str]) -> DataFrame:
    """One output row per event and matching route, in one pass over the input.

    ``target_topic`` names the route. A predicate that is unknown (NULL) does
    not match.
    """
    hits = F.array(*[F.when(F.expr(condition), F.lit(topic)) for topic, condition in routes.items()])
    return events.select("*", F.explode(F.array_compact(hits)).alias("target_topic"))


def as_messages(routed: DataFrame) -> DataFrame:
    """Routed events as topic messages: the row as JSON, keyed by source topic."""
    body = [c for c in routed.columns if c != "target_topic"]
    return routed.select(
        F.col("target_topic").alias("topic"),
        F.col("topic").alias("key"),
        row_json(body).alias("value"),
    )


def row_json(columns: list[str]) -> Column:
    """The given columns as one JSON object; NULL fields are left out, row
    images stay the objects they are. An image that is no proper JSON (bare text,
    a key twice) stays the text it came as."""
    return F.to_json(F.struct(*[_image(c).alias(c) if c in IMAGES else F.col(c) for c in columns]))


def _image(name: str) -> Column:
    return F.coalesce(F.try_parse_json(name), F.col(name).cast("variant"))
