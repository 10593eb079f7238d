"""Change feeds derived from the star-schema test tables.

``events`` plays the change log of orders (four changes per order id),
``customer`` the users and ``part`` the products. Every feed covers its whole
table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltlake.spec import ARRIVAL, CORRUPT, POSITION

# Fixed value: 2024-01-23 08:53:20 UTC, the first instant of user and product changes.
START_MS = 1706000000000
ARRIVAL_DELAY_MS = 300_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with an instant, its epoch value, the product and an operation."""
    instant = F.col("ts").cast("timestamp")
    return table(spark, sf_dir, "events").select(
        "event_id",
        instant.alias("ts"),
        F.unix_millis(instant).alias("ts_ms"),
        "user_id",
        "event_type",
        "value",
        "props",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        event_op(F.col("event_type")).alias("op"),
    )


def event_op(event_type: Column) -> Column:
    return F.when(event_type == "signup", "c").when(event_type == "error", "d").otherwise("u")


def order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as order changes, in bronze form plus the batch numbers.

    ``in_order`` puts the first two changes of an order in batch 0 and the
    last two in batch 1. ``late`` does so for odd order ids and the reverse
    for even ones, so batch 1 holds newer and older changes. Every change is
    in one of the two batches.
    """
    first_half = F.col("event_id") % 4 < 2
    order_id = F.floor(F.col("event_id") / 4).cast("bigint")
    return events(spark, sf_dir).select(
        order_id.alias("id"),
        "user_id",
        F.col("k").alias("product_id"),
        (F.col("k") % 5 + 1).cast("int").alias("quantity"),
        F.col("value").alias("total_amount"),
        F.col("event_type").alias("status"),
        F.col("ts_ms").alias("created_at"),
        F.col("ts_ms").alias("updated_at"),
        "op",
        "ts_ms",
        F.timestamp_millis(F.col("ts_ms") + ARRIVAL_DELAY_MS).alias(ARRIVAL),
        F.col("event_id").alias(POSITION),
        F.lit(None).cast("string").alias(CORRUPT),
        F.when(first_half, 0).otherwise(1).alias("in_order"),
        F.when(first_half == (order_id % 2 == 1), 0).otherwise(1).alias("late"),
    )


def batch_of(changes: DataFrame, split: str, number: int) -> DataFrame:
    return changes.filter(F.col(split) == number).drop("in_order", "late")


def user_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as users; a negative balance is a closed account."""
    at = START_MS + F.col("c_custkey") * 1000
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        user_email().alias("email"),
        at.alias("created_at"),
        at.alias("updated_at"),
        F.when(F.col("c_acctbal") < 0, "d").otherwise("c").alias("op"),
        at.alias("ts_ms"),
        F.timestamp_millis(at + ARRIVAL_DELAY_MS).alias(ARRIVAL),
        F.col("c_custkey").alias(POSITION),
        F.lit(None).cast("string").alias(CORRUPT),
    )


def user_email() -> Column:
    """Addresses of all shapes: usual, two ``@``, none, and NULL."""
    segment = F.lower("c_mktsegment")
    number = F.col("c_custkey").cast("string")
    return (
        F.when(segment == "machinery", F.concat(F.lit("no-address-"), number))
        .when(segment == "household", F.concat(F.lit("u@"), number, F.lit("@"), segment))
        .when(segment == "furniture", F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("u"), number, F.lit("@"), segment, F.lit(".example.com")))
    )


def product_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as products; the smallest sizes are withdrawn."""
    at = START_MS + F.col("p_partkey") * 1000
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_retailprice").alias("price"),
        F.col("p_type").alias("category"),
        at.alias("created_at"),
        at.alias("updated_at"),
        F.when(F.col("p_size") < 3, "d").otherwise("c").alias("op"),
        at.alias("ts_ms"),
        F.timestamp_millis(at + ARRIVAL_DELAY_MS).alias(ARRIVAL),
        F.col("p_partkey").alias(POSITION),
        F.lit(None).cast("string").alias(CORRUPT),
    )


def flat_records(changes: DataFrame) -> DataFrame:
    """Changes under their wire names, without what arrival adds."""
    extra = [c for c in (ARRIVAL, POSITION, CORRUPT, "in_order", "late") if c in changes.columns]
    return changes.drop(*extra).withColumnsRenamed({"op": "__op", "ts_ms": "__ts_ms"})


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as enveloped messages of three topics.

    Sign-ups create users and errors delete them, views update products,
    purchases create orders and clicks update them.
    """
    kind = F.col("event_type")
    source = F.when(kind.isin("signup", "error"), "users").when(kind == "view", "products").otherwise("orders")
    op = F.when(kind.isin("signup", "purchase"), "c").when(kind == "error", "d").otherwise("u")
    order_id = F.floor(F.col("event_id") / 4).cast("bigint")
    entity = F.when(source == "users", F.col("user_id")).when(source == "products", F.col("k")).otherwise(order_id)
    image = F.struct(
        entity.alias("id"),
        F.when(source != "orders", F.concat(source, F.lit("-"), entity.cast("string"))).alias("name"),
        F.when(source == "orders", F.col("user_id")).alias("user_id"),
        F.when(source == "orders", F.col("k")).alias("product_id"),
        F.when(source == "orders", F.col("value")).alias("total_amount"),
        F.when(source == "products", F.col("value")).alias("price"),
    )
    partition = F.pmod("user_id", F.lit(8))
    return _as_messages(events(spark, sf_dir), source, op, F.struct(entity.alias("id")), image, partition)


def order_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order changes as enveloped messages, batch numbers kept."""
    return change_messages(order_changes(spark, sf_dir), "orders", ("in_order", "late"))


def change_messages(changes: DataFrame, source: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Bronze-form changes of one table as enveloped messages."""
    added = {"op", "ts_ms", ARRIVAL, POSITION, CORRUPT, "in_order", "late"}
    image = F.struct(*[c for c in changes.columns if c not in added])
    frame = changes.withColumns({"ts": F.timestamp_millis("ts_ms"), "event_id": F.col(POSITION)})
    return _as_messages(frame, F.lit(source), F.col("op"), image, image, F.pmod("id", F.lit(8)), keep)


def _as_messages(
    frame: DataFrame,
    source: Column,
    op: Column,
    before: Column,
    after: Column,
    partition: Column,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    payload = F.to_json(
        F.struct(
            F.when(op != "c", before).alias("before"),
            F.when(op != "d", after).alias("after"),
            op.alias("op"),
            F.col("ts_ms"),
            F.struct(F.lit("shop").alias("db"), source.alias("table")).alias("source"),
        )
    )
    return frame.select(
        F.concat(F.lit("cdc."), source).alias("topic"),
        partition.cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
        payload.cast("binary").alias("value"),
        *keep,
    )
