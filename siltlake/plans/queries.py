"""Registered queries: every operator on the test tables, whole tables each.

Queries of stored or streamed tables land data derived from the test tables
in the shared scratch folder, run the real job on it and return what a reader
of the result sees.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltlake.functions import classes, values
from siltlake.operators import audit, quality
from siltlake.operators.as_of import enrich_as_of as join_as_of
from siltlake.operators.dedup import dedup_changes
from siltlake.operators.diff import diff_stored, snapshot_diff, write_snapshot
from siltlake.operators.enrich import enrich, enrich_table
from siltlake.operators.latest import latest_per_key, top_product_per_day
from siltlake.operators.profile import profile
from siltlake.operators.merge import HARD, LATE_IGNORED, SOFT, merge_changes, prepare_changes
from siltlake.operators.route import TABLE_ROUTES, as_messages, route
from siltlake.plans import feeds, gold
from siltlake.plans.incremental import OrderMarts
from siltlake.plans.lake import Lake
from siltlake.plans.layers import append_bronze, export_days, merge_new_bronze, state_at, upsert_silver
from siltlake.plans.runs import run_gold, run_silver, run_silver_to_cut
from siltlake.plans.seen import Seen, identity_of
from siltlake.plans.windows import LateWindows
from siltlake.session import scratch_path
from siltlake.sources import drift, flat
from siltlake.sources.envelope import parse_envelopes, unclaimed
from siltlake.spec import ARRIVAL, AUDIT, BUCKET, CELLS, CORRUPT, DAY, ORDERS, POSITION, PRODUCTS, REST, USERS, TableSpec
from siltlake.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]

# Fixed values used as parameters: a run instant, and the arrival day read by
# the day-slice query.
RUN_TS = "2024-03-01 00:00:00"
DAY_READ = "2024-01-15"

REGISTRY: dict[str, Query] = {}


def register(query: Query) -> Query:
    REGISTRY[query.__name__.removesuffix("_query")] = query
    return query


def _millis(name: str) -> Column:
    return F.unix_millis(F.col(name))


def _run_ts() -> Column:
    return F.lit(RUN_TS).cast("timestamp")


def _changes(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.order_changes(spark, sf).drop("in_order", "late")


def _silver(changes: DataFrame, spec: TableSpec) -> DataFrame:
    """Silver state of a history that is read in one batch."""
    return prepare_changes(changes, spec, _run_ts())


def _silver_users(spark: SparkSession, sf: str) -> DataFrame:
    return _silver(feeds.user_changes(spark, sf), USERS)


def _silver_products(spark: SparkSession, sf: str) -> DataFrame:
    return _silver(feeds.product_changes(spark, sf), PRODUCTS)


def _silver_orders(spark: SparkSession, sf: str) -> DataFrame:
    return _silver(_changes(spark, sf), ORDERS)


def _bronze_rows(df: DataFrame) -> DataFrame:
    """Bronze order rows without what depends on the clock."""
    return df.select(*[name for name, _ in ORDERS.landing_columns])


def _silver_rows(df: DataFrame) -> DataFrame:
    return df.drop(AUDIT, BUCKET, ARRIVAL)


def _lake(spark: SparkSession) -> Lake:
    return Lake(spark, scratch_path(spark, "lake"))


# -- sources and normalisation ---------------------------------------------


@register
def raw_json_read(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "raw")
    feeds.flat_records(feeds.order_changes(spark, sf)).write.json(path)
    changes = flat.read_changes(spark, path, ORDERS, _run_ts())
    return _bronze_rows(changes)


@register
def flat_normalise(spark: SparkSession, sf: str) -> DataFrame:
    return flat.rename_wire_columns(feeds.flat_records(_changes(spark, sf))).select(
        "id", "status", "total_amount", "op", "ts_ms"
    )


@register
def typed_projection(spark: SparkSession, sf: str) -> DataFrame:
    """Strings of good and bad form: quoted numbers, fractions, text, gaps."""
    events = feeds.events(spark, sf)
    kind = F.col("event_type")
    number = F.col("event_id").cast("string")
    raw = events.select(
        F.when(kind == "view", F.concat(number, F.lit(".0"))).otherwise(number).alias("id"),
        F.when(kind == "click", F.lit("unknown")).otherwise(F.col("user_id").cast("string")).alias("user_id"),
        F.when(kind == "signup", F.col("props")).otherwise(F.col("k").cast("string")).alias("product_id"),
        F.when(kind == "error", F.lit(None)).otherwise(F.col("k").cast("string")).alias("quantity"),
        F.when(kind == "purchase", F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("total_amount"),
        kind.alias("status"),
        F.col("op").alias("__op"),
        F.col("ts_ms").cast("string").alias("__ts_ms"),
    )
    return _bronze_rows(flat.normalise(raw, ORDERS, _run_ts()))


@register
def envelope_parse(spark: SparkSession, sf: str) -> DataFrame:
    parsed = parse_envelopes(feeds.messages(spark, sf))
    return parsed.select(
        "topic",
        "partition",
        "offset",
        "operation",
        *[
            F.get_json_object(f"{image}_state", f"$.{name}").alias(f"{image}_{name}")
            for image, name in (("before", "id"), ("after", "id"), ("after", "name"), ("after", "user_id"))
        ],
        "source_timestamp",
        "source_database",
        "source_table",
    )


@register
def routing_key(spark: SparkSession, sf: str) -> DataFrame:
    """Keys and delete flags, also where the table or operation is unknown."""
    events = feeds.events(spark, sf)
    op = F.when(F.col("event_type") != "click", F.col("op"))
    source = F.when(F.col("k") > 0, F.lit("orders"))
    return events.select(
        "event_id", classes.routing_key(source, op).alias("routing_key"), classes.is_delete(op).alias("is_delete")
    )


@register
def email_domain(spark: SparkSession, sf: str) -> DataFrame:
    users = feeds.user_changes(spark, sf)
    return users.select("id", "email", values.email_domain(F.col("email")).alias("email_domain"))


def _amounts(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.events(spark, sf).select(
        "event_id", F.when(F.col("event_type") != "error", F.col("value")).alias("amount")
    )


@register
def price_tier(spark: SparkSession, sf: str) -> DataFrame:
    amount = F.col("amount")
    return _amounts(spark, sf).select(
        "event_id",
        classes.price_tier(amount).alias("price_category"),
        classes.price_tier(amount, null_label="Unknown").alias("price_category_strict"),
    )


@register
def order_value_tier(spark: SparkSession, sf: str) -> DataFrame:
    return _amounts(spark, sf).select(
        "event_id", classes.order_value_tier(F.col("amount")).alias("order_value_category")
    )


@register
def active_flag(spark: SparkSession, sf: str) -> DataFrame:
    op = F.when(F.col("event_type") != "click", F.col("op"))
    return feeds.events(spark, sf).select("event_id", classes.is_active(op).alias("is_active"))


@register
def epoch_day_key(spark: SparkSession, sf: str) -> DataFrame:
    at = F.col("ts_ms")
    return feeds.events(spark, sf).select(
        "event_id", values.day_key(at).alias("day"), values.day_key(-at).alias("day_before_1970")
    )


@register
def quality_score(spark: SparkSession, sf: str) -> DataFrame:
    op = F.when(F.col("event_type") == "view", "r").when(F.col("event_type") != "click", F.col("op"))
    events = feeds.events(spark, sf).select("event_id", op.alias("operation"))
    return quality.score_events(events).select("event_id", "operation", "quality_score")


@register
def row_to_json(spark: SparkSession, sf: str) -> DataFrame:
    parsed = parse_envelopes(feeds.messages(spark, sf))
    routed = parsed.select(
        "topic", "partition", "offset", "operation", "source_table", "is_delete", F.get_json_object("after_state", "$.id").alias("id")
    ).withColumn("target_topic", F.lit("out"))
    return as_messages(routed)


# -- filters, audits and top rows ------------------------------------------


@register
def inserts_only(spark: SparkSession, sf: str) -> DataFrame:
    return _bronze_rows(_changes(spark, sf).filter(F.col("op") == "c"))


@register
def delete_alerts(spark: SparkSession, sf: str) -> DataFrame:
    alerts = quality.delete_alerts(parse_envelopes(feeds.messages(spark, sf)))
    return alerts.select(
        "source_table",
        "operation",
        F.get_json_object("deleted_record", "$.id").alias("deleted_id"),
        F.unix_micros("timestamp").alias("at_us"),
    )


@register
def active_count(spark: SparkSession, sf: str) -> DataFrame:
    return gold.active(_silver_orders(spark, sf)).agg(F.count(F.lit(1)).alias("active_rows"))


@register
def op_counts(spark: SparkSession, sf: str) -> DataFrame:
    return audit.op_counts(_changes(spark, sf))


def _histories(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {
        "users": feeds.user_changes(spark, sf),
        "products": feeds.product_changes(spark, sf),
        "orders": _changes(spark, sf),
    }


@register
def table_event_audit(spark: SparkSession, sf: str) -> DataFrame:
    return audit.table_event_audit(_histories(spark, sf))


@register
def recent_rows(spark: SparkSession, sf: str) -> DataFrame:
    parts = [
        audit.recent_rows(history, 20, tie=POSITION).select(
            F.lit(name).alias("table_name"), "id", "op", "ts_ms", _millis(ARRIVAL).alias("arrived_ms")
        )
        for name, history in _histories(spark, sf).items()
    ]
    return reduce(DataFrame.unionByName, parts)


@register
def recent_by_op(spark: SparkSession, sf: str) -> DataFrame:
    history = _changes(spark, sf)
    parts = [
        audit.recent_by_op(history, op, 10, ["id", "user_id", "op", "ts_ms", POSITION], tie=POSITION)
        for op in classes.KNOWN_OPS
    ]
    return reduce(DataFrame.unionByName, parts)


@register
def recent_rows_bounded(spark: SparkSession, sf: str) -> DataFrame:
    """The last rows to arrive, and the last of each operation, from a stored
    history of many days in two batches, of which the latest days are read."""
    changes, table = feeds.order_changes(spark, sf), _lake(spark).bronze(ORDERS)
    for number in (0, 1):
        append_bronze(table, feeds.batch_of(changes, "late", number), "s", number)
    columns = ["id", "op", "ts_ms", POSITION]
    parts = [audit.recent_rows_bounded(table, 20, tie=POSITION).select(F.lit("all").alias("kind"), *columns)]
    parts += [audit.recent_by_op_bounded(table, op, 10, [F.lit(op).alias("kind"), *columns], tie=POSITION) for op in classes.KNOWN_OPS]
    return reduce(DataFrame.unionByName, parts)


@register
def layer_counts(spark: SparkSession, sf: str) -> DataFrame:
    changes, orders = _changes(spark, sf), _silver_orders(spark, sf)
    return audit.layer_counts(
        {
            ("orders", "bronze"): changes,
            ("orders", "silver"): orders,
            ("user_analytics", "gold"): gold.user_analytics(_silver_users(spark, sf), orders, _run_ts()),
        }
    )


@register
def windowed_op_counts(spark: SparkSession, sf: str) -> DataFrame:
    events = feeds.events(spark, sf)
    tumbling = audit.windowed_op_counts(events, "ts", "1 hour")
    sliding = audit.windowed_op_counts(events, "ts", "2 hours", "30 minutes")
    named = [tumbling.withColumn("kind", F.lit("tumbling")), sliding.withColumn("kind", F.lit("sliding"))]
    return reduce(DataFrame.unionByName, named).select(
        "kind", _millis("window_start").alias("start_ms"), _millis("window_end").alias("end_ms"), "op", "cnt"
    )


@register
def windowed_counts_late(spark: SparkSession, sf: str) -> DataFrame:
    """Events in three batches that all hold early and late ones; two are settled
    before the last one comes."""
    lake, path = _lake(spark), scratch_path(spark, "landing")
    events = feeds.events(spark, sf).select("event_id", "ts", "op")
    kinds = {"tumbling": ("1 hour", None), "sliding": ("2 hours", "30 minutes")}
    counts = {kind: LateWindows(lake, kind, "ts", *width, buckets=4) for kind, width in kinds.items()}
    checkpoints = {kind: scratch_path(spark, "checkpoint") for kind in kinds}
    for number in (2, 0, 1):
        events.filter(F.pmod(F.xxhash64("event_id"), F.lit(3)) == number).write.mode("append").parquet(path)
        stream = spark.readStream.schema(events.schema).parquet(path)
        for kind, window in counts.items():
            window.count(stream, checkpoints[kind]).awaitTermination()
            if number == 0:
                window.settle()
    named = [window.read().withColumn("kind", F.lit(kind)) for kind, window in counts.items()]
    return reduce(DataFrame.unionByName, named).select(
        "kind", _millis("window_start").alias("start_ms"), _millis("window_end").alias("end_ms"), "op", "cnt"
    )


@register
def batch_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Profiles of two batches of orders, a third of the amounts unknown in one."""
    changes = feeds.order_changes(spark, sf)
    gaps = (F.col("late") == 1) & (F.col(POSITION) % 3 == 0)
    rows = changes.withColumn("total_amount", F.when(~gaps, F.col("total_amount")))
    found = profile(rows, ["total_amount", "quantity", "status"], ["late"])
    return found.select(F.col("late").alias("batch"), "column", "rows", "nulls", "low", "high")


@register
def quality_gate_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """A history with unreadable rows, missing keys and an unknown operation, and
    the messages that no table of it takes."""
    kind = F.col("status")
    history = _changes(spark, sf).withColumns(
        {
            "id": F.when(F.col("product_id") > 0, F.col("id")),
            "op": F.when(kind == "view", "r").when(kind == "click", F.lit(None)).otherwise(F.col("op")),
            CORRUPT: F.when(F.col("total_amount") < 1, F.lit("{")),
        }
    )
    quarantine = parse_envelopes(feeds.messages(spark, sf), keep_text=True).filter(unclaimed([ORDERS]))
    return quality.gate_metrics(history, quarantine=quarantine)


# -- joins ------------------------------------------------------------------


def _enriched(spark: SparkSession, sf: str, table: str, reference: DataFrame) -> DataFrame:
    events = parse_envelopes(feeds.messages(spark, sf))
    return enrich_table(events, reference, table, {"orders": ORDERS.foreign_keys[table]})


@register
def enrich_users(spark: SparkSession, sf: str) -> DataFrame:
    return _enriched(spark, sf, "users", _silver_users(spark, sf)).select(
        "offset", "source_table", "operation", "users_name", "users_email"
    )


@register
def enrich_products(spark: SparkSession, sf: str) -> DataFrame:
    return _enriched(spark, sf, "products", _silver_products(spark, sf)).select(
        "offset", "source_table", "operation", "products_name", "products_category", "products_price"
    )


@register
def enrich_changelog(spark: SparkSession, sf: str) -> DataFrame:
    """New orders with the department their user has now."""
    customers = feeds.table(spark, sf, "customer")
    changelog = feeds.user_changes(spark, sf).join(
        customers.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("department")), "id"
    )
    current = latest_per_key(changelog)
    inserts = _changes(spark, sf).filter(F.col("op") == "c")
    joined = enrich(inserts, current, F.col("user_id"), ["name", "department"], "current_")
    return joined.select(POSITION, "id", "user_id", "current_name", "current_department")


@register
def enrich_as_of(spark: SparkSession, sf: str) -> DataFrame:
    """Clicks and purchases with what their user had last done at that time."""
    changes = _changes(spark, sf)
    acts = F.col("status").isin("click", "purchase")
    history = changes.filter(~acts).select("user_id", "status", "total_amount", "op", "ts_ms", POSITION)
    joined = join_as_of(
        changes.filter(acts), history, F.col("user_id"), F.col("ts_ms"), ["status", "total_amount"], "user_", "user_id"
    )
    return joined.select(POSITION, "id", "user_id", "ts_ms", "user_status", "user_total_amount")


# -- aggregates and marts ----------------------------------------------------


@register
def user_order_stats(spark: SparkSession, sf: str) -> DataFrame:
    return gold.user_order_stats(_silver_orders(spark, sf))


@register
def product_order_stats(spark: SparkSession, sf: str) -> DataFrame:
    return gold.product_order_stats(_silver_orders(spark, sf))


@register
def daily_sales(spark: SparkSession, sf: str) -> DataFrame:
    return gold.daily_sales(_silver_orders(spark, sf))


@register
def daily_product_revenue(spark: SparkSession, sf: str) -> DataFrame:
    return gold.daily_product_revenue(_silver_orders(spark, sf))


@register
def top_product_per_day_query(spark: SparkSession, sf: str) -> DataFrame:
    return top_product_per_day(gold.daily_product_revenue(_silver_orders(spark, sf)))




def _user_analytics(spark: SparkSession, sf: str) -> DataFrame:
    return gold.user_analytics(_silver_users(spark, sf), _silver_orders(spark, sf), _run_ts())


@register
def gold_user_analytics(spark: SparkSession, sf: str) -> DataFrame:
    mart = _user_analytics(spark, sf).drop("refresh_date")
    return mart.withColumn("last_activity", _millis("last_activity"))


@register
def gold_product_analytics(spark: SparkSession, sf: str) -> DataFrame:
    mart = gold.product_analytics(_silver_products(spark, sf), _silver_orders(spark, sf), _run_ts())
    return mart.drop("refresh_date")


@register
def gold_sales_summary(spark: SparkSession, sf: str) -> DataFrame:
    return gold.sales_summary(_silver_orders(spark, sf), _run_ts()).drop("refresh_date")


@register
def gold_user_value_tiers(spark: SparkSession, sf: str) -> DataFrame:
    return gold.user_stats(_silver_users(spark, sf), _silver_orders(spark, sf))


@register
def gold_replace_idempotent(spark: SparkSession, sf: str) -> DataFrame:
    """The daily mart, written twice."""
    table = _lake(spark).gold("sales_summary")
    mart = gold.sales_summary(_silver_orders(spark, sf), _run_ts())
    table.replace(mart)
    table.replace(mart)
    return table.read().drop("refresh_date")


# -- latest state and merge ---------------------------------------------------


@register
def latest_per_key_query(spark: SparkSession, sf: str) -> DataFrame:
    return _bronze_rows(latest_per_key(_changes(spark, sf)))




def _merged(spark: SparkSession, sf: str, split: str, delete_mode: str = SOFT) -> DataFrame:
    """Batch 0 merged into an empty table, then batch 1 into the result."""
    changes = feeds.order_changes(spark, sf)
    first = prepare_changes(feeds.batch_of(changes, split, 0), ORDERS, _run_ts())
    if delete_mode == HARD:
        first = first.filter(~F.col("op").eqNullSafe("d"))
    return merge_changes(first, feeds.batch_of(changes, split, 1), ORDERS, _run_ts(), delete_mode)


@register
def silver_merge_insert(spark: SparkSession, sf: str) -> DataFrame:
    """All changes in one batch into an empty table, tombstones included."""
    empty = spark.createDataFrame([], ORDERS.silver_schema())
    return _silver_rows(merge_changes(empty, _changes(spark, sf), ORDERS, _run_ts()))


@register
def silver_merge_update(spark: SparkSession, sf: str) -> DataFrame:
    return _silver_rows(_merged(spark, sf, "in_order"))


@register
def silver_merge_late(spark: SparkSession, sf: str) -> DataFrame:
    return _silver_rows(_merged(spark, sf, "late"))


@register
def silver_merge_hard_delete(spark: SparkSession, sf: str) -> DataFrame:
    return _silver_rows(_merged(spark, sf, "late", HARD))


def _snapshots(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, Column]:
    """Live users by their last event, at mid month and at the end of it."""
    events = feeds.events(spark, sf).select(
        F.col("user_id").alias("id"),
        F.col("event_type").alias("status"),
        "value",
        "op",
        "ts_ms",
        F.col("event_id").alias(POSITION),
    )
    half = F.unix_millis(F.lit("2024-01-16 00:00:00").cast("timestamp"))

    def snapshot(upto: DataFrame) -> DataFrame:
        return latest_per_key(upto).filter(F.col("op") != "d").select("id", "status", "value")

    return snapshot(events.filter(F.col("ts_ms") < half)), snapshot(events), half


@register
def snapshot_diff_query(spark: SparkSession, sf: str) -> DataFrame:
    before, after, half = _snapshots(spark, sf)
    return snapshot_diff(before, after, "id", half).select("id", "status", "value", "op")


@register
def snapshot_diff_digest(spark: SparkSession, sf: str) -> DataFrame:
    """The same from stored snapshots, by digests of key ranges."""
    before, after, half = _snapshots(spark, sf)
    paths = [scratch_path(spark, "snapshot") for _ in range(2)]
    for rows, path in zip((before, after), paths):
        write_snapshot(rows, path, "id", 256)
    return diff_stored(spark, *paths, "id", half).select("id", "status", "value", "op")


def _same_instant(spark: SparkSession, sf: str, positions: bool) -> DataFrame:
    """All events as changes of their users, at the full hour, as flat records
    with or without the position in the source's log."""
    hour = F.unix_millis(F.date_trunc("hour", "ts"))
    source = F.to_json(F.struct(F.col("event_id").alias("lsn")))
    events = feeds.events(spark, sf).withColumn("hour_ms", hour)
    raw = events.select(
        F.col("user_id").cast("string").alias("id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.col("k").cast("string").alias("product_id"),
        (F.col("k") % 5 + 1).cast("string").alias("quantity"),
        F.col("value").cast("string").alias("total_amount"),
        F.col("event_type").alias("status"),
        F.col("hour_ms").cast("string").alias("created_at"),
        F.col("hour_ms").cast("string").alias("updated_at"),
        F.col("op").alias("__op"),
        F.col("hour_ms").cast("string").alias("__ts_ms"),
        F.when(F.lit(positions), source).alias(flat.SOURCE),
        (F.col("event_id") % 2).alias("part"),
    )
    return raw


def _instant_rows(merged: DataFrame, positions: bool) -> DataFrame:
    return _silver_rows(merged).withColumn("positions", F.lit(positions))


@register
def flat_same_instant(spark: SparkSession, sf: str) -> DataFrame:
    """Many changes of one key at one instant, in one batch."""
    parts = []
    for positions in (True, False):
        changes = flat.normalise(_same_instant(spark, sf, positions), ORDERS, _run_ts())
        parts.append(_instant_rows(prepare_changes(changes, ORDERS, _run_ts()), positions))
    return reduce(DataFrame.unionByName, parts)


@register
def flat_same_instant_split(spark: SparkSession, sf: str) -> DataFrame:
    """The same in two batches that share their instants, the later one first."""
    parts = []
    for positions in (True, False):
        raw = _same_instant(spark, sf, positions)
        state = spark.createDataFrame([], ORDERS.silver_schema())
        for part in (1, 0):
            changes = flat.normalise(raw.filter(F.col("part") == part), ORDERS, _run_ts())
            state = merge_changes(state, changes, ORDERS, _run_ts(), late_delete=LATE_IGNORED)
        parts.append(_instant_rows(state, positions))
    return reduce(DataFrame.unionByName, parts)


# -- stored tables --------------------------------------------------------------


@register
def bronze_append(spark: SparkSession, sf: str) -> DataFrame:
    """Two appends, the second with a column the first did not have."""
    changes = feeds.order_changes(spark, sf)
    table = _lake(spark).bronze(ORDERS)
    append_bronze(table, feeds.batch_of(changes, "late", 0))
    append_bronze(table, feeds.batch_of(changes, "late", 1).withColumn("channel", F.upper("status")))
    rows = table.read()
    return rows.select(*[name for name, _ in ORDERS.landing_columns], POSITION, "channel", DAY)


@register
def bronze_day_slice(spark: SparkSession, sf: str) -> DataFrame:
    table = _lake(spark).bronze(ORDERS)
    append_bronze(table, _changes(spark, sf))
    return _bronze_rows(table.read().filter(F.col(DAY) == DAY_READ))


@register
def bronze_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """A history that was delivered twice, the second time a day later."""
    changes = _changes(spark, sf).withColumn("source_table", F.lit("orders"))
    again = changes.withColumn(ARRIVAL, F.col(ARRIVAL) + F.expr("INTERVAL 1 DAY"))
    once = dedup_changes(changes.unionByName(again))
    return once.select("id", "op", "ts_ms", _millis(ARRIVAL).alias("arrived_ms"))


@register
def dedup_any_age(spark: SparkSession, sf: str) -> DataFrame:
    """A history of 32 batches, one a day, of which the last two repeat all rows of
    the first two, 30 batches later."""
    changes, table = _changes(spark, sf), _lake(spark).bronze(ORDERS)
    seen = Seen(table, identity_of(ORDERS, positions=True), fan=2)
    number = F.col(POSITION) % 32
    for n in range(32):
        rows = changes.filter((number == n) | (number == n - 30))
        came = rows.withColumn(ARRIVAL, _run_ts() + F.expr(f"INTERVAL {n} DAYS"))
        if 2 <= n < 30:
            append_bronze(table, came, "s", n)
        else:
            seen.append_unseen(came, "s", n)
    return table.read().select(*[name for name, _ in ORDERS.landing_columns], POSITION, _millis(ARRIVAL).alias("arrived_ms"))


@register
def raw_archive_counts(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "archive")
    changes = _changes(spark, sf)
    flat.archive_raw(feeds.flat_records(changes), F.timestamp_millis("__ts_ms"), path)
    schema = "id BIGINT, __op STRING, __ts_ms BIGINT, year STRING, month STRING, day STRING"
    archived = spark.read.schema(schema).json(path)
    return archived.groupBy("year", "month", "day").agg(
        F.count(F.lit(1)).alias("cnt"), F.count_if(F.col("__op") == "d").alias("deletes")
    )


@register
def bronze_export_days(spark: SparkSession, sf: str) -> DataFrame:
    """Two batches, written once more by day."""
    changes = feeds.order_changes(spark, sf)
    table, path = _lake(spark).bronze(ORDERS), scratch_path(spark, "days")
    for number in (0, 1):
        append_bronze(table, feeds.batch_of(changes, "late", number))
    export_days(table, path)
    return _bronze_rows(spark.read.schema(table.schema()).parquet(path))


@register
def silver_state_at(spark: SparkSession, sf: str) -> DataFrame:
    """Silver as it was after the first of two batches, from the history."""
    changes = feeds.order_changes(spark, sf)
    table = _lake(spark).bronze(ORDERS)
    for number in (0, 1):
        append_bronze(table, feeds.batch_of(changes, "late", number), "s", number)
    return _silver_rows(state_at(table, ORDERS, {"s": 0}, _run_ts()))


@register
def silver_table_late(spark: SparkSession, sf: str) -> DataFrame:
    """The late merge through the stored table, committed batch by batch."""
    changes = feeds.order_changes(spark, sf)
    table = _lake(spark).silver(ORDERS)
    for number in (0, 1):
        upsert_silver(table, feeds.batch_of(changes, "late", number), ORDERS, _run_ts())
    return _silver_rows(table.read())


@register
def silver_from_bronze(spark: SparkSession, sf: str) -> DataFrame:
    """Two bronze appends, merged into silver in one step."""
    changes = feeds.order_changes(spark, sf)
    lake = _lake(spark)
    for number in (0, 1):
        append_bronze(lake.bronze(ORDERS), feeds.batch_of(changes, "late", number))
    merge_new_bronze(lake.bronze(ORDERS), lake.silver(ORDERS), ORDERS, _run_ts())
    return _silver_rows(lake.silver(ORDERS).read())


# Fixed value: what stands for a value that the source left out.
LEFT_OUT = "__unchanged_value"


@register
def silver_partial_images(spark: SparkSession, sf: str) -> DataFrame:
    """Order changes of which every third amount, status and product was left
    out, merged in two late batches, the later one first."""
    spec = ORDERS.with_options(placeholder=LEFT_OUT)
    gaps = {"total_amount": 0, "status": 1, "product_id": 2}

    def sent(name: str) -> Column:
        text = F.col(name).cast("string")
        return F.when(F.col(POSITION) % 3 == gaps[name], F.lit(LEFT_OUT)).otherwise(text) if name in gaps else text

    source = F.to_json(F.struct(F.col(POSITION).alias("lsn"))).alias(flat.SOURCE)
    changes = feeds.order_changes(spark, sf)
    records = flat.rename_wire_columns(changes.select(*[sent(n).alias(n) for n, _ in ORDERS.landing_columns], source, "late"))
    table = _lake(spark).silver(spec)
    for number in (1, 0):
        batch = flat.normalise(records.filter(F.col("late") == number), spec, _run_ts())
        upsert_silver(table, batch, spec, _run_ts())
    return _silver_rows(table.read()).drop(CELLS)


@register
def drift_capture(spark: SparkSession, sf: str) -> DataFrame:
    """Files of three kinds: as declared, with whole scores, with fractions, nested
    notes and a rare field. Fields that are frequent become columns."""
    lake, checkpoint, path = _lake(spark), scratch_path(spark, "checkpoint"), scratch_path(spark, "raw")
    spec = ORDERS.with_options(capture=True)
    changes = feeds.order_changes(spark, sf)
    kind, k = F.col(POSITION) % 3, F.col("product_id")
    extra = {
        0: [],
        1: [F.upper("status").alias("channel"), k.alias("score"), (k > 5).alias("flag"), k.alias("note")],
        2: [
            F.upper("status").alias("channel"),
            (k + 0.5).alias("score"),
            F.struct(k.alias("k")).alias("note"),
            F.when(F.col(POSITION) % 3000 == 2, k).alias("rare"),
        ],
    }
    plain = [F.col(name) for name, _ in ORDERS.landing_columns]
    for number, columns in extra.items():
        rows = changes.filter(kind == number).select(*plain, *columns)
        flat.rename_wire_columns(rows).withColumnsRenamed({"op": "__op", "ts_ms": "__ts_ms"}).write.mode("append").json(path)
        jobs.ingest_bronze(lake, spec, path, checkpoint).awaitTermination()
    history = lake.bronze(spec).read()
    wider = drift.promote(spec, drift.profile(history), lake.bronze(spec).counts()[0], drift.Promotion(least_share=0.1))
    rows = drift.with_promoted(history, wider)
    names = [name for name, _ in (*ORDERS.landing_columns, *wider.promoted)]
    return rows.select(*names, F.array_join(F.array_sort(F.map_keys(REST)), ",").alias("kept"))


def _shared_log(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Each event as a transaction that changes a user and an order."""
    changes = feeds.order_changes(spark, sf)
    users = changes.select(
        F.col("user_id").alias("id"),
        F.concat(F.lit("seen-"), POSITION).alias("name"),
        F.concat(F.lit("u@"), "status").alias("email"),
        *["created_at", "updated_at", F.lit("u").alias("op"), "ts_ms", ARRIVAL, POSITION, CORRUPT],
    )
    return {"users": users, "orders": changes.drop("in_order", "late")}


@register
def gold_consistent_cut(spark: SparkSession, sf: str) -> DataFrame:
    """Marts while the intake of users is behind that of orders, and after it has
    caught up; positions are shared, so each mart sees whole transactions."""
    lake, log = _lake(spark), _shared_log(spark, sf)
    specs = [USERS, ORDERS]
    n = log["orders"].count()
    bounds = {"users": [(0, n // 2), (n // 2, n)], "orders": [(0, n * 3 // 4), (n * 3 // 4, n)]}
    parts = []
    for phase in (0, 1):
        for spec in specs:
            low, high = bounds[spec.name][phase]
            rows = log[spec.name].filter((F.col(POSITION) >= low) & (F.col(POSITION) < high))
            append_bronze(lake.bronze(spec), rows, "s", phase)
        run_silver_to_cut(lake, specs, late_delete=LATE_IGNORED)
        if phase:  # the source has nothing after the last position
            run_silver(lake, specs, late_delete=LATE_IGNORED)
        users, orders = (lake.silver(spec).read() for spec in specs)
        stats = gold.user_stats(users, orders).withColumn("phase", F.lit(phase))
        path = scratch_path(spark, "cut")
        stats.write.parquet(path)
        parts.append(spark.read.schema(stats.schema).parquet(path))
    return reduce(DataFrame.unionByName, parts)


@register
def gold_incremental_equals_full(spark: SparkSession, sf: str) -> DataFrame:
    """Ten batches of orders, with late ones and deletes, merged one after the other;
    totals take the deltas of each."""
    lake = _lake(spark)
    spec = ORDERS.with_options(buckets=4)
    marts, changes = OrderMarts(lake, spec), _changes(spark, sf)
    batch = F.pmod(F.xxhash64(POSITION), F.lit(10))
    for number in range(10):
        upsert_silver(lake.silver(spec), changes.filter(batch == number), spec, _run_ts(), late_delete=LATE_IGNORED)
        marts.update()
    text = lambda name: F.col(name).cast("string").alias("key")
    value = ["total_orders", "total_revenue", "unique_customers"]
    days = marts.sales_summary(_run_ts()).select(F.lit("day").alias("kind"), text("date_key"), *value, "avg_order_value", "top_product")
    nothing = [F.lit(None).cast("double").alias("avg_order_value"), F.lit(None).cast("bigint").alias("top_product")]
    products = marts.product_stats().select(F.lit("product").alias("kind"), text("product_id"), *value, *nothing)
    users = marts.user_totals().filter("total_orders > 0").select(
        F.lit("user").alias("kind"), text("user_id"), "total_orders", F.col("total_spent").alias("total_revenue"),
        F.col("all_orders").alias("unique_customers"), "avg_order_value", F.lit(None).cast("bigint").alias("top_product"),
    )
    return days.unionByName(products).unionByName(users)


# -- streams ---------------------------------------------------------------------


def _deliver(spark: SparkSession, frame: DataFrame, split: str, run: Callable[[DataFrame], object]) -> None:
    """Land batch 0 and run the stream, land batch 1 and run it again from its
    checkpoint."""
    path = scratch_path(spark, "landing")
    schema = frame.drop("in_order", "late").schema
    for number in (0, 1):
        feeds.batch_of(frame, split, number).write.mode("append").parquet(path)
        run(spark.readStream.schema(schema).parquet(path)).awaitTermination()


def _split_messages(spark: SparkSession, sf: str) -> DataFrame:
    first = F.col("offset") % 4 < 2
    return feeds.messages(spark, sf).withColumns(
        {"in_order": F.when(first, 0).otherwise(1), "late": F.when(first, 1).otherwise(0)}
    )


@register
def stream_source_replay(spark: SparkSession, sf: str) -> DataFrame:
    lake, checkpoint = _lake(spark), scratch_path(spark, "checkpoint")
    frame = _split_messages(spark, sf)
    table = lake.history("messages", frame.drop("in_order", "late").schema)
    _deliver(spark, frame, "in_order", lambda s: jobs.append_stream(s, table, checkpoint))
    return table.read().select("topic", "partition", "offset")


@register
def stream_parse_equals_batch(spark: SparkSession, sf: str) -> DataFrame:
    lake, checkpoint = _lake(spark), scratch_path(spark, "checkpoint")
    frame = _split_messages(spark, sf)
    table = lake.history("events", parse_envelopes(frame).schema)
    _deliver(spark, frame, "in_order", lambda s: jobs.append_stream(parse_envelopes(s), table, checkpoint))
    return table.read().select(
        "topic", "offset", "operation", "source_timestamp", "source_table", "routing_key", "is_delete"
    )


@register
def stream_bronze_equals_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Flat JSON files through the streaming intake into bronze."""
    lake, checkpoint, path = _lake(spark), scratch_path(spark, "checkpoint"), scratch_path(spark, "raw")
    changes = feeds.order_changes(spark, sf)
    for number in (0, 1):
        records = feeds.flat_records(feeds.batch_of(changes, "late", number))
        records.write.mode("append").json(path)
        jobs.ingest_bronze(lake, ORDERS, path, checkpoint).awaitTermination()
    return _bronze_rows(lake.bronze(ORDERS).read())


@register
def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Each message is delivered twice, in two batches and with a new offset."""
    lake, checkpoint, path = _lake(spark), scratch_path(spark, "checkpoint"), scratch_path(spark, "landing")
    messages = feeds.order_messages(spark, sf).drop("in_order", "late")
    for shift in (0, 1_000_000_000):
        messages.withColumn("offset", F.col("offset") + shift).write.mode("append").parquet(path)
        stream = spark.readStream.schema(messages.schema).parquet(path)
        query = jobs.ingest_messages(lake, stream, checkpoint, [ORDERS], dedup_delay="1 day", merge_each_batch=False)
        query.awaitTermination()
    return _bronze_rows(lake.bronze(ORDERS).read())


@register
def stream_merge_equals_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Late batches through bronze into silver; with late deletes ignored the
    result does not depend on how the changes were split."""
    lake, checkpoint = _lake(spark), scratch_path(spark, "checkpoint")

    def run(stream: DataFrame):
        return jobs.ingest_messages(lake, stream, checkpoint, [ORDERS], late_delete=LATE_IGNORED)

    _deliver(spark, feeds.order_messages(spark, sf), "late", run)
    return _silver_rows(lake.silver(ORDERS).read())


@register
def pipeline_user_analytics(spark: SparkSession, sf: str) -> DataFrame:
    """Messages of all three tables through bronze and silver into the marts."""
    lake, path = _lake(spark), scratch_path(spark, "landing")
    feed = {
        "users": feeds.user_changes(spark, sf),
        "products": feeds.product_changes(spark, sf),
        "orders": _changes(spark, sf),
    }
    for name, changes in feed.items():
        feeds.change_messages(changes, name).write.mode("append").parquet(path)
    stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    jobs.ingest_messages(lake, stream, scratch_path(spark, "checkpoint")).awaitTermination()
    run_gold(lake)
    return lake.gold("user_analytics").read().drop("refresh_date", "last_activity")


@register
def route_events(spark: SparkSession, sf: str) -> DataFrame:
    """Routed stream files; deletes go to two topics."""
    checkpoint, out = scratch_path(spark, "checkpoint"), scratch_path(spark, "routed")
    routes = {**TABLE_ROUTES, "alerts.deletes": "is_delete"}
    frame = _split_messages(spark, sf)
    _deliver(
        spark, frame, "in_order", lambda s: jobs.route_to_files(parse_envelopes(s), routes, out, checkpoint)
    )
    routed = spark.read.schema("key STRING, value STRING, topic STRING").parquet(out)
    return routed.select(
        "topic",
        "key",
        F.get_json_object("value", "$.offset").cast("bigint").alias("offset"),
        F.get_json_object("value", "$.routing_key").alias("routing_key"),
    )


@register
def route_events_batch(spark: SparkSession, sf: str) -> DataFrame:
    routes = {**TABLE_ROUTES, "alerts.deletes": "is_delete"}
    routed = route(parse_envelopes(feeds.messages(spark, sf)), routes)
    return routed.select(F.col("target_topic").alias("topic"), F.col("topic").alias("key"), "offset", "routing_key")
