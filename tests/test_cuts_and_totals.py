"""One cut through several tables, totals by deltas, enrichment at event time,
and what a crash or another bucket count does to stored tables."""

import bisect
import json
import random

import pytest
from pyspark.sql import functions as F

from siltlake.operators.as_of import borders, enrich_as_of
from siltlake.operators.merge import LATE_IGNORED
from siltlake.operators.route import as_messages, route
from siltlake.plans import gold
from siltlake.plans.incremental import MARK, OrderMarts
from siltlake.plans.layers import append_bronze, merge_new_bronze, upsert_silver
from siltlake.plans.runs import low_watermark, run_silver, run_silver_to_cut
from siltlake.sources.envelope import parse_envelopes
from siltlake.spec import ORDERS, PRODUCTS, USERS
from siltlake.streaming import jobs
from siltlake.tables.files import Files
from siltlake.tables.store import ParquetState
import samples


def now():
    return F.lit("2024-03-01 00:00:00").cast("timestamp")


def user_rows(spark, rows):
    """(id, name, position) as bronze rows."""
    return spark.createDataFrame(
        [(i, n, "a@b", 0, 0, "u", p or 0, None, p, None) for i, n, p in rows],
        "id bigint, name string, email string, created_at bigint, updated_at bigint, op string, ts_ms bigint, "
        "processed_at timestamp, _position bigint, _corrupt_record string",
    ).withColumn("processed_at", now())


def order_rows(spark, rows):
    """(id, user, product, amount, day, op, time) as bronze rows."""
    return spark.createDataFrame(
        [(i, u, p, 1, a, "s", d * 86_400_000, 0, o, t, None, t, None) for i, u, p, a, d, o, t in rows],
        "id bigint, user_id bigint, product_id bigint, quantity int, total_amount double, status string, created_at bigint, "
        "updated_at bigint, op string, ts_ms bigint, processed_at timestamp, _position bigint, _corrupt_record string",
    ).withColumn("processed_at", now())


def names(lake):
    return {r["id"]: r["name"] for r in lake.silver(USERS).read().collect()}


# -- cuts -------------------------------------------------------------------------


def test_changes_wait_for_the_table_that_is_behind(spark, lake):
    specs = [USERS, ORDERS]
    order = lambda i, t: (i, 1, 1, 1.0, 0, "c", t)
    assert low_watermark(lake, specs) is None and run_silver_to_cut(lake, specs) is None
    append_bronze(lake.bronze(USERS), user_rows(spark, [(1, "a", 1), (2, "b", 5), (3, "c", 9), (4, "d", None)]), "u", 0)
    append_bronze(lake.bronze(ORDERS), order_rows(spark, [order(1, 2), order(2, 5)]), "o", 0)
    assert low_watermark(lake, specs) == 5
    assert run_silver_to_cut(lake, specs) == 5
    assert names(lake) == {1: "a", 4: "d"} and lake.silver(ORDERS).read().count() == 1
    assert lake.silver(USERS).held()["pending"] == {"u": 0}
    # Late rows of a new batch pass, held ones wait on; a batch that is behind moves nothing.
    append_bronze(lake.bronze(USERS), user_rows(spark, [(5, "e", 2), (1, "z", 12)]), "u", 1)
    assert run_silver_to_cut(lake, specs) == 5 and names(lake) == {1: "a", 4: "d", 5: "e"}
    append_bronze(lake.bronze(ORDERS), order_rows(spark, [order(3, 10)]), "o", 1)
    assert run_silver_to_cut(lake, specs) == 10 and names(lake) == {1: "a", 2: "b", 3: "c", 4: "d", 5: "e"}
    assert lake.silver(USERS).held()["pending"] == {"u": 1}
    assert run_silver_to_cut(lake, specs, heartbeats={"orders": 20}) == 12 and names(lake)[1] == "a"
    assert run_silver_to_cut(lake, specs, heartbeats={"orders": 20, "users": 20}) == 21 and names(lake)[1] == "z"
    run_silver(lake, specs)
    assert lake.silver(USERS).held()["pending"] == {} and lake.silver(ORDERS).read().count() == 3


def test_a_transaction_is_never_half_seen(spark, lake):
    """Transactions of one user and one order each, tables delivered unevenly."""
    rng, specs = random.Random(5), [USERS, ORDERS]
    sent = {"users": 0, "orders": 0}
    for number in range(5):
        for spec in specs:
            upto = min(40, sent[spec.name] + rng.randint(1, 12))
            ids = range(sent[spec.name], upto)
            rows = user_rows(spark, [(i, "n", i) for i in ids]) if spec is USERS else order_rows(spark, [(i, i, 1, 1.0, 0, "c", i) for i in ids])
            append_bronze(lake.bronze(spec), rows, "s", number)
            sent[spec.name] = upto
        run_silver_to_cut(lake, specs)
        users, orders = ({r["id"] for r in lake.silver(s).read().collect()} for s in specs)
        assert users == orders == set(range(min(sent.values()) - 1))


def test_a_merge_without_a_cut_lets_everything_pass(spark, lake):
    bronze, silver = lake.bronze(USERS), lake.silver(USERS)
    append_bronze(bronze, user_rows(spark, [(i, "a", i) for i in range(6)]), "s", 0)
    assert merge_new_bronze(bronze, silver, USERS, now(), cut=2) and silver.counts()[0] == 2
    assert not merge_new_bronze(bronze, silver, USERS, now(), cut=1)  # a cut never moves back
    assert merge_new_bronze(bronze, silver, USERS, now()) and silver.counts()[0] == 6
    assert not merge_new_bronze(bronze, silver, USERS, now())


# -- totals -----------------------------------------------------------------------


def mart(df, drop="refresh_date"):
    return sorted((tuple(str(x) for x in r) for r in df.drop(drop).collect()))


def test_totals_equal_marts_after_every_batch(spark, lake):
    rng = random.Random(2)
    spec = ORDERS.with_options(buckets=4)
    marts = OrderMarts(lake, spec)
    silver = lake.silver(spec)
    upsert_silver(silver, order_rows(spark, [(1, 1, 1, 10.0, 0, "c", 1)]), spec, now(), late_delete=LATE_IGNORED)
    for number in range(4):
        rows = [
            (rng.randint(1, 12), rng.choice([1, 2, 3, None]), rng.choice([1, 2, None]), rng.choice([1.25, 3.5, None, float("nan"), -2.0]),
             rng.randint(0, 2), rng.choice("cuud"), rng.randint(0, 99))
            for _ in range(8)
        ]
        upsert_silver(silver, order_rows(spark, rows), spec, now(), late_delete=LATE_IGNORED)
        marts.update()
        orders = silver.read()
        assert mart(marts.sales_summary(now())) == mart(gold.sales_summary(orders, now()))
        assert mart(marts.product_stats()) == mart(gold.product_order_stats(gold.active(orders)))
        assert mart(marts.user_totals().drop("avg_order_value")) == mart(gold.user_totals(orders).drop("avg_order_value"))
    assert silver.deltas_since(0).isEmpty()  # all readers have taken them


def test_only_touched_groups_are_rewritten_and_a_lost_update_is_made_up(spark, lake):
    marts, silver = OrderMarts(lake, ORDERS), lake.silver(ORDERS)
    day_of_id = lambda i: (i, i, i, 1.0, i, "c", 1)
    upsert_silver(silver, order_rows(spark, [day_of_id(i) for i in range(60)]), ORDERS, now())
    marts.update()
    assert marts.update() == dict.fromkeys(marts.update(), 0)
    upsert_silver(silver, order_rows(spark, [(7, 7, 7, 5.0, 7, "u", 2)]), ORDERS, now())
    marts.by_user.update()  # the others fail here; their deltas are still there
    assert marts.by_user.table.marks()[MARK] == silver.number() != marts.by_day_product.table.marks()[MARK]
    upsert_silver(silver, order_rows(spark, [(8, 8, 8, 6.0, 8, "d", 2)]), ORDERS, now())
    written = marts.update()
    assert written["totals_user"] == 1 and written["totals_day_product"] <= 2 and written["totals_day_customers"] == 1
    assert mart(marts.sales_summary(now())) == mart(gold.sales_summary(silver.read(), now()))
    refreshed = marts.refresh({"orders": ORDERS, "users": USERS, "products": PRODUCTS}, now())
    assert refreshed == {"sales_summary": 59}


# -- enrichment at event time -------------------------------------------------------


@pytest.mark.parametrize("hot_rows", [10**6, 25])
def test_as_of_against_a_search(spark, hot_rows):
    rng = random.Random(hot_rows)
    key = lambda: rng.choice([1] * 6 + [2, 3, None])
    versions = [(key(), rng.choice([None, *range(0, 200, 3)]), n, rng.choice("cuud"), f"v{n}") for n in range(150)]
    asked = [(n, key(), rng.choice([None, *range(-5, 205)])) for n in range(300)]
    history = spark.createDataFrame(versions, "id bigint, ts_ms bigint, _position bigint, op string, name string")
    events = spark.createDataFrame(asked, "n bigint, user bigint, t bigint")
    joined = enrich_as_of(events, history, F.col("user"), F.col("t"), ["name"], "u_", hot_rows=hot_rows)
    assert joined.columns == ["n", "user", "t", "u_name"]
    got = {r["n"]: r["u_name"] for r in joined.collect()}
    known = {}
    for i, t, p, op, name in sorted((v for v in versions if None not in v[:2]), key=lambda v: (v[1], v[2])):
        known.setdefault(i, []).append((t, None if op == "d" else name))
    for n, i, t in asked:
        place = bisect.bisect_right(known.get(i, []), t, key=lambda v: v[0]) if None not in (i, t) else 0
        assert got[n] == (known[i][place - 1][1] if place else None)
    cuts = borders(events.selectExpr("user AS _key", "t AS _at").dropna(), hot_rows)
    assert bool(cuts) == (hot_rows == 25)


def test_as_of_of_nothing(spark):
    history = spark.createDataFrame([], "id bigint, ts_ms bigint, _position bigint, op string, name string")
    events = spark.createDataFrame([(1, 2, 3)], "n bigint, user bigint, t bigint")
    assert enrich_as_of(events, history, F.col("user"), F.col("t"), ["name"], "u_").collect()[0]["u_name"] is None
    assert enrich_as_of(events.limit(0), history, F.col("user"), F.col("t"), ["name"], "u_").isEmpty()


# -- crashes, buckets, odd messages -------------------------------------------------


def test_a_batch_whose_writer_died_before_noting_it_is_written_again(spark, lake, monkeypatch):
    rows = user_rows(spark, [(1, "a", 1), (2, "b", 2)])
    jobs.apply_batch(lake, USERS, user_rows(spark, [(0, "z", 0)]), "s", 0)
    with monkeypatch.context() as patch:
        patch.setattr(Files, "write_json", lambda *_: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            jobs.apply_batch(lake, USERS, rows, "s", 1)
    bronze = lake.bronze(USERS)
    assert bronze.marks() == {"s": 0} and bronze.read().count() == 1 and not bronze.has_applied("s", 1)
    jobs.apply_batch(lake, USERS, rows, "s", 1)
    assert bronze.marks() == {"s": 1} and bronze.read().count() == bronze.counts()[0] == 3
    assert names(lake) == {0: "z", 1: "a", 2: "b"}


def test_another_bucket_count_is_refused_until_the_table_is_dealt_anew(spark, lake):
    more = USERS.with_options(buckets=64)
    rows = user_rows(spark, [(i, "a", i) for i in range(100)])
    upsert_silver(lake.silver(USERS), rows, USERS, now())
    with pytest.raises(ValueError, match="16 buckets"):
        upsert_silver(lake.silver(more), rows, more, now())
    lake.silver(more).rebucket(more)
    upsert_silver(lake.silver(more), rows, more, now())
    assert lake.silver(more).read().count() == lake.silver(more).counts()[0] == 100


ODD = ['"abc"', '{"id":1,"id":2}', "7", '{"id":1}']


def test_odd_images_do_not_stop_a_stream(spark, tmp_path):
    rows = [("cdc.users", 0, n, 0, '{"op":"c","after":%s,"source":{"table":"users"},"ts_ms":1}' % x) for n, x in enumerate(ODD)]
    samples.messages_frame(spark, rows).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(samples.messages_frame(spark, rows).schema).parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    jobs.route_to_files(parse_envelopes(stream), {"t": "source_table = 'users'"}, out, str(tmp_path / "c")).awaitTermination()
    found = [json.loads(r["value"]) for r in spark.read.schema("key string, value string, topic string").parquet(out).collect()]
    images = {r["offset"]: r["after_state"] for r in found}
    assert images[0] == "abc" and json.loads(json.dumps(images[1])) == '{"id":1,"id":2}' and images[2] == 7 and images[3] == {"id": 1}
    assert as_messages(route(parse_envelopes(samples.messages_frame(spark, rows)), {"t": "true"})).count() == 4


# -- the feed of a commit -----------------------------------------------------------


def fed_rows(table, number):
    return sorted((r["_sign"], r["id"], r["total_amount"], r["key_bucket"]) for r in table.deltas_since(number).collect())


def test_a_commit_feeds_changed_rows_only_and_from_one_pass(spark, lake, monkeypatch):
    """Each side is read once for rows and feed, the work is not held to as many
    tasks as there are buckets, and rows that stay as they were are not fed."""
    spec = ORDERS.with_options(buckets=2)
    table = lake.silver(spec)
    table.feed()
    order = lambda i, a, t, o="u": (i, i, 1, a, 0, o, t)
    upsert_silver(table, order_rows(spark, [order(i, 1.0, 5) for i in range(40)]), spec, now(), late_delete=LATE_IGNORED)
    assert [r[:3] for r in fed_rows(table, 0)] == [(1, i, 1.0) for i in range(40)]
    plans, write = [], ParquetState._write
    monkeypatch.setattr(ParquetState, "_write", lambda self, df: (plans.append(df._jdf.queryExecution().executedPlan().toString()), write(self, df))[1])
    batch = [order(7, 2.0, 9), order(8, 3.0, 1), order(50, 4.0, 1), order(9, 5.0, 8, "d")]  # 8 comes late
    upsert_silver(table, order_rows(spark, batch), spec, now(), late_delete=LATE_IGNORED)
    fed = fed_rows(table, 1)
    assert [r[:3] for r in fed] == [(-1, 7, 1.0), (-1, 9, 1.0), (1, 7, 2.0), (1, 9, 5.0), (1, 50, 4.0)]
    buckets = {r["id"]: r["key_bucket"] for r in table.read().collect()}
    assert len(buckets) == 41 == table.counts()[0] and all(buckets[i] == b for _, i, _, b in fed)
    assert len(plans) == 1 and plans[0].count("FileScan parquet") == 2
    assert "Exchange hashpartitioning(key_bucket" not in plans[0]
    table.forget_deltas(table.number())
    assert table.deltas_since(0).isEmpty() and table.read().count() == 41


def test_a_removed_row_is_fed_as_taken_out(spark, lake):
    table = lake.silver(ORDERS)
    table.feed()
    order = lambda i, a, o: (i, i, 1, a, 0, o, 1)
    upsert_silver(table, order_rows(spark, [order(1, 1.0, "c"), order(2, 2.0, "c")]), ORDERS, now(), delete_mode="hard")
    upsert_silver(table, order_rows(spark, [order(1, 1.0, "d"), order(3, 3.0, "d")]), ORDERS, now(), delete_mode="hard")
    assert [r[:3] for r in fed_rows(table, 1)] == [(-1, 1, 1.0)] and table.read().count() == 1
