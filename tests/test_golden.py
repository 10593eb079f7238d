"""The sample feed end to end, against results worked out by hand."""

import pytest
from pyspark.sql import functions as F

import samples
from siltlake.operators import audit
from siltlake.plans.runs import bronze_day, check_quality, run_cdc, run_gold
from siltlake.spec import ORDERS, PRODUCTS, SPECS, USERS
from siltlake.streaming.jobs import ingest_messages


def rows(df, *columns, key):
    return [tuple(r) for r in df.select(*columns).orderBy(key).collect()]


def check_layers(lake):
    users = lake.silver(USERS).read()
    assert rows(users, "id", "name", "email_domain", "is_active", "op", "ts_ms", key="id") == [
        (1, "John Doe Updated", "example.com", True, "u", samples.B + 8000),
        (2, "Jane Smith", "example.com", True, "c", samples.B + 1000),
        (3, "Bob Johnson", "company.com", True, "c", samples.B + 2000),
        (4, "Alice Williams", "test.com", True, "c", samples.B + 3000),
        (5, "Charlie Brown", "example.com", False, "d", samples.B + 9000),
    ]
    products = lake.silver(PRODUCTS).read()
    assert rows(products, "name", "price_category", key="id") == [
        ("Laptop", "High"),
        ("Phone", "High"),
        ("Desk", "High"),
        ("Chair", "Medium"),
        ("Headphones", "Medium"),
    ]
    orders = lake.silver(ORDERS).read()
    assert [r[0] for r in rows(orders, "order_value_category", key="id")] == [
        "Large",
        "Large",
        "Medium",
        "Medium",
        "Medium",
    ]


def check_marts(lake):
    users = lake.gold("user_analytics").read()
    assert rows(users, "user_id", "total_orders", "total_spent", "avg_order_value", "user_segment", key="user_id") == [
        (1, 2, 1299.97, 649.985, "Premium"),
        (2, 1, 1399.98, 1399.98, "Premium"),
        (3, 1, 299.99, 299.99, "New"),
        (4, 1, 199.99, 199.99, "New"),
    ]
    products = lake.gold("product_analytics").read()
    assert rows(
        products, "product_id", "total_orders", "total_revenue", "unique_customers", "performance_category",
        key="product_id",
    ) == [
        (1, 1, 999.99, 1, "Average"),
        (2, 1, 1399.98, 1, "Good"),
        (3, 1, 299.99, 1, "Average"),
        (4, 1, 299.98, 1, "Average"),
        (5, 1, 199.99, 1, "Average"),
    ]
    days = lake.gold("sales_summary").read().drop("refresh_date")
    assert [tuple(r) for r in days.collect()] == [("2024-01-23", 5, 3199.93, 639.986, 4, 2)]


@pytest.fixture
def folders(tmp_path):
    return tmp_path / "raw", str(tmp_path / "checkpoint")


def test_files_to_marts(spark, lake, folders):
    raw, checkpoint = folders
    samples.land_feed(raw)
    assert run_cdc(lake, str(raw), checkpoint) == {"users": None, "products": None, "orders": None}
    check_layers(lake)
    written = run_gold(lake)
    assert written == {"user_analytics": 4, "product_analytics": 5, "sales_summary": 1, "user_stats": 4}
    check_marts(lake)

    lake.register_views()
    counts = spark.sql("SELECT op, COUNT(*) AS cnt FROM bronze_users GROUP BY op ORDER BY cnt DESC, op").collect()
    assert [tuple(r) for r in counts] == [("c", 5), ("d", 1), ("u", 1)]
    histories = {spec.name: lake.bronze(spec).read() for spec in SPECS.values()}
    found = {r[0]: tuple(r)[1:] for r in audit.table_event_audit(histories).collect()}
    assert found == {"users": (7, 5, 1, 1), "products": (5, 5, 0, 0), "orders": (5, 5, 0, 0)}
    metrics = check_quality(lake)
    assert metrics["users"]["rows"] == 7 and metrics["users"]["corrupt_rows"] == 0
    day = histories["users"].agg(F.max("processed_day")).first()[0]
    assert bronze_day(lake, USERS, day).count() == 7
    assert bronze_day(lake, USERS, "1999-01-01").count() == 0


def test_rerun_adds_nothing_and_next_file_is_merged(spark, lake, folders):
    raw, checkpoint = folders
    samples.land_feed(raw)
    run_cdc(lake, str(raw), checkpoint)
    marks = lake.bronze(USERS).marks()
    run_cdc(lake, str(raw), checkpoint)
    assert lake.bronze(USERS).marks() == marks
    assert lake.bronze(USERS).read().count() == 7

    samples.land(raw, "users", "more.json", [samples._user(2, "Jane Jones", "jane@example.com", 20000, "u", 1000)])
    run_cdc(lake, str(raw), checkpoint)
    assert lake.bronze(USERS).read().count() == 8
    assert lake.silver(USERS).read().filter("id = 2").first()["name"] == "Jane Jones"
    audited = lake.run_audit().read().filter("table_name = 'users' AND layer = 'silver'")
    assert sorted(r["active_rows"] for r in audited.collect()) == [4, 4, 4]
    assert sorted(r["row_count"] for r in audited.collect()) == [5, 5, 5]
    bronze = lake.run_audit().read().filter("table_name = 'users' AND layer = 'bronze'")
    assert sorted(r["row_count"] for r in bronze.collect()) == [7, 7, 8]


def test_enveloped_feed_gives_the_same_tables(spark, lake, tmp_path):
    rows = [r for table, records in samples.FEED.items() for r in samples.envelopes(table, records)]
    rows += [
        ("cdc.users", 0, 90, samples.B, "{not json"),
        ("cdc.users", 0, 91, samples.B, None),
        ("cdc.other", 0, 92, samples.B, '{"op":"c","after":{"x":1},"source":{"db":"shop","table":"other"}}'),
    ]
    landing = str(tmp_path / "landing")
    samples.messages_frame(spark, rows).write.parquet(landing)
    stream = spark.readStream.schema(spark.read.parquet(landing).schema).parquet(landing)
    for _ in range(2):
        ingest_messages(lake, stream, str(tmp_path / "checkpoint")).awaitTermination()
    check_layers(lake)
    run_gold(lake)
    check_marts(lake)
    kept = lake.quarantine().read().orderBy("offset").collect()
    assert [(r["offset"], r["source_table"], r["value"][:9]) for r in kept] == [
        (90, None, "{not json"),
        (92, "other", '{"op":"c"'),
    ]


def test_a_failing_table_fails_the_run_but_not_the_others(spark, lake, folders):
    from siltlake.plans.runs import RunFailedError

    raw, checkpoint = folders
    samples.land_feed(raw)
    broken = USERS.with_options(derived=(), fields=(("id", "bigint"), ("name", "string")), key="absent")
    with pytest.raises(RunFailedError, match="users"):
        run_cdc(lake, str(raw), checkpoint, [broken, PRODUCTS, ORDERS])
    assert lake.silver(ORDERS).read().count() == 5
    errors = lake.run_audit().read().filter("error IS NOT NULL").select("table_name").distinct().collect()
    assert [r[0] for r in errors] == ["users"]


def test_pipeline_stops_at_the_gate(spark, lake, folders):
    from siltlake.operators.quality import GateLimits, QualityGateError
    from siltlake.plans.runs import run_pipeline

    raw, checkpoint = folders
    samples.land_feed(raw)
    samples.land(raw, "users", "bad.json", ["{broken", "{broken too"])
    with pytest.raises(QualityGateError, match="corrupt_rows=2 of 9"):
        run_pipeline(lake, str(raw), checkpoint)
    assert not lake.gold("sales_summary").exists()
    assert run_pipeline(lake, str(raw), checkpoint, GateLimits(corrupt=0.5))["user_analytics"] == 4


def test_a_failed_batch_blocks_until_it_passes(spark, lake, folders):
    """The next day brings a good batch; the bad one has not passed yet."""
    from siltlake.operators.quality import GateLimits, QualityGateError
    from siltlake.plans.runs import gated_marks, run_pipeline

    raw, checkpoint = folders
    samples.land_feed(raw)
    run_pipeline(lake, str(raw), checkpoint)
    passed = gated_marks(lake)
    samples.land(raw, "users", "bad.json", ["{broken", "{broken too"])
    with pytest.raises(QualityGateError, match="corrupt_rows=2 of 2"):
        run_pipeline(lake, str(raw), checkpoint)
    assert gated_marks(lake) == passed
    samples.land(raw, "users", "good.json", [samples._user(6, "Ann", "ann@example.com", 30000)])
    with pytest.raises(QualityGateError, match="corrupt_rows=2 of 3"):
        run_pipeline(lake, str(raw), checkpoint)
    assert lake.gold("user_analytics").read().count() == 4
    assert run_pipeline(lake, str(raw), checkpoint, GateLimits(corrupt=0.7))["user_analytics"] == 5
    assert check_quality(lake)["users"]["rows"] == 0


def test_unreadable_messages_fail_the_gate(spark, lake, tmp_path):
    from siltlake.operators.quality import GateLimits, QualityGateError
    from siltlake.plans.runs import run_message_pipeline

    good = samples.envelopes("users", samples.FEED["users"][:1])
    rows = good + [("cdc.users", 0, 100 + i, samples.B, "{not json") for i in range(9)]
    landing = str(tmp_path / "landing")
    samples.messages_frame(spark, rows).write.parquet(landing)
    stream = spark.readStream.schema(spark.read.parquet(landing).schema).parquet(landing)
    with pytest.raises(QualityGateError, match="quarantined_rows=9 next to 1"):
        run_message_pipeline(lake, stream, str(tmp_path / "c"), specs={"users": USERS, "products": PRODUCTS, "orders": ORDERS})
    assert lake.silver(USERS).read().count() == 1 and not lake.gold("user_analytics").exists()
    assert run_message_pipeline(lake, stream, str(tmp_path / "c"), GateLimits(quarantined=0.95)) == {}


def test_messages_to_marts_in_one_call(spark, lake, tmp_path):
    from siltlake.plans.runs import run_message_pipeline

    rows = [r for table, records in samples.FEED.items() for r in samples.envelopes(table, records)]
    landing = str(tmp_path / "landing")
    samples.messages_frame(spark, rows).write.parquet(landing)
    stream = spark.readStream.schema(spark.read.parquet(landing).schema).parquet(landing)
    written = run_message_pipeline(lake, stream, str(tmp_path / "c"), dedup_delay="1 day")
    assert written == {"user_analytics": 4, "product_analytics": 5, "sales_summary": 1, "user_stats": 4}
    check_layers(lake)
    check_marts(lake)


def test_a_first_load_passes_the_gate(spark, lake, folders):
    from siltlake.plans.runs import run_pipeline

    raw, checkpoint = folders
    samples.land(raw, "users", "snapshot.json", [{**r, "__op": "r"} for r in samples.FEED["users"][:5]])
    run_pipeline(lake, str(raw), checkpoint)  # products and orders have no folder yet
    assert lake.silver(USERS).read().filter("is_active").count() == 5
    assert [r["error"] for r in lake.run_audit().read().collect()] == [None] * 6


def test_taken_files_are_archived(spark, lake, folders, tmp_path):
    raw, checkpoint = folders
    for i, record in enumerate(samples.FEED["users"]):
        samples.land(raw, "users", f"{i}.json", [record])
    for _ in range(2):
        run_cdc(lake, str(raw), checkpoint, [USERS], max_files_per_trigger=3, archive_root=str(tmp_path / "old"))
    assert list(lake.bronze(USERS).marks().values()) == [2] and lake.bronze(USERS).read().count() == 7


def test_errors_are_recorded_whole(spark, lake):
    from siltlake.plans.runs import record_run

    record_run(lake, [USERS], {"users": "x" * 5000})
    assert len(lake.run_audit().read().first()["error"]) == 5000


def test_a_failing_table_does_not_stop_the_silver_run(spark, lake, folders):
    from siltlake.plans.runs import RunFailedError, run_silver
    from siltlake.streaming.jobs import ingest_bronze

    raw, checkpoint = folders
    samples.land_feed(raw)
    for spec in (USERS, ORDERS):
        ingest_bronze(lake, spec, f"{raw}/{spec.name}", f"{checkpoint}/{spec.name}").awaitTermination()
    broken = USERS.with_options(key="absent")
    with pytest.raises(RunFailedError, match="users"):
        run_silver(lake, [broken, ORDERS])
    assert lake.silver(ORDERS).read().count() == 5
    errors = lake.run_audit().read().filter("error IS NOT NULL").select("table_name").distinct().collect()
    assert [r[0] for r in errors] == ["users"]


def test_marts_of_empty_tables(spark, lake):
    for spec in (USERS, ORDERS):
        lake.silver(spec).replace(spark.createDataFrame([], spec.silver_schema()))
    assert run_gold(lake) == {"sales_summary": 0, "user_analytics": 0, "user_stats": 0}
    assert lake.gold("sales_summary").read().count() == 0
