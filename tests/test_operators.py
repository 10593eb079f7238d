"""Sources, routing, enrichment, audits, duplicates and the quality gate."""

import json

import pytest
from pyspark.sql import functions as F

import samples
from siltlake.operators import audit, quality
from siltlake.operators.dedup import dedup_changes
from siltlake.operators.enrich import enrich, enrich_table
from siltlake.operators.route import TABLE_ROUTES, as_messages, route
from siltlake.plans import gold
from siltlake.sources import flat
from siltlake.sources.envelope import parse_envelopes, table_changes
from siltlake.spec import ORDERS, USERS


def at():
    return F.timestamp_seconds(F.lit(0))


# -- flat files -----------------------------------------------------------------


def test_bad_lines_and_loose_types(spark, tmp_path):
    samples.land(
        tmp_path,
        "orders",
        "a.json",
        [
            {"id": "7", "user_id": 1, "quantity": "2", "total_amount": "19.5", "__op": "c", "__ts_ms": "5"},
            {"id": 8, "user_id": "x", "quantity": 2.0, "total_amount": "n/a", "__op": None, "__ts_ms": 1.7e12},
            '{"id": 9, "user_id"',
            {"unknown": 1},
        ],
    )
    df = flat.read_changes(spark, str(tmp_path / "orders"), ORDERS, at())
    got = {r["id"]: r for r in df.collect() if r["id"]}
    assert (got[7]["quantity"], got[7]["total_amount"], got[7]["ts_ms"], got[7]["status"]) == (2, 19.5, 5, None)
    assert (got[8]["user_id"], got[8]["total_amount"], got[8]["op"]) == (None, None, None)
    assert got[8]["ts_ms"] == 1_700_000_000_000
    bad = [r["_corrupt_record"] for r in df.collect() if r["_corrupt_record"]]
    assert bad == ['{"id": 9, "user_id"'] and df.count() == 4
    assert df.columns == [name for name, _ in ORDERS.bronze_columns]


def test_empty_and_absent_folders_have_no_rows(spark, tmp_path):
    (tmp_path / "users").mkdir()
    for name in ("users", "absent"):
        found = flat.read_changes(spark, str(tmp_path / name), USERS, at())
        assert found.count() == 0 and found.columns == [name for name, _ in USERS.bronze_columns]


def test_the_position_comes_from_the_source(spark, tmp_path):
    record = {"id": 1, "__op": "c", "__ts_ms": 5}
    sources = [{"lsn": 77, "db": "shop"}, '{"lsn": 78}', None, {"other": 1}, "text"]
    samples.land(tmp_path, "users", "a.json", [{**record, "id": i, "__source": s} for i, s in enumerate(sources)])
    samples.land(tmp_path, "users", "b.json", [record | {"id": 9}])
    rows = flat.read_changes(spark, str(tmp_path / "users"), USERS, at()).collect()
    assert {r["id"]: r["_position"] for r in rows} == {0: 77, 1: 78, 2: None, 3: None, 4: None, 9: None}


def test_the_archive_has_a_file_per_day(spark, tmp_path):
    from siltlake.tables.files import Files

    records = spark.range(0, 1000, 1, 8).select("id", (F.col("id") % 2 * 86_400_000).alias("__ts_ms"))
    path = str(tmp_path / "archive")
    flat.archive_raw(records, F.timestamp_millis("__ts_ms"), path)
    days = [f"{path}/year=1970/month=01/day={d}" for d in ("01", "02")]
    assert [sum(n.endswith(".json") for n in Files(spark).names(d)) for d in days] == [1, 1]


# -- envelopes -------------------------------------------------------------------


EVENTS = [
    ("cdc.users", 0, 0, 0, '{"op":"c","after":{"id":1,"name":"Mira Kant"},"source":{"db":"s","table":"users"},"ts_ms":3}'),
    ("cdc.users", 0, 1, 0, '{"op":"u","before":{"id":1},"after":{"id":"1"},"source":{"table":"users"},"ts_ms":"4"}'),
    ("cdc.users", 0, 2, 0, '{"op":"d","before":{"id":2,"_change_type":"x"},"after":null,"source":{"table":"users"}}'),
    ("cdc.orders", 0, 3, 0, '{"op":"c","after":{"id":9,"user_id":1,"product_id":5},"source":{"table":"orders"}}'),
    ("cdc.users", 0, 4, 0, "oops"),
    ("cdc.users", 0, 5, 0, None),
    ("cdc.users", 0, 6, 0, '{"id":1,"__op":"c"}'),
]


@pytest.fixture(scope="module")
def events(spark):
    return parse_envelopes(samples.messages_frame(spark, EVENTS), processed_at=at())


def test_envelope_fields(events):
    got = {r["offset"]: r for r in events.collect()}
    assert got[0]["routing_key"] == "users_c" and got[0]["source_database"] == "s" and got[0]["is_delete"] is False
    assert got[1]["source_timestamp"] == 4 and json.loads(got[1]["after_state"])["id"] == "1"
    assert got[2]["is_delete"] and got[2]["after_state"] is None and json.loads(got[2]["before_state"])["_change_type"] == "x"
    assert got[4]["_corrupt_record"] == "oops" and got[4]["is_delete"] is None and got[4]["routing_key"] is None
    assert got[5]["_corrupt_record"] is None and got[5]["operation"] is None
    assert got[6]["_corrupt_record"] == '{"id":1,"__op":"c"}'


def test_table_rows_take_the_old_image_for_deletes(events):
    got = {r["_position"]: r for r in table_changes(events, USERS).collect()}
    assert sorted(got) == [0, 1, 2]
    assert (got[2]["id"], got[2]["op"]) == (2, "d") and (got[0]["name"], got[0]["ts_ms"]) == ("Mira Kant", 3)


# -- routing ---------------------------------------------------------------------


def test_routes_may_overlap_and_unknown_does_not_match(events):
    routes = {**TABLE_ROUTES, "alerts": "is_delete"}
    got = sorted((r["offset"], r["target_topic"]) for r in route(events, routes).collect())
    assert got == [
        (0, "processed.users"),
        (1, "processed.users"),
        (2, "alerts"),
        (2, "processed.users"),
        (3, "processed.orders"),
    ]
    message = as_messages(route(events, {"t": "offset = 0"})).first()
    body = json.loads(message["value"])
    assert (message["topic"], message["key"]) == ("t", "cdc.users")
    assert body["after_state"] == {"id": 1, "name": "Mira Kant"} and "before_state" not in body


def test_scores_and_alerts(events):
    scores = {r["offset"]: r["quality_score"] for r in quality.score_events(events).collect()}
    assert scores == {0: 1.0, 1: 1.0, 2: 1.0, 3: 1.0, 4: 0.0, 5: 0.0, 6: 0.0}
    alert = quality.delete_alerts(events).collect()
    assert len(alert) == 1 and json.loads(alert[0]["deleted_record"])["id"] == 2


def test_messages_are_parsed_once_by_a_schema_of_no_table(spark):
    parsed = parse_envelopes(samples.messages_frame(spark, EVENTS))
    plan = quality.delete_alerts(parsed)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1 and "user_id" not in plan


# -- enrichment --------------------------------------------------------------------


def test_references_join_only_their_own_events(spark, events):
    users = spark.createDataFrame([(1, "Ann", "a@x"), (9, "Zed", "z@x")], "id bigint, name string, email string")
    products = spark.createDataFrame(
        [(1, "Pen", "c", 2.0), (5, "Desk", "f", 9.0)], "id bigint, name string, category string, price double"
    )
    own = enrich_table(enrich_table(events, users, "users"), products, "products")
    got = {r["offset"]: (r["users_name"], r["products_name"]) for r in own.collect()}
    assert got == {0: ("Ann", None), 1: ("Ann", None), 2: (None, None), 3: (None, None), **{n: (None, None) for n in (4, 5, 6)}}
    by_key = enrich_table(events, users, "users", {"orders": "user_id"})
    assert by_key.filter("offset = 3").first()["users_name"] == "Ann"


def test_a_hot_key_is_split_when_the_reference_is_too_large_to_broadcast(spark):
    session = spark.newSession()
    for key, value in {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }.items():
        session.conf.set(key, value)
    rows = session.range(0, 300_000, 1, 16).select(
        F.col("id").alias("offset"),
        F.when(F.col("id") % 3 == 0, 5).when(F.col("id") % 3 == 1, F.col("id") % 2000).cast("bigint").alias("k"),
    )
    reference = session.range(2000).select("id", F.concat(F.lit("n"), "id").alias("name"))
    joined = enrich(rows, reference, F.col("k"), ["name"], "r_")
    joined.write.format("noop").mode("overwrite").save()
    got = joined.agg(F.count(F.lit(1)), F.count("r_name"), F.count_if(F.col("r_name") == "n5"))
    total, matched, hot = got.first()
    assert total == 300_000 and matched == 200_000 and hot >= 100_000
    joined.collect()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan


def test_reference_reads_only_its_columns(spark):
    from siltlake.sources.reference import reference_table

    path = "/root/testdata/sf0.001/customer.parquet"
    reference = reference_table(spark, path, "c_custkey", ["c_name"])
    plan = reference._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string>" in plan


# -- audits ------------------------------------------------------------------------


def test_audit_of_an_empty_table(spark):
    empty = spark.createDataFrame([], USERS.bronze_schema())
    assert [tuple(r) for r in audit.table_event_audit({"users": empty}).collect()] == [("users", 0, 0, 0, 0)]
    assert quality.gate_metrics(empty).first().asDict()["rows"] == 0


def test_recent_rows_and_counts(spark):
    df = spark.createDataFrame(
        [(i, "c" if i % 2 else None, i // 2, i // 2) for i in range(30)], "id long, op string, ts_ms long, processed_at long"
    )
    assert [r["id"] for r in audit.recent_rows(df, 3).collect()] == [29, 28, 27]
    assert [r["id"] for r in audit.recent_by_op(df, "c", 2, ["id"]).collect()] == [29, 27]
    assert [tuple(r) for r in audit.op_counts(df).collect()] == [(None, 15), ("c", 15)]
    plan = audit.recent_rows(df)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_first_arrival_survives(spark):
    df = spark.createDataFrame(
        [("t", 1, 5, "c", 2, "late"), ("t", 1, 5, "c", 1, "first"), ("t", 1, None, "c", 1, "x"), ("t", 1, None, "c", 1, "x")],
        "source_table string, id long, ts_ms long, op string, processed_at long, note string",
    )
    kept = dedup_changes(df)
    assert sorted(r["note"] for r in kept.collect()) == ["first", "x"] and kept.columns == df.columns


def test_gate(spark):
    rows = [(1, "c", 5, None), (None, "c", 5, None), (2, "x", 5, None), (None, None, None, "{"), (3, None, 1, None)]
    df = spark.createDataFrame(rows, "id long, op string, ts_ms long, _corrupt_record string").withColumn(
        "processed_at", F.timestamp_millis(F.lit(100))
    )
    metrics = quality.gate_metrics(df).first().asDict()
    assert metrics == {"rows": 5, "corrupt_rows": 1, "null_keys": 1, "unknown_ops": 2, "max_lag_ms": 99}
    loose = quality.GateLimits(corrupt=0.2, null_key=0.2, unknown_op=0.4, lag_ms=99)
    quality.check_gate(metrics, loose)
    with pytest.raises(quality.QualityGateError, match="corrupt_rows=1 of 5"):
        quality.check_gate(metrics, quality.GateLimits(null_key=1, unknown_op=1))
    with pytest.raises(quality.QualityGateError, match="max_lag_ms=99"):
        quality.check_gate(metrics, quality.GateLimits(1, 1, 1, lag_ms=98))
    snapshot = df.withColumn("op", F.lit("r"))
    assert quality.gate_metrics(snapshot).first()["unknown_ops"] == 0
    both = quality.gate_metrics(df, quarantine=df.limit(2)).first().asDict()
    assert both == {**metrics, "quarantined_rows": 2}
    with pytest.raises(quality.QualityGateError, match="quarantined_rows=2 next to 5"):
        quality.check_gate(both, quality.GateLimits(1, 1, 1, quarantined=0.2))


# -- marts on edge rows --------------------------------------------------------------


def silver(spark, kind, rows):
    return spark.createDataFrame(rows, kind)


def test_marts_with_gaps(spark):
    orders = silver(
        spark,
        "id long, user_id long, product_id long, total_amount double, created_at long, is_active boolean",
        [
            (1, 1, 1, 600.0, 0, True),
            (2, 1, None, None, 0, True),
            (3, None, 2, 5.0, None, True),
            (4, 1, 1, 9000.0, 0, False),
            (5, 3, 2, 600.0, 0, True),
        ],
    )
    users = silver(
        spark,
        "id long, name string, email_domain string, created_at long, processed_at timestamp, is_active boolean",
        [(1, "a", "x", None, None, True), (2, "b", None, 0, None, True), (3, "c", "", 0, None, False)],
    )
    mart = {r["user_id"]: r for r in gold.user_analytics(users, orders, at()).collect()}
    assert sorted(mart) == [1, 2]
    assert (mart[1]["total_orders"], mart[1]["total_spent"], mart[1]["avg_order_value"]) == (2, 600.0, 600.0)
    assert mart[1]["user_segment"] == "Regular" and mart[1]["registration_date"] is None
    assert (mart[2]["total_orders"], mart[2]["total_spent"], mart[2]["registration_date"]) == (0, 0.0, "1970-01-01")

    days = {r["date_key"]: tuple(r)[1:6] for r in gold.sales_summary(orders, at()).collect()}
    assert days == {"1970-01-01": (3, 1200.0, 600.0, 2, 1), None: (1, 5.0, 5.0, 0, 0)}

    stats = {r["id"]: tuple(r)[2:] for r in gold.user_stats(users, orders).collect()}
    assert stats == {1: (3, 9600.0, "Gold"), 2: (0, None, "Silver")}


def test_stage_counts_come_with_the_write(spark, lake):
    from siltlake.plans.layers import append_bronze

    rows = spark.createDataFrame([], USERS.bronze_schema()).drop("processed_day")
    assert append_bronze(lake.bronze(USERS), rows) == 0
    assert lake.bronze(USERS).counts() == (0, None)
