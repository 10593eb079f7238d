"""Replay removal without a limit of time: filters, the index, and the intakes."""

import random

import pytest
from pyspark.sql import functions as F

from siltlake.operators import bloom
from siltlake.plans.layers import append_bronze
from siltlake.plans.seen import Seen, identity_of
from siltlake.spec import ORDERS
from siltlake.streaming import jobs

SCHEMA = (
    "id bigint, user_id bigint, product_id bigint, quantity int, total_amount double, status string, created_at bigint, "
    "updated_at bigint, op string, ts_ms bigint, processed_at timestamp, _position bigint, _corrupt_record string"
)


def orders(spark, ids, day="2024-03-01", status="s"):
    rows = [(i, None if i is None else i % 5, 1, 1, 1.5, status, 0, 0, "c", 1, None, i, None) for i in ids]
    return spark.createDataFrame(rows, SCHEMA).withColumn("processed_at", F.lit(day).cast("timestamp"))


def ids_of(table):
    return sorted((r[0] for r in table.read().select("id").collect()), key=lambda x: (x is None, x))


def index(lake, positions=True, fan=2):
    return Seen(lake.bronze(ORDERS), identity_of(ORDERS, positions), fan)


def test_filter_knows_its_keys_and_few_others(spark):
    keys = spark.range(60_000).select(F.unhex(F.md5(F.col("id").cast("string"))).alias(bloom.DIGEST), "id")
    level = bloom.level(30_000)
    assert level == 11 and bloom.level(0) == bloom.level(1) == bloom.LEAST_LEVEL
    filters = bloom.build(keys.filter("id < 30000").select(bloom.DIGEST), level).withColumn("level", F.lit(level))
    answers = bloom.ask(keys, filters, [level])
    assert answers.filter("id < 30000").count() == 30_000
    assert answers.filter("id >= 30000").count() < 150


@pytest.mark.parametrize("fan", [2, 3])
def test_repeats_of_any_batch_are_dropped(spark, lake, fan):
    rng = random.Random(fan)
    seen, sent = index(lake, fan=fan), []
    for n in range(7):
        own = list(range(n * 20, n * 20 + 20))
        batch = own + rng.sample(sent, min(len(sent), 15)) + own[:3]
        sent += own
        assert seen.append_unseen(orders(spark, batch, f"2024-03-0{n + 1}"), "s", n) == 20
    assert ids_of(lake.bronze(ORDERS)) == sent
    days = lake.bronze(ORDERS).read().groupBy("id").agg(F.dayofmonth(F.min("processed_at")).alias("d")).collect()
    assert all(r["d"] == r["id"] // 20 + 1 for r in days)  # the first arrival stays
    state = seen.catch_up()
    assert sum(run["rows"] for run in state["runs"]) == 140
    assert all(sum(r["tier"] == run["tier"] for r in state["runs"]) < fan for run in state["runs"])


def test_batches_of_other_ways_and_dead_writers(spark, lake, monkeypatch):
    seen, table = index(lake), lake.bronze(ORDERS)
    append_bronze(table, orders(spark, range(10)), "other", 0)
    with monkeypatch.context() as m:
        m.setattr(Seen, "_merge_runs", lambda self, state: (_ for _ in ()).throw(RuntimeError("died")))
        with pytest.raises(RuntimeError, match="died"):  # a run was written, no state names it
            seen.append_unseen(orders(spark, range(5, 15)), "s", 0)
    assert seen.append_unseen(orders(spark, range(5, 15)), "s", 0) == 5
    assert seen.append_unseen(orders(spark, range(5, 15)), "s", 0) == 0  # delivered again
    assert index(lake).append_unseen(orders(spark, range(12, 18)), "t", 0) == 3
    assert ids_of(table) == list(range(18))


def test_edges(spark, lake):
    seen = index(lake)
    assert seen.append_unseen(orders(spark, []), "s", 0) == 0
    assert seen.append_unseen(orders(spark, [None, None, 1]), "s", 1) == 2
    assert seen.append_unseen(orders(spark, [None, 1, 2]), "s", 2) == 1
    assert seen.append_unseen(orders(spark, [1], status=None), "s", 3) == 1  # another value
    wider = orders(spark, [1, 3]).withColumn("channel", F.lit("x"))
    assert seen.append_unseen(wider, "s", 4) == 1  # the identity does not name the new column
    assert ids_of(lake.bronze(ORDERS)) == [1, 1, 2, 3, None]
    other = Seen(lake.bronze(ORDERS), ["id"], 2)  # another identity: the index is made anew
    assert other.append_unseen(orders(spark, [1, 3, 9], status="t"), "s", 5) == 1


def test_only_parts_that_answer_are_read_and_hold_digests_only(spark, lake, tmp_path, monkeypatch):
    monkeypatch.setattr("siltlake.plans.seen.PER_PART", 100)
    seen, table = index(lake, fan=100), lake.bronze(ORDERS)
    for n in range(3):
        append_bronze(table, orders(spark, range(n * 1000, n * 1000 + 1000), status="text " * 2000), "s", n)
        state = seen.catch_up()
    assert [run["parts"] for run in state["runs"]] == [10, 10, 10]

    def looked(ids, name):
        rows = orders(spark, ids, status="text " * 2000)
        digests = rows.select(F.unhex(F.md5(F.to_json(F.struct(*seen.identity)))).alias(bloom.DIGEST))
        return seen.answering(state, digests, str(tmp_path / name))

    assert looked([], "none") == []
    found = looked([1234], "one")
    assert any("run=1/" in folder for folder in found) and len(found) <= 2
    assert len(looked(range(9000, 9010), "strangers")) <= 2
    stored = spark.read.parquet(f"{seen.path}/digests/run=1")
    assert stored.columns == [bloom.DIGEST, "part"] and stored.filter(F.octet_length(bloom.DIGEST) != 16).count() == 0


def test_catalog_tables_are_refused():
    with pytest.raises(ValueError, match="below a folder"):
        Seen(object(), ["id"])


def test_flat_intake_drops_what_bronze_has(spark, lake, tmp_path):
    raw, checkpoint = str(tmp_path / "raw"), str(tmp_path / "checkpoint")
    for ids in ([1, 2], [2, 3, 3], [1, 4]):
        rows = [(i, 7, 1, 1, 2.0, "new", 0, 0, "c", i) for i in ids]
        names = "id bigint, user_id bigint, product_id bigint, quantity int, total_amount double, status string, created_at bigint, updated_at bigint, __op string, __ts_ms bigint"
        spark.createDataFrame(rows, names).coalesce(1).write.mode("append").json(raw)
        jobs.ingest_files(lake, ORDERS, raw, checkpoint, dedup_any_age=True).awaitTermination()
    assert ids_of(lake.bronze(ORDERS)) == [1, 2, 3, 4]
    assert ids_of(lake.silver(ORDERS)) == [1, 2, 3, 4]


def test_messages_at_new_offsets_are_known(spark, lake, tmp_path):
    path, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    image = '{"id":%d,"user_id":1,"product_id":1,"quantity":1,"total_amount":1.0,"status":"s"}'
    value = '{"op":"c","ts_ms":5,"source":{"db":"shop","table":"orders"},"before":null,"after":' + image + "}"
    schema = "topic string, partition int, offset bigint, timestamp timestamp, value string"
    for start, ids in ((0, [1, 2]), (2, [3]), (3, [1, 2, 3, 4])):
        rows = [("cdc.orders", 0, start + k, None, value % i) for k, i in enumerate(ids)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema(schema).parquet(path)
        jobs.ingest_messages(lake, stream, checkpoint, [ORDERS], dedup_any_age=True).awaitTermination()
    assert ids_of(lake.bronze(ORDERS)) == [1, 2, 3, 4]
    assert lake.bronze(ORDERS).position() == 6
