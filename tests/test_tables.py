"""Stored tables: histories by batch, states by bucket, and the V2 catalog."""

import pytest
from pyspark.sql import functions as F

from siltlake.plans.lake import GOLD_COLUMNS, CatalogLake
from siltlake.plans.layers import append_bronze, export_days, upsert_silver
from siltlake.spec import BUCKET, ORDERS, USERS, schema_of
from siltlake.tables import ConcurrentCommitError, ParquetHistory, ParquetState, catalog
from siltlake.tables.files import Files

COLUMNS = schema_of([("id", "bigint"), ("day", "string")])


def frame(spark, start, end, days=2):
    return spark.range(start, end).select("id", F.concat(F.lit("d"), F.col("id") % days).alias("day"))


@pytest.fixture
def table(spark, tmp_path):
    return ParquetHistory(spark, str(tmp_path / "t"), COLUMNS, "day")


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_an_absent_table_reads_as_no_rows(spark, table, tmp_path):
    state = ParquetState(spark, str(tmp_path / "s"), COLUMNS)
    for absent in (table, state):
        assert not absent.exists() and absent.marks() == {} and absent.counts()[0] == 0
        assert absent.read().collect() == [] and absent.read().columns == ["id", "day"]
    assert table.read_since({}).collect() == []


def test_histories_by_batch(spark, table):
    assert table.append(frame(spark, 0, 2), "s", 0) == 2
    table.append(frame(spark, 2, 4), "s", 1)
    table.append(frame(spark, 4, 6), "other", 7)
    assert table.marks() == {"s": 1, "other": 7} and table.counts() == (6, None)
    assert table.has_applied("s", 1) and not table.has_applied("s", 2) and not table.has_applied("new", 0)
    assert ids(table.read_batch("s", 0)) == [0, 1] and ids(table.read_batch("other", 7)) == [4, 5]
    assert ids(table.read_since({"s": 0})) == [2, 3, 4, 5]
    assert ids(table.read_since({}, {"s": 0})) == [0, 1]
    assert ids(table.read_since(table.marks())) == []
    assert ids(table.read()) == list(range(6)) and table.read().columns == ["id", "day"]
    plan = table.read().filter("day = 'd1'")._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "day" in filters and "_stream" in filters and "_batch" in filters


def test_a_batch_written_again_replaces_itself(spark, table):
    for start in (0, 2):
        table.append(frame(spark, start, start + 2), "s", start)
    table.append(frame(spark, 10, 13), "s", 2)
    assert ids(table.read()) == [0, 1, 10, 11, 12] and table.counts() == (5, None)


def test_rows_appended_by_hand_are_batches_too(spark, table):
    for start in (0, 2, 4):
        table.append(frame(spark, start, start + 2))
    assert ids(table.read()) == list(range(6)) and list(table.marks().values()) == [2]


def test_unknown_partition_value(spark, table):
    table.append(spark.createDataFrame([(1, None), (2, "d0")], COLUMNS))
    assert ids(table.read().filter("day IS NULL")) == [1]


def test_new_columns_widen_and_type_changes_are_refused(spark, table):
    table.append(frame(spark, 0, 2))
    table.append(frame(spark, 2, 4).withColumn("extra", F.lit("x")))
    got = {r["id"]: r["extra"] for r in table.read().collect()}
    assert got == {0: None, 1: None, 2: "x", 3: "x"}
    with pytest.raises(TypeError, match="id is bigint"):
        table.append(spark.createDataFrame([("a", "d0")], "id string, day string"))
    assert table.read().count() == 4


def test_an_empty_batch_counts_as_taken(spark, table):
    assert table.append(frame(spark, 0, 0), "s", 0) == 0
    assert table.has_applied("s", 0) and table.read().count() == 0 and table.read_batch("s", 0).count() == 0


def test_replace_takes_the_new_schema_and_cleans_up(spark, tmp_path):
    table = ParquetState(spark, str(tmp_path / "s"), COLUMNS)
    assert table.replace(frame(spark, 0, 4)) == 4
    before = table.read()
    table.replace(spark.createDataFrame([("a",)], "only string"))
    assert table.read().columns == ["only"] and table.counts() == (1, None)
    assert before.count() == 4  # a reader of the commit before may go on
    table.replace(spark.createDataFrame([("b",)], "only string"))
    assert len(Files(spark).names(f"{table.path}/data")) == 2 and table.number() == 3


def user_rows(spark, keys, name="n", at=1, op="c"):
    rows = [(k, name, "a@b", 0, 0, op, at, None, None) for k in keys]
    kind = "bigint" if not keys or isinstance(keys[0], int) else "string"
    return spark.createDataFrame(
        rows,
        f"id {kind}, name string, email string, created_at bigint, updated_at bigint, op string, ts_ms bigint, "
        "processed_at timestamp, _position bigint",
    )


def now():
    return F.timestamp_seconds(F.lit(0))


@pytest.mark.parametrize(
    "keys",
    [
        [1_700_000_000_000_000_000 + 4_194_304 * i for i in range(400)],
        [(i * 2_654_435_761 * 40_503) % 2**61 for i in range(400)],
        list(range(400)),
        [f"user-{i:05d}" for i in range(400)],
    ],
    ids=["time-ordered", "random", "serial", "text"],
)
def test_keys_of_any_kind_fill_the_declared_buckets(spark, lake, keys):
    kind = "bigint" if isinstance(keys[0], int) else "string"
    spec = USERS.with_options(buckets=8, fields=(("id", kind), ("name", "string"), ("email", "string")))
    table = lake.silver(spec)
    upsert_silver(table, user_rows(spark, keys), spec, now())
    assert sorted(table.folders()) == [str(i) for i in range(8)] and table.counts() == (400, 400)
    upsert_silver(table, user_rows(spark, keys[:100], "m", 2, "d"), spec, now())
    assert table.counts() == (400, 300) and table.read().filter("name = 'm'").count() == 100


def test_a_merge_touches_only_the_buckets_of_its_changes(spark, lake):
    spec = USERS.with_options(buckets=16)
    table = lake.silver(spec)
    upsert_silver(table, user_rows(spark, list(range(200))), spec, now())
    before = table.folders()
    upsert_silver(table, user_rows(spark, [12], "m", 2), spec, now(), stream="s", batch=4)
    after = table.folders()
    assert sum(before[b] != after[b] for b in before) == 1 and table.read().count() == 200
    upsert_silver(table, user_rows(spark, [13], "again", 9), spec, now(), stream="s", batch=4)
    assert table.number() == 2 and table.marks() == {"s": 4}


def test_a_merge_deals_each_side_out_once(spark, tmp_path, monkeypatch):
    from siltlake.tables import store

    plans = []
    write = ParquetState._write

    def note(self, df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(self, df)

    monkeypatch.setattr(store.ParquetState, "_write", note)
    table = ParquetState(spark, str(tmp_path / "s"), USERS.silver_schema(), buckets=True)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for at in (1, 2):
            upsert_silver(table, user_rows(spark, list(range(300)), at=at), USERS, now())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plans[-1].count("Exchange hashpartitioning") == 2 and "FullOuter" in plans[-1]
    files = [n for b in table.folders().values() for n in Files(spark).names(f"{table.path}/data/{b}")]
    assert len([n for n in files if n.endswith(".parquet")]) == len(table.folders())


def test_two_writers_of_a_state_do_not_overwrite_each_other(spark, tmp_path, monkeypatch):
    table = ParquetState(spark, str(tmp_path / "s"), COLUMNS)
    write, other = ParquetState._write, [frame(spark, 8, 9)]

    def write_while_another_commits(self, df):
        written = write(self, df)
        if other:
            ParquetState(spark, self.path, COLUMNS).replace(other.pop())
        return written

    monkeypatch.setattr(ParquetState, "_write", write_while_another_commits)
    with pytest.raises(ConcurrentCommitError):
        table.replace(frame(spark, 0, 4))
    assert ids(table.read()) == [8]


def test_file_system_work_does_not_grow_with_the_batches(spark, lake, monkeypatch):
    calls = []
    for name in ("exists", "names", "sizes", "delete", "read_json", "write_json"):
        original = getattr(Files, name)
        monkeypatch.setattr(
            Files, name, lambda self, *a, _f=original, _n=name: (calls.append(_n), _f(self, *a))[1]
        )
    spec = USERS.with_options(buckets=2)
    counts = []
    for batch in range(26):
        calls.clear()
        rows = user_rows(spark, [batch, batch + 1], at=batch)
        if batch in (5, 25):
            from siltlake.streaming.jobs import apply_batch

            apply_batch(lake, spec, rows.withColumn("_corrupt_record", F.lit(None).cast("string")), "s", batch)
            counts.append(len(calls))
        else:
            append_bronze(lake.bronze(spec), rows.withColumn("_corrupt_record", F.lit(None).cast("string")), "s", batch)
    assert abs(counts[0] - counts[1]) <= 4


def test_a_history_by_day_in_few_files(spark, table, tmp_path):
    schema = schema_of([("id", "bigint"), ("processed_day", "string")])
    history = ParquetHistory(spark, str(tmp_path / "h"), schema, "processed_day")
    for start in range(0, 40, 10):
        history.append(frame(spark, start, start + 10).withColumnRenamed("day", "processed_day").repartition(3))
    path = str(tmp_path / "days")
    export_days(history, path)
    assert ids(spark.read.schema(schema).parquet(path)) == list(range(40))
    assert sum(n.endswith(".parquet") for d in ("d0", "d1") for n in Files(spark).names(f"{path}/processed_day={d}")) == 2


def test_layer_ddl_on_stock_spark(spark):
    spark.sql(catalog.create_database_sql("ddl_check"))
    for spec in (USERS, ORDERS):
        for layer in ("bronze", "silver"):
            spark.sql(catalog.create_layer_sql(spec, layer, "ddl_check"))
    for name, columns in GOLD_COLUMNS.items():
        spark.sql(catalog.create_gold_sql(name, columns, "ddl_check"))
    silver = spark.table("ddl_check.silver_orders").schema
    assert sorted(silver.fieldNames()) == sorted(ORDERS.silver_schema().fieldNames())
    assert spark.table("ddl_check.gold_user_analytics").schema == schema_of(GOLD_COLUMNS["user_analytics"])
    table = catalog.CatalogTable(spark, "ddl_check.silver_users")
    assert table.exists() and table.read().count() == 0 and table.counts() == (0, 0)
    assert not catalog.CatalogTable(spark, "ddl_check.absent").exists()
    spark.sql("DROP DATABASE ddl_check CASCADE")


def test_v2_statements_parse(spark):
    ddl = catalog.create_layer_sql(USERS, "bronze", "lake.db", "iceberg", "s3://x/y")
    assert "PARTITIONED BY (days(processed_at))" in ddl and "'write.target-file-size-bytes'='134217728'" in ddl
    parser = spark._jsparkSession.sessionState().sqlParser()
    modes = [("soft", "win"), ("soft", "ignore"), ("hard", "win")]
    lake = CatalogLake(spark, "lake.db")
    tables = [lake.bronze(USERS), lake.silver(USERS), lake.quarantine(), lake.run_audit(), lake.gate_audit(), lake.gold("user_stats")]
    statements = [ddl, *(t.ddl for t in tables)]
    for sql in (*statements, *(catalog.merge_sql("lake.db.t", "changes", ORDERS, *mode) for mode in modes)):
        assert parser.parsePlan(sql) is not None


def test_both_stores_offer_the_same(spark, lake):
    other = CatalogLake(spark, "lake.db")
    history = ["exists", "append", "has_applied", "read", "read_batch", "read_since", "marks", "counts", "on"]
    state = ["exists", "merge", "replace", "read", "marks", "counts", "stored_bytes", "on"]
    for make, names in (
        (lambda x: x.bronze(USERS), history), (lambda x: x.quarantine(), history), (lambda x: x.run_audit(), history),
        (lambda x: x.silver(USERS), state), (lambda x: x.gold("user_stats"), state),
    ):
        for name in names:
            assert callable(getattr(make(lake), name)) and callable(getattr(make(other), name))
    assert BUCKET in USERS.silver_schema().fieldNames()


def test_shuffles_are_sized_by_the_stored_bytes(spark):
    from siltlake.session import BYTES_PER_SHUFFLE_PARTITION, sized_session

    wide = sized_session(spark, 1000 * BYTES_PER_SHUFFLE_PARTITION)
    assert wide.conf.get("spark.sql.shuffle.partitions") == "1000"
    assert wide.conf.get("spark.sql.session.timeZone") == "UTC"
    assert sized_session(spark, 1).conf.get("spark.sql.shuffle.partitions") == "4"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
