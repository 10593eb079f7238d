"""Streams against batch results, restarts, and retries of a batch."""

import pytest
from pyspark.sql import functions as F

import samples
from siltlake.operators.audit import windowed_op_counts
from siltlake.operators.dedup import dedup_stream
from siltlake.plans import feeds
from siltlake.sources.envelope import kafka_changes, parse_envelopes
from siltlake.spec import USERS, schema_of
from siltlake.streaming import jobs
from siltlake.tables import ParquetHistory

SF = "/root/testdata/sf0.001"
CHANGE = "source_table string, id long, ts_ms long, op string, at timestamp, copy int"


def stream_of(spark, frame, path, files=4):
    """The frame as a file stream that delivers one file per batch."""
    frame.repartition(files).write.parquet(path)
    return spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_many_small_batches_equal_one(spark, lake, tmp_path):
    raw = tmp_path / "raw"
    for i, record in enumerate(samples.FEED["users"]):
        samples.land(raw, "users", f"{i}.json", [record])
    for _ in range(2):
        query = jobs.ingest_files(
            lake, USERS, str(raw / "users"), str(tmp_path / "c"), late_delete="ignore", max_files_per_trigger=1
        )
        query.awaitTermination()
    assert list(lake.bronze(USERS).marks().values()) == [6] and lake.bronze(USERS).read().count() == 7
    got = {r["id"]: (r["name"], r["is_active"]) for r in lake.silver(USERS).read().collect()}
    assert got[1] == ("John Doe Updated", True) and got[5] == ("Charlie Brown", False) and len(got) == 5


def test_a_batch_delivered_again_is_skipped(spark, lake):
    rows = spark.createDataFrame(
        [(1, "a", "a@b", 0, 0, "c", 5, None, 0, None)],
        "id long, name string, email string, created_at long, updated_at long, op string, ts_ms long, "
        "processed_at timestamp, _position long, _corrupt_record string",
    ).withColumn("processed_at", F.timestamp_seconds(F.lit(0)))
    jobs.apply_batch(lake, USERS, rows, "s", 0)
    # The bronze commit of batch 1 succeeds, then the job dies before silver.
    update = rows.withColumns({"ts_ms": F.lit(6).cast("long"), "name": F.lit("b")})
    jobs.append_bronze(lake.bronze(USERS), update, "s", 1)
    for _ in range(2):
        jobs.apply_batch(lake, USERS, update, "s", 1)
    assert lake.bronze(USERS).read().count() == 2
    assert [r["name"] for r in lake.silver(USERS).read().collect()] == ["b"]
    assert lake.silver(USERS).number() == 2


def test_silver_may_follow_bronze_in_larger_steps(spark, lake, tmp_path):
    from siltlake.plans.runs import run_silver

    raw = tmp_path / "raw"
    records = samples.FEED["users"]
    assert run_silver(lake, [USERS]) == {"users": None} and lake.silver(USERS).number() == 0
    for upto, commits in ((4, 1), (7, 2)):
        for i in range(0 if upto == 4 else 4, upto):
            samples.land(raw, "users", f"{i}.json", [records[i]])
        query = jobs.ingest_bronze(lake, USERS, str(raw / "users"), str(tmp_path / "c"), max_files_per_trigger=1)
        query.awaitTermination()
        for _ in range(2):
            run_silver(lake, [USERS])
            assert lake.silver(USERS).number() == commits
    assert lake.bronze(USERS).read().count() == 7
    got = {r["id"]: (r["name"], r["is_active"]) for r in lake.silver(USERS).read().collect()}
    assert got[1] == ("John Doe Updated", True) and got[5] == ("Charlie Brown", False) and len(got) == 5


def test_replayed_files_leave_bronze_unchanged(spark, lake, tmp_path):
    raw = tmp_path / "raw"
    for part in range(2):
        samples.land(raw, "users", f"{part}.json", samples.FEED["users"])
        query = jobs.ingest_bronze(lake, USERS, str(raw / "users"), str(tmp_path / "c"), dedup_delay="1 hour")
        query.awaitTermination()
    assert lake.bronze(USERS).read().count() == 7


def test_staging_goes_away_when_a_batch_fails(spark, lake, tmp_path, monkeypatch):
    from siltlake.session import scratch_root
    from siltlake.tables.files import Files

    files, root = Files(spark), f"{scratch_root(spark)}/siltlake"
    before = set(files.names(root))
    landing = str(tmp_path / "landing")
    samples.messages_frame(spark, samples.envelopes("users", samples.FEED["users"])).write.parquet(landing)
    stream = spark.readStream.schema(spark.read.parquet(landing).schema).parquet(landing)
    broken = USERS.with_options(key="absent")
    with pytest.raises(Exception, match="absent"):
        jobs.ingest_messages(lake, stream, str(tmp_path / "c"), [broken]).awaitTermination()
    assert set(files.names(root)) <= before


def test_a_new_checkpoint_is_a_new_stream(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.range(5).write.parquet(path)
    table = ParquetHistory(spark, str(tmp_path / "out"), schema_of([("id", "bigint")]))
    stream = spark.readStream.schema("id long").parquet(path)
    for checkpoint in ("a", "a", "b"):
        jobs.append_stream(stream, table, str(tmp_path / checkpoint)).awaitTermination()
    assert table.read().count() == 10
    assert len(table.marks()) == 2 and str(tmp_path) not in "".join(table.marks())


def test_state_joined_per_batch(spark, lake, tmp_path):
    reference = {"name": "old"}

    def current():
        return spark.createDataFrame([(1, reference["name"])], "id long, dept string")

    path = str(tmp_path / "in")
    table = ParquetHistory(spark, str(tmp_path / "out"), schema_of([("id", "bigint")]))
    for number, name in enumerate(["old", "new"]):
        reference["name"] = name
        spark.createDataFrame([(1, number), (2, number)], "id long, n int").write.mode("append").parquet(path)
        stream = spark.readStream.schema("id long, n int").parquet(path)
        query = jobs.enrich_with_current(stream, current, table, str(tmp_path / "c"), F.col("id"), ["dept"], "now_")
        query.awaitTermination()
    got = sorted((r["n"], r["id"], r["now_dept"] or "") for r in table.read().collect())
    assert got == [(0, 1, "old"), (0, 2, ""), (1, 1, "new"), (1, 2, "")]


def test_enrichment_of_a_stream_with_a_fixed_reference(spark, tmp_path):
    from siltlake.operators.enrich import enrich_table

    users = feeds.user_changes(spark, SF).select("id", "name", "email")
    messages = feeds.messages(spark, SF)
    batch = enrich_table(parse_envelopes(messages), users, "users").select("offset", "users_name")
    stream = parse_envelopes(stream_of(spark, messages, str(tmp_path / "in"), 2))
    table = ParquetHistory(spark, str(tmp_path / "out"), batch.schema)
    enriched = enrich_table(stream, users, "users").select("offset", "users_name")
    jobs.append_stream(enriched, table, str(tmp_path / "c")).awaitTermination()
    assert sorted(map(tuple, table.read().collect())) == sorted(map(tuple, batch.collect()))


@pytest.mark.parametrize("slide", [None, "30 minutes"])
def test_closed_windows_equal_the_batch_counts(spark, tmp_path, slide):
    events = feeds.events(spark, SF).select("ts", "op")
    # File names order the batches, so rows arrive in order of time.
    path = str(tmp_path / "in")
    for day in ("2024-01-01", "2024-01-15", "2024-02-01"):
        part = events.filter((F.col("ts") < day) & (F.col("ts") >= F.lit(day).cast("timestamp") - F.expr("INTERVAL 17 DAYS")))
        part = part.filter(F.col("ts") >= ("2024-01-15" if day == "2024-02-01" else "2000-01-01"))
        part.coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(path)
    counts = windowed_op_counts(stream, "ts", "1 hour", slide, watermark="10 minutes")
    table = ParquetHistory(spark, str(tmp_path / "out"), counts.schema)
    jobs.append_stream(counts, table, str(tmp_path / "c")).awaitTermination()
    closed = events.agg(F.max("ts") - F.expr("INTERVAL 10 MINUTES")).first()[0]
    want = windowed_op_counts(events, "ts", "1 hour", slide).filter(F.col("window_end") <= F.lit(closed))
    assert sorted(map(tuple, table.read().collect())) == sorted(map(tuple, want.collect()))
    assert want.count() > 100


def test_copies_in_one_and_in_later_batches_are_dropped(spark, tmp_path):
    rows = spark.range(2000).select(
        F.lit("t").alias("source_table"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).cast("long").alias("id"),
        F.lit(5).cast("long").alias("ts_ms"),
        F.lit("u").alias("op"),
        F.timestamp_seconds(F.lit(1000)).alias("at"),
        F.col("id").cast("int").alias("copy"),
    )
    stream = stream_of(spark, rows, str(tmp_path / "in"))
    once = dedup_stream(stream, "at", "1 hour")
    table = ParquetHistory(spark, str(tmp_path / "out"), once.schema)
    for _ in range(2):
        jobs.append_stream(once, table, str(tmp_path / "c")).awaitTermination()
    got = [r["id"] for r in table.read().collect()]
    assert len(got) == len(set(got)) and set(got) == {r["id"] for r in rows.collect()}


def test_alerts_on_a_stream(spark, tmp_path):
    from siltlake.operators.quality import delete_alerts

    messages = feeds.messages(spark, SF)
    want = delete_alerts(parse_envelopes(messages)).count()
    alerts = delete_alerts(parse_envelopes(stream_of(spark, messages, str(tmp_path / "in"), 2)))
    table = ParquetHistory(spark, str(tmp_path / "out"), alerts.schema)
    jobs.append_stream(alerts, table, str(tmp_path / "c")).awaitTermination()
    assert table.read().count() == want > 0


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka_changes(spark, "localhost:9092", ["cdc.users"])
