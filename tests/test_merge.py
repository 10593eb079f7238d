"""Latest rows and the keyed merge, rule by rule and by random histories."""

import random

import pytest
from pyspark.sql import functions as F

from siltlake.operators.diff import snapshot_diff
from siltlake.operators.latest import latest_per_key, top_product_per_day
from siltlake.operators.merge import merge_changes, merge_latest, prepare_changes
from siltlake.spec import USERS

SCHEMA = (
    "id bigint, name string, email string, created_at bigint, updated_at bigint, op string, ts_ms bigint, "
    "processed_at timestamp, _position bigint"
)


def changes(spark, rows):
    """Rows of (id, name, op, ts_ms[, position])."""
    full = [(r[0], r[1], "a@b", 0, 0, r[2], r[3], None, r[4] if len(r) > 4 else 0) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def now():
    return F.timestamp_seconds(F.lit(0))


def state(df):
    rows = df.select("id", "name", "op", "ts_ms", "is_active").collect()
    return {r["id"]: tuple(r)[1:] for r in rows}


def run(spark, old, new, **options):
    target = prepare_changes(changes(spark, old), USERS, now())
    return state(merge_latest(target, prepare_changes(changes(spark, new), USERS, now()), USERS, **options))


def test_latest_breaks_ties_and_puts_unknown_times_last(spark):
    rows = [(1, "a", "c", 5, 1), (1, "b", "u", 5, 2), (2, "x", "c", None, 9), (2, "y", "u", 1, 1), (3, "z", "c", None)]
    found = {r["id"]: r["name"] for r in latest_per_key(changes(spark, rows)).collect()}
    assert found == {1: "b", 2: "y", 3: "z"}


def test_top_product_tie_goes_to_the_smaller_id(spark):
    df = spark.createDataFrame(
        [("d1", 2, 5.0), ("d1", 1, 5.0), ("d1", 3, 1.0), ("d2", 7, None), (None, 4, 1.0)],
        "date_key string, product_id bigint, product_revenue double",
    )
    assert {r[0]: r[1] for r in top_product_per_day(df).collect()} == {"d1": 1, "d2": 7, None: 4}


def test_soft_rules(spark):
    old = [(1, "a", "c", 10), (2, "b", "c", 10), (3, "c", "c", 10), (4, "e", "c", None), (5, "f", "c", 10), (8, "h", "c", 1)]
    new = [
        (1, "a2", "u", 11),
        (2, "late", "d", 5),
        (3, "late", "u", 10),
        (4, "g", "u", 99),
        (5, "gone", "d", 12),
        (6, "new", "c", 1),
        (7, "tomb", "d", 1),
        (None, "no key", "c", 1),
    ]
    assert run(spark, old, new) == {
        1: ("a2", "u", 11, True),
        2: ("b", "d", 10, False),
        3: ("c", "c", 10, True),
        4: ("e", "c", None, True),
        5: ("gone", "d", 12, False),
        6: ("new", "c", 1, True),
        7: ("tomb", "d", 1, False),
        8: ("h", "c", 1, True),
    }


def test_late_delete_ignored(spark):
    old = [(2, "b", "c", 10, 5), (3, "c", "c", 10, 5), (4, "d", "c", 10, 5)]
    new = [(2, "late", "d", 5, 9), (3, "tie", "d", 10, 6), (4, "tie", "d", 10, 4)]
    assert run(spark, old, new, late_delete="ignore") == {
        2: ("b", "c", 10, True),
        3: ("tie", "d", 10, False),
        4: ("d", "c", 10, True),
    }


def test_a_late_update_does_not_revive(spark):
    assert run(spark, [(1, "a", "d", 10)], [(1, "b", "u", 9)]) == {1: ("a", "d", 10, False)}
    assert run(spark, [(1, "a", "d", 10)], [(1, "b", "u", 11)]) == {1: ("b", "u", 11, True)}


def test_hard_rules(spark):
    old = [(1, "a", "c", 10), (2, "b", "c", 10), (3, "c", "c", 10), (6, "f", "c", 10)]
    new = [(1, "older", "u", 1), (2, "x", "d", 1), (3, "x", None, 99), (4, "new", "c", 1), (5, "tomb", "d", 1)]
    found = run(spark, old, new, delete_mode="hard")
    assert {k: v[0] for k, v in found.items()} == {1: "older", 3: "c", 4: "new", 6: "f"}


def random_history(seed, keys=40, size=400):
    rng = random.Random(seed)
    return [
        (rng.randrange(keys), f"n{i}", rng.choice("cuud"), rng.randrange(60), i) for i in range(size)
    ]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_ignoring_late_deletes_any_split_gives_the_same_state(spark, lake, seed):
    history = random_history(seed)
    want = state(prepare_changes(changes(spark, history), USERS, now()))
    shuffled = history[:]
    random.Random(seed + 100).shuffle(shuffled)
    cuts = sorted(random.Random(seed).sample(range(1, len(history)), 2))
    target = spark.createDataFrame([], USERS.silver_schema())
    for part in (shuffled[: cuts[0]], shuffled[cuts[0] : cuts[1]], shuffled[cuts[1] :]):
        target = merge_changes(target, changes(spark, part), USERS, now(), late_delete="ignore")
    got = state(target)
    assert got == want
    assert target.count() == len(got) == len({k for k, *_ in history})


def test_merge_is_idempotent(spark):
    history = changes(spark, random_history(9))
    once = prepare_changes(history, USERS, now())
    twice = merge_changes(once, history, USERS, now())
    assert state(twice) == state(once)
    assert twice.filter("is_active").count() + twice.filter("NOT is_active").count() == once.count()


def test_both_sides_are_shuffled_once(spark, tmp_path):
    path = str(tmp_path / "silver")
    prepare_changes(changes(spark, [(i, "a", "c", 1) for i in range(9)]), USERS, now()).write.parquet(path)
    target = spark.read.parquet(path)

    plan = merge_latest(target, target, USERS)._jdf.queryExecution().executedPlan().toString()
    assert "FullOuter" in plan and plan.count("Exchange hashpartitioning") == 2


def flat_changes(spark, rows):
    """Rows of (id, name, op, ts_ms, position or None) as flat records."""
    from siltlake.sources.flat import normalise

    raw = spark.createDataFrame(
        [(i, n, "a@b", o, str(t), None if p is None else f'{{"db":"shop","lsn":{p}}}') for i, n, o, t, p in rows],
        "id long, name string, email string, __op string, __ts_ms string, __source string",
    )
    return normalise(raw, USERS, now())


SAME_INSTANT = [
    ([(1, "Zed", "c", 5, 10), (1, "Ann", "u", 5, 11)], ("Ann", True)),
    ([(1, "Zed", "u", 5, 10), (1, "Zed", "d", 5, 11)], ("Zed", False)),
    ([(1, "Ann", "d", 5, 10), (1, "Zed", "c", 5, 11)], ("Zed", True)),
    ([(1, "Ann", "u", 5, None), (1, "Ann", "d", 5, None)], ("Ann", False)),
    ([(1, "Zed", "c", 5, None), (1, "Ann", "u", 5, None)], ("Zed", True)),
]


@pytest.mark.parametrize("rows, want", SAME_INSTANT)
@pytest.mark.parametrize("backwards", [False, True])
def test_changes_of_one_instant_keep_their_order(spark, rows, want, backwards):
    rows = rows[::-1] if backwards else rows
    whole = prepare_changes(flat_changes(spark, rows), USERS, now())
    split = spark.createDataFrame([], USERS.silver_schema())
    for row in rows:
        split = merge_changes(split, flat_changes(spark, [row]), USERS, now(), late_delete="ignore")
    for df in (whole, split):
        assert [(r["name"], r["is_active"]) for r in df.collect()] == [want]


def test_a_later_position_of_the_same_instant_replaces(spark):
    old, new = [(1, "a", "c", 10, 5), (2, "b", "c", 10, 5)], [(1, "a2", "u", 10, 6), (2, "b2", "u", 10, 4)]
    assert run(spark, old, new) == {1: ("a2", "u", 10, True), 2: ("b", "c", 10, True)}


@pytest.mark.parametrize("seed", [1, 2])
def test_any_split_of_files_gives_the_same_state(spark, lake, tmp_path, seed):
    import samples
    from siltlake.streaming.jobs import ingest_files

    rng = random.Random(seed)
    history = [(rng.randrange(12), f"n{i}", rng.choice("cuud"), rng.randrange(4), i) for i in range(120)]
    want = state(prepare_changes(flat_changes(spark, history), USERS, now()))
    records = [
        {"id": i, "name": n, "email": "a@b", "__op": o, "__ts_ms": t, "__source": {"db": "shop", "lsn": p}}
        for i, n, o, t, p in history
    ]
    rng.shuffle(records)
    for part in range(3):
        samples.land(tmp_path / "raw", "users", f"{part}.json", records[part::3])
    query = ingest_files(
        lake, USERS, str(tmp_path / "raw/users"), str(tmp_path / "c"), late_delete="ignore", max_files_per_trigger=1
    )
    query.awaitTermination()
    assert state(lake.silver(USERS).read()) == want


def test_a_hot_key_is_reduced_before_the_shuffle(spark):
    rows = spark.range(0, 90_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("bigint").alias("id"),
        F.lit("n").alias("name"),
        F.lit("u").alias("op"),
        F.col("id").alias("ts_ms"),
        F.col("id").alias("_position"),
    )
    latest = latest_per_key(rows)
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" in plan and "partial_max" in plan and "Window" not in plan
    assert latest.filter("id = 7").first()["ts_ms"] == 89_997


def test_snapshot_diff(spark):
    before = spark.createDataFrame([(1, "a", 1), (2, "b", None), (3, "c", 3), (4, None, 4)], "id int, v string, n int")
    after = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (4, None, 4), (5, "e", 5)], "id int, v string, n int")
    found = snapshot_diff(before, after, "id", F.lit(9))
    assert sorted((r["op"], r["id"], r["v"], r["n"], r["ts_ms"]) for r in found.collect()) == [
        ("c", 5, "e", 5, 9),
        ("d", 3, "c", 3, 9),
        ("u", 2, "b", 2, 9),
    ]
    wider = snapshot_diff(before, before.withColumn("extra", F.lit("x")), "id", F.lit(9))
    assert wider.filter("op = 'u'").count() == 4


def test_merging_the_difference_of_snapshots_gives_the_later_one(spark):
    from siltlake.sources.flat import normalise

    before = spark.createDataFrame([(1, "a", "x@y"), (2, "b", None), (3, "c", "z")], "id long, name string, email string")
    after = spark.createDataFrame([(1, "a", "x@y"), (2, "b", "new@y"), (4, "d", "w")], "id long, name string, email string")
    empty = spark.createDataFrame([], before.schema)

    def feed(old, new, ts):
        return normalise(snapshot_diff(old, new, "id", F.lit(ts)), USERS, now())

    state_before = prepare_changes(feed(empty, before, 1), USERS, now())
    merged = merge_changes(state_before, feed(before, after, 2), USERS, now())
    live = merged.filter("is_active").select("id", "name", "email")
    assert sorted(map(tuple, live.collect())) == sorted(map(tuple, after.collect()))
    assert merged.filter("NOT is_active").first()["id"] == 3
