"""Partial row images and undeclared fields."""

import functools
import itertools
import json
import operator

import pytest
from pyspark.sql import functions as F

from siltlake.operators.merge import HARD, merge_changes, merge_latest, prepare_changes
from siltlake.plans.layers import append_bronze, evolve_silver, merge_new_bronze
from siltlake.sources import drift, flat
from siltlake.sources.envelope import parse_envelopes, table_changes
from siltlake.spec import CELLS, REST, UNSENT, USERS
from siltlake.streaming import jobs
import samples

GAP = "__gap"
PARTIAL = USERS.with_options(placeholder=GAP)
CAPTURE = USERS.with_options(capture=True)


def now():
    return F.lit("2024-03-01 00:00:00").cast("timestamp")


# -- partial images ---------------------------------------------------------------

# (id, name, email, op, time, position)
HISTORY = [
    (1, "a", "a@x", "c", 1, 1), (1, GAP, "b@y", "u", 2, 2), (1, "c", GAP, "u", 3, 3), (1, GAP, GAP, "u", 4, 4),
    (2, GAP, "p@q", "c", 1, 5), (2, None, GAP, "u", 2, 6), (2, GAP, GAP, "d", 3, 7),
    (3, GAP, GAP, "u", 1, 8), (4, "s", "s@t", "c", 5, 9), (4, "t", GAP, "u", 5, 10), (4, GAP, "u@v", "u", None, 11),
]
WANT = {
    1: ("c", "b@y", "y", "u", 4, True), 2: (None, "p@q", "q", "d", 3, False),
    3: (None, None, None, "u", 1, True), 4: ("t", "s@t", "t", "u", 5, True),
}


def changes(spark, rows):
    raw = spark.createDataFrame(
        [(str(i), n, e, "0", "0", o, None if t is None else str(t), json.dumps({"lsn": p})) for i, n, e, o, t, p in rows],
        "id string, name string, email string, created_at string, updated_at string, __op string, __ts_ms string, __source string",
    )
    return flat.normalise(raw, PARTIAL, now())


def state(df):
    rows = df.select("id", "name", "email", "email_domain", "op", "ts_ms", "is_active").collect()
    return {r["id"]: tuple(r)[1:] for r in rows}


def test_a_value_that_was_left_out_keeps_the_last_one_sent(spark):
    bronze = changes(spark, HISTORY)
    unsent = {r["_position"]: r[UNSENT] for r in bronze.collect()}
    assert unsent[1] is None and unsent[2] == ["name"] and unsent[4] == ["name", "email"]
    assert bronze.filter((F.col("name") == GAP) | (F.col("email") == GAP)).count() == 0
    assert state(prepare_changes(bronze, PARTIAL, now())) == WANT


@pytest.mark.parametrize("seed", range(4))
def test_no_split_changes_the_state(spark, seed):
    import random

    rng = random.Random(seed)
    rows = HISTORY + [(1, "zz", "z@z", "u", 2, 20), (5, rng.choice(["k", GAP]), "k@k", "c", 7, 21)]
    want = state(prepare_changes(changes(spark, rows), PARTIAL, now()))
    rng.shuffle(rows)
    merged = spark.createDataFrame([], PARTIAL.silver_schema())
    for part in (rows[:4], rows[4:9], rows[9:], rows[2:6]):  # some are delivered twice
        merged = merge_changes(merged, changes(spark, part), PARTIAL, now())
    assert state(merged) == want


def test_partial_images_through_stored_tables_and_topics(spark, lake):
    silver = lake.silver(PARTIAL)
    for number, part in enumerate((HISTORY[6:], HISTORY[:6])):
        append_bronze(lake.bronze(PARTIAL), changes(spark, part), "s", number)
        merge_new_bronze(lake.bronze(PARTIAL), silver, PARTIAL, now())
    assert state(silver.read()) == WANT and CELLS in silver.read().columns
    image = json.dumps({"op": "u", "after": {"id": 1, "name": GAP, "email": "n@n"}, "source": {"table": "users"}, "ts_ms": 9})
    events = parse_envelopes(samples.messages_frame(spark, [("cdc.users", 0, 1, 0, image)]), processed_at=now())
    row = table_changes(events, PARTIAL).first()
    assert (row["name"], row["email"], row[UNSENT]) == (None, "n@n", ["name"])


def test_rows_with_gaps_cannot_be_removed(spark):
    one = prepare_changes(changes(spark, HISTORY), PARTIAL, now())
    with pytest.raises(ValueError, match="partial images"):
        merge_latest(one, one, PARTIAL, HARD)


# -- drift ------------------------------------------------------------------------


def lines(spark, rows):
    return spark.createDataFrame([(x if isinstance(x, str) else json.dumps(x),) for x in rows], "value string")


def test_every_field_is_kept_with_its_type(spark):
    rows = [
        {"id": 1, "name": "a", "tier": "x", "n": 5, "big": 2**70, "f": 1.5, "b": True, "o": {"k": [1]}, "z": None},
        {"id": "2", "__op": "c", "__ts_ms": 7},
        "not json", "", '{"id":3,"Tier":"y","ünï çødé":1}', "[1]",
    ]
    got = flat.normalise(flat.parse_lines(lines(spark, rows), CAPTURE), CAPTURE, now()).collect()
    assert len(got) == 5
    kept = {r["id"]: r[REST] for r in got if r["id"]}
    assert kept[1] == {"tier": '"x"', "n": "5", "big": str(2**70), "f": "1.5", "b": "true", "o": '{"k":[1]}', "z": "null"}
    assert kept[2] is None and kept[3] == {"Tier": '"y"', "ünï çødé": "1"}
    assert [r["_corrupt_record"] for r in got if r["id"] is None][0] == "not json"


KINDS = {"true": "boolean", "12": "bigint", "-3": "bigint", str(2**60): "bigint", "1.5": "double", "1E3": "double",
         '"12"': "string", "[]": "string", "{}": "string", str(2**70): "string", "null": None}


def test_kinds_join_to_the_least_type_that_holds_them(spark):
    tokens = spark.createDataFrame([(t,) for t in KINDS], "t string")
    bits = {r["t"]: r["b"] for r in tokens.select("t", drift.kind_bits(F.col("t")).alias("b")).collect()}
    assert {t: drift.join_kinds(b) for t, b in bits.items()} == KINDS
    join = lambda *ts: drift.join_kinds(functools.reduce(operator.or_, (bits[t] for t in ts)))
    assert join("12", "1.5") == "double" and join("12", "null") == "bigint" and join("true", "12") == "string"
    assert join(str(2**60), "1.5") == "string" and join(str(2**60), "12") == "bigint" and join("{}", "[]") == "string"
    order = {"boolean": 0, "bigint": 0, "double": 1, "string": 2}
    for a, b, c in itertools.product(KINDS, repeat=3):  # more values never give a narrower type
        if join(a, b) and order[join(a, b)] > order[join(a, b, c)]:
            raise AssertionError((a, b, c))


def test_promotion_and_old_files(spark, lake, tmp_path):
    raw, checkpoint = tmp_path / "raw", str(tmp_path / "checkpoint")
    raw.mkdir()
    bronze = lambda: lake.bronze(CAPTURE)

    def deliver(name, rows):
        (raw / name).write_text("\n".join(json.dumps({"__op": "c", "__ts_ms": 1, **r}) for r in rows))
        jobs.ingest_bronze(lake, CAPTURE, str(raw), checkpoint).awaitTermination()

    policy = drift.Promotion(least_rows=2, least_share=0.3)
    deliver("0.json", [{"id": i, "name": "a"} for i in range(4)])
    assert drift.promote(CAPTURE, drift.profile(bronze().read()), 4, policy) == CAPTURE
    deliver("1.json", [{"id": 10 + i, "score": i, "is_active": True, "rare": 1} for i in range(4)][:3] + [{"id": 13, "score": None}])
    first = drift.promote(CAPTURE, drift.profile(bronze().read()), 8, policy)
    assert first.promoted == (("rare", "bigint"), ("score", "bigint"))  # a name of silver's own is not taken
    merge_new_bronze(bronze(), lake.silver(first), first, now())
    assert {r["id"]: r["score"] for r in lake.silver(first).read().collect()}[12] == 2
    deliver("2.json", [{"id": 20 + i, "score": i + 0.5} for i in range(4)])
    second = drift.promote(first, drift.profile(bronze().read()), 12, policy)
    assert dict(second.promoted)["score"] == "double"
    with pytest.raises(ValueError, match="other columns"):
        merge_new_bronze(bronze(), lake.silver(second), second, now())
    evolve_silver(bronze(), lake.silver(second), second, now())
    merge_new_bronze(bronze(), lake.silver(second), second, now())
    got = {r["id"]: r["score"] for r in lake.silver(second).read().collect()}
    assert got == {0: None, 1: None, 2: None, 3: None, 10: 0.0, 11: 1.0, 12: 2.0, 13: None, 20: 0.5, 21: 1.5, 22: 2.5, 23: 3.5}
    assert bronze().read().filter(f"{REST}['rare'] IS NOT NULL").count() == 3


def test_undeclared_fields_of_messages(spark):
    image = json.dumps({"op": "c", "after": {"id": 1, "name": "n", "vip": True}, "source": {"table": "users"}, "ts_ms": 9})
    events = parse_envelopes(samples.messages_frame(spark, [("cdc.users", 0, 1, 0, image)]), processed_at=now())
    assert table_changes(events, CAPTURE).first()[REST] == {"vip": "true"}
