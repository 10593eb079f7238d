"""Casts, classes and sums on edge values."""

import math

import pytest
from pyspark.sql import functions as F

from siltlake.functions import classes, values


def column(spark, kind, items):
    return spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}").coalesce(1)


def apply(spark, kind, items, build):
    df = column(spark, kind, items).select("i", build(F.col("v")).alias("out")).orderBy("i")
    return [r["out"] for r in df.collect()]


def test_classes_at_their_bounds(spark):
    prices = [None, 0.0, 49.99, 50.0, 199.99, 200.0, float("nan")]
    assert apply(spark, "double", prices, classes.price_tier) == [
        "High", "Low", "Low", "Medium", "Medium", "High", "High",
    ]
    assert apply(spark, "double", [None, 99.99, 100.0, 500.0], classes.order_value_tier) == [
        "Large", "Small", "Medium", "Large",
    ]
    labelled = apply(spark, "double", [None, 1.0], lambda c: classes.order_value_tier(c, null_label="Unknown"))
    assert labelled == ["Unknown", "Small"]
    spent = [None, 500.0, 500.01, 1000.0, 1000.01]
    assert apply(spark, "double", spent, classes.user_segment) == ["New", "New", "Regular", "Regular", "Premium"]
    revenue = [1000.0, 1000.01, 5000.01]
    assert apply(spark, "double", revenue, classes.product_class) == ["Average", "Good", "Top Performer"]
    lifetime = [None, 1000.0, 10000.0, 10000.01]
    assert apply(spark, "double", lifetime, classes.lifetime_class) == ["Silver", "Silver", "Gold", "VIP"]


def test_flags_of_unknown_operations(spark):
    ops = ["c", "u", "d", "x", None]
    assert apply(spark, "string", ops, classes.is_active) == [True, True, False, True, True]
    assert apply(spark, "string", ops, classes.is_delete) == [False, False, True, False, None]
    assert apply(spark, "string", ops, classes.quality_score) == [1.0, 1.0, 1.0, 0.0, 0.0]
    assert apply(spark, "string", ops, lambda c: classes.routing_key(F.lit("t"), c))[-1] is None


def test_email_domain(spark):
    found = apply(spark, "string", ["a@x.com", "plain", "a@b@c", None, "a@"], values.email_domain)
    assert found == ["x.com", "", "b@c", None, ""]


def test_lenient_casts(spark):
    texts = ["1", " 2 ", "3.0", "1.7E12", "x", "", None, "9223372036854775808"]
    assert apply(spark, "string", texts, lambda c: values.typed(c, "bigint")) == [
        1, 2, 3, 1_700_000_000_000, None, None, None, None,
    ]
    assert apply(spark, "string", ["1.5", "n/a", None], lambda c: values.typed(c, "double")) == [1.5, None, None]


def test_day_key_floors_before_1970_and_knows_units(spark):
    assert apply(spark, "bigint", [0, -1, None, 1706000000000], values.day_key) == [
        "1970-01-01", "1969-12-31", None, "2024-01-23",
    ]
    assert apply(spark, "bigint", [1706000000], lambda c: values.day_key(c, "s")) == ["2024-01-23"]
    assert apply(spark, "bigint", [1706000000000000], lambda c: values.day_key(c, "us")) == ["2024-01-23"]


def test_exact_sum_is_order_free_and_leaves_no_row_out(spark):
    cents = [0.1] * 1000 + [0.29, -0.01]
    df = column(spark, "double", cents)
    for n in (1, 7):
        assert df.repartition(n).agg(values.exact_sum(F.col("v"))).first()[0] == 100.28
    fine = column(spark, "double", [1.005, 2.0004, 1.1, -1.1]).agg(values.exact_sum(F.col("v"))).first()[0]
    assert fine == 3.0054
    every_cent = spark.range(-100_000, 2_000_000).select((F.col("id") / 100.0).alias("v"), F.col("id"))
    got = every_cent.agg(values.exact_sum(F.col("v")), F.sum("id")).first()
    assert got[0] == got[1] / 100
    huge = column(spark, "double", [1e15, 2.5, None]).agg(
        values.exact_sum(F.col("v")), values.exact_avg(F.col("v"))
    ).first()
    assert huge[0] == 1e15 + 2.5 and huge[1] == (1e15 + 2.5) / 2
    assert column(spark, "double", [None]).agg(values.exact_sum(F.col("v"))).first()[0] is None
    assert column(spark, "double", [None]).agg(values.exact_avg(F.col("v"))).first()[0] is None
    assert math.isnan(column(spark, "double", [1.0, float("nan")]).agg(values.exact_sum(F.col("v"))).first()[0])


def test_large_and_fine_amounts_have_one_sum(spark):
    amounts = [1e14, 0.001, -1e14, 2.125, 1e13, 0.1, 0.2, 3e-6] * 50
    df = column(spark, "double", amounts)
    sums = {df.orderBy(F.rand(seed)).repartition(n).agg(values.exact_sum(F.col("v"))).first()[0] for seed, n in ((1, 2), (2, 7), (3, 1))}
    assert sums == {500_000_000_000_121.30015}


def test_exact_sum_overflow_is_loud(spark):
    df = spark.range(20_000).select(F.lit(9.9e12).alias("v"))
    assert df.agg(values.exact_sum(F.col("v"))).first()[0] == 9.9e12 * 20_000
    with pytest.raises(Exception, match="(?i)overflow|out.of.range"):
        spark.range(4).select(F.lit(9e31).alias("v")).agg(values.exact_sum(F.col("v"))).first()
    with pytest.raises(Exception, match="(?i)overflow|out.of.range"):
        spark.range(1).select(F.lit(1e33).alias("v")).agg(values.exact_sum(F.col("v"))).first()
