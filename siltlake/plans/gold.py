"""Gold marts: pure functions of active silver rows.

Every order aggregate is computed per group before any join, so a user or
product that holds a large share of the orders reaches the join as one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltlake.functions import classes
from siltlake.functions.values import day_key, day_of, day_text, exact_avg, exact_sum
from siltlake.operators.latest import top_product_per_day
from siltlake.spec import ARRIVAL


def active(silver: DataFrame) -> DataFrame:
    return silver.filter(F.col("is_active"))


def user_order_stats(orders: DataFrame) -> DataFrame:
    return orders.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("total_orders"),
        exact_sum(F.col("total_amount")).alias("total_spent"),
        exact_avg(F.col("total_amount")).alias("avg_order_value"),
    )


def user_totals(orders: DataFrame) -> DataFrame:
    """Totals of active orders and of all orders by user, in one pass for both
    marts of users."""
    live = F.col("is_active")
    amount = F.when(live, F.col("total_amount"))
    return orders.groupBy("user_id").agg(
        F.count_if(live).alias("total_orders"),
        exact_sum(amount).alias("total_spent"),
        exact_avg(amount).alias("avg_order_value"),
        F.count("id").alias("all_orders"),
        exact_sum(F.col("total_amount")).alias("lifetime_value"),
    )


def product_order_stats(orders: DataFrame) -> DataFrame:
    return orders.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("total_orders"),
        exact_sum(F.col("total_amount")).alias("total_revenue"),
        F.count_distinct("user_id").alias("unique_customers"),
    )


def daily_sales(orders: DataFrame, unit: str = "ms") -> DataFrame:
    return _with_day_text(_sales_by_day(orders, unit))


def daily_product_revenue(orders: DataFrame, unit: str = "ms") -> DataFrame:
    return _with_day_text(_product_revenue_by_day(orders, unit))


def _sales_by_day(orders: DataFrame, unit: str) -> DataFrame:
    """Grouped by DATE: four bytes to hash and shuffle, and the text is made
    once per day instead of once per order."""
    return orders.groupBy(day_of(F.col("created_at"), unit).alias("date_key")).agg(
        F.count(F.lit(1)).alias("total_orders"),
        exact_sum(F.col("total_amount")).alias("total_revenue"),
        exact_avg(F.col("total_amount")).alias("avg_order_value"),
        F.count_distinct("user_id").alias("unique_customers"),
    )


def _product_revenue_by_day(orders: DataFrame, unit: str) -> DataFrame:
    return orders.groupBy(day_of(F.col("created_at"), unit).alias("date_key"), "product_id").agg(
        exact_sum(F.col("total_amount")).alias("product_revenue")
    )


def _with_day_text(df: DataFrame) -> DataFrame:
    return df.withColumn("date_key", day_text(F.col("date_key")))


def user_analytics(
    users: DataFrame, orders: DataFrame, refreshed: Column, bounds=classes.USER_SEGMENTS, unit: str = "ms"
) -> DataFrame:
    """One row per active user with order totals and segment."""
    return user_analytics_from(users, user_totals(orders), refreshed, bounds, unit)


def user_analytics_from(
    users: DataFrame, totals: DataFrame, refreshed: Column, bounds=classes.USER_SEGMENTS, unit: str = "ms"
) -> DataFrame:
    """``user_analytics`` from ``user_totals``."""
    stats = totals.withColumnRenamed("user_id", "_user")
    registered = F.coalesce(
        day_key(F.col("created_at"), unit), F.date_format(F.col(ARRIVAL), "yyyy-MM-dd")
    )
    spent = _or_zero("total_spent", 0.0)
    joined = active(users).join(stats, F.col("id") == F.col("_user"), "left")
    return joined.select(
        F.col("id").alias("user_id"),
        F.col("name").alias("full_name"),
        "email_domain",
        registered.alias("registration_date"),
        _or_zero("total_orders", 0).alias("total_orders"),
        spent.alias("total_spent"),
        _or_zero("avg_order_value", 0.0).alias("avg_order_value"),
        classes.user_segment(spent, bounds).alias("user_segment"),
        F.col(ARRIVAL).alias("last_activity"),
        refreshed.cast("timestamp").alias("refresh_date"),
    )


def product_analytics(
    products: DataFrame, orders: DataFrame, refreshed: Column, bounds=classes.PRODUCT_CLASSES
) -> DataFrame:
    """One row per active product with order totals and performance class."""
    return product_analytics_from(products, product_order_stats(active(orders)), refreshed, bounds)


def product_analytics_from(
    products: DataFrame, totals: DataFrame, refreshed: Column, bounds=classes.PRODUCT_CLASSES
) -> DataFrame:
    """``product_analytics`` from ``product_order_stats`` of active orders."""
    stats = totals.withColumnRenamed("product_id", "_product")
    revenue = _or_zero("total_revenue", 0.0)
    joined = active(products).join(stats, F.col("id") == F.col("_product"), "left")
    return joined.select(
        F.col("id").alias("product_id"),
        F.col("name").alias("product_name"),
        "category",
        "price",
        _or_zero("total_orders", 0).alias("total_orders"),
        revenue.alias("total_revenue"),
        _or_zero("unique_customers", 0).alias("unique_customers"),
        classes.product_class(revenue, bounds).alias("performance_category"),
        refreshed.cast("timestamp").alias("refresh_date"),
    )


def sales_summary(orders: DataFrame, refreshed: Column, unit: str = "ms") -> DataFrame:
    """One row per day with totals and the product of highest revenue.

    Orders without a creation time form a row with an unknown day, whose top
    product is 0.
    """
    live = active(orders)
    best = top_product_per_day(_product_revenue_by_day(live, unit))
    return (
        _sales_by_day(live, unit)
        .join(best, "date_key", "left")
        .select(
            day_text(F.col("date_key")).alias("date_key"),
            "total_orders",
            "total_revenue",
            "avg_order_value",
            "unique_customers",
            _or_zero("top_product", 0).alias("top_product"),
            refreshed.cast("timestamp").alias("refresh_date"),
        )
    )


def user_stats(users: DataFrame, orders: DataFrame, bounds=classes.LIFETIME_CLASSES) -> DataFrame:
    """Lifetime value and class per active user.

    All orders count, cancelled ones too; only users are filtered. The value
    is NULL for a user without orders.
    """
    return user_stats_from(users, user_totals(orders), bounds)


def user_stats_from(users: DataFrame, totals: DataFrame, bounds=classes.LIFETIME_CLASSES) -> DataFrame:
    """``user_stats`` from ``user_totals``."""
    per_user = totals.select(F.col("user_id").alias("_user"), "all_orders", "lifetime_value")
    joined = active(users).join(per_user, F.col("id") == F.col("_user"), "left")
    return joined.select(
        "id",
        "name",
        _or_zero("all_orders", 0).alias("total_orders"),
        "lifetime_value",
        classes.lifetime_class(F.col("lifetime_value"), bounds).alias("segment"),
    )


def _or_zero(name: str, zero: int | float) -> Column:
    value = F.lit(zero) if isinstance(zero, float) else F.lit(zero).cast("bigint")
    return F.coalesce(F.col(name), value)
