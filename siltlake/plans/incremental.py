"""Marts of orders that are kept up with signed deltas instead of being computed anew.

Each commit of silver feeds the rows it took out and put in. A total adds, for each
group, what the rows put in contribute and subtracts what those taken out did; a
group without rows goes. Only buckets with touched groups are rewritten.

Counts of different customers need to know when the last order of one goes: a table
of multiplicities counts the orders of each (group, customer), and feeds its own
commits; a customer counts where the multiplicity is not zero, so the number of
customers is a total over that feed.

A total remembers the last commit it has taken. If it fails in between, it takes the
same deltas again; if the feed does not go back that far, it starts from the table.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from siltlake.functions import classes
from siltlake.functions.values import AMOUNT_SCALE, day_of, day_text
from siltlake.operators.latest import top_product_per_day
from siltlake.operators.totals import add_totals
from siltlake.plans import gold
from siltlake.plans.lake import Lake
from siltlake.session import sized_session
from siltlake.spec import BUCKET, SIGN, TableSpec
from siltlake.tables.store import ParquetState

# The rows of a group; a group without any is not kept.
ROWS = "rows"
MARK = "source"


class Totals:
    """Sums by group over a state that feeds its commits.

    ``keys`` and ``sums`` are expressions over its rows; ``rows`` counts those that
    ``only`` lets pass. Sums are exact: whole numbers or decimals.
    """

    def __init__(
        self,
        lake: Lake,
        name: str,
        source: ParquetState,
        keys: Mapping[str, Column],
        sums: Mapping[str, Column] | None = None,
        only: Column | None = None,
        buckets: int = 16,
    ):
        self.source = source
        self.keys = dict(keys)
        self.sums = {ROWS: F.lit(1).cast("bigint"), **(sums or {})}
        self.only = only
        self.buckets = buckets
        self.table = ParquetState(lake.spark, f"{lake.root}/totals_{name}", source.read().schema, buckets=True)

    def contributions(self, rows: DataFrame) -> DataFrame:
        """What signed rows add to each group, groups that stay as they are left out."""
        signed = rows if self.only is None else rows.filter(self.only)
        keyed = signed.select(*[c.alias(k) for k, c in self.keys.items()], *[c.alias(s) for s, c in self.sums.items()], SIGN)
        sums = [F.sum(F.when(F.col(SIGN) < 0, -F.col(s)).otherwise(F.col(s))).cast(_wide(keyed.schema[s].dataType)).alias(s) for s in self.sums]
        found = keyed.groupBy(*self.keys).agg(*[F.coalesce(s, F.lit(0)).alias(name) for s, name in zip(sums, self.sums)])
        changed = reduce(lambda a, b: a | b, [F.col(s) != 0 for s in self.sums])
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int").alias(BUCKET)
        return found.filter(changed).select("*", bucket)

    def update(self) -> int:
        """Take the commits that came since the last time; returns how many buckets
        were rewritten."""
        upto, done = self.source.number(), self.table.marks().get(MARK)
        if done == upto:
            return 0
        before = self.table.folders()
        if done is None or done < self.source.fed_from():
            session = sized_session(self.source.spark, self.source.stored_bytes())
            whole = self.contributions(self.source.on(session).read().withColumn(SIGN, F.lit(1).cast("bigint")))
            self.table.rebuild(whole.filter(F.col(ROWS) != 0), {MARK: upto}, self.buckets)
        else:
            add = partial(add_totals, keys=list(self.keys), sums=list(self.sums), rows=ROWS)
            self.table.fold(self.contributions(self.source.deltas_since(done)), add, {MARK: upto}, self.buckets)
        return len({b for b, folder in self.table.folders().items() if before.get(b) != folder} | (set(before) - set(self.table.folders())))

    def read(self) -> DataFrame:
        return self.table.read().drop(BUCKET)


def _wide(kind: DataType) -> str:
    return f"decimal(38,{AMOUNT_SCALE})" if kind.simpleString().startswith("decimal") else "bigint"


class OrderMarts:
    """The marts of ``plans/gold.py`` that orders decide, from totals.

    All totals are updated together; the feeds are then cut off behind them.
    """

    def __init__(self, lake: Lake, orders: TableSpec):
        self.silver = lake.silver(orders)
        amount, live = F.col("total_amount"), F.col("is_active")
        day = day_of(F.col("created_at"), orders.epoch_unit)
        finite = F.abs(amount) < F.lit(float("inf"))
        exact = F.when(finite, amount).cast(f"decimal(38,{AMOUNT_SCALE})")
        money = {
            "amounts": F.when(amount.isNotNull(), 1).otherwise(0).cast("bigint"),
            "odd": F.when(~finite, 1).otherwise(0).cast("bigint"),
            "amount": F.coalesce(exact, F.lit(0)),
        }
        # Users' marts also count orders that are not live any more.
        live_only = {f"live_{name}": F.when(live, value).otherwise(F.lit(0)) for name, value in money.items()}
        users = {**money, "orders": F.when(F.col("id").isNotNull(), 1).otherwise(0).cast("bigint"), **live_only}
        users["live"] = F.when(live, 1).otherwise(0).cast("bigint")
        of, n = {"user_id": F.col("user_id")}, orders.buckets
        self.by_user = Totals(lake, "user", self.silver, of, users, buckets=n)
        self.by_day_product = Totals(lake, "day_product", self.silver, {"date_key": day, "product_id": F.col("product_id")}, money, live, n)
        bought = live & F.col("user_id").isNotNull()
        self.day_users = Totals(lake, "day_user", self.silver, {"date_key": day, **of}, only=bought, buckets=n)
        self.product_users = Totals(lake, "product_user", self.silver, {"product_id": F.col("product_id"), **of}, only=bought, buckets=n)
        self.first = [self.by_user, self.by_day_product, self.day_users, self.product_users]
        self.lake = lake

    def update(self) -> dict[str, int]:
        """Take all new commits of silver; how many buckets each total rewrote."""
        of_day, of_product = self._customers()
        chains = [[self.by_user], [self.by_day_product], [self.day_users, of_day], [self.product_users, of_product]]
        self.silver.feed()
        inherit = inheritable_thread_target(self.lake.spark)
        with ThreadPoolExecutor(len(chains)) as pool:
            futures = [pool.submit(inherit(_update_in_turn), chain) for chain in chains]
            written = {name: buckets for future in futures for name, buckets in future.result().items()}
        for source, readers in ((self.silver, self.first), (self.day_users.table, self._customers()[:1]), (self.product_users.table, self._customers()[1:])):
            source.forget_deltas(min(reader.table.marks()[MARK] for reader in readers))
        return written

    def _customers(self) -> list[Totals]:
        """Different customers: rows of the multiplicities, whatever they count."""
        return [
            Totals(self.lake, "day_customers", self.day_users.table, {"date_key": F.col("date_key")}, buckets=self.day_users.buckets),
            Totals(self.lake, "product_customers", self.product_users.table, {"product_id": F.col("product_id")}, buckets=self.day_users.buckets),
        ]

    def sales_summary(self, refreshed: Column) -> DataFrame:
        revenue = self.by_day_product.read().select("date_key", "product_id", _money("").alias("product_revenue"))
        customers = self._customers()[0].read().select(F.col("date_key").alias("_day"), F.col(ROWS).alias("unique_customers"))
        best = top_product_per_day(revenue).withColumnRenamed("date_key", "_best_day")
        return (
            self._summed("date_key").join(customers, F.col("date_key").eqNullSafe(F.col("_day")), "left")
            .join(best, F.col("date_key") == F.col("_best_day"), "left")
            .select(
                day_text(F.col("date_key")).alias("date_key"),
                F.col(ROWS).alias("total_orders"),
                _money("").alias("total_revenue"),
                _mean("").alias("avg_order_value"),
                F.coalesce("unique_customers", F.lit(0).cast("bigint")).alias("unique_customers"),
                F.coalesce("top_product", F.lit(0).cast("bigint")).alias("top_product"),
                refreshed.cast("timestamp").alias("refresh_date"),
            )
        )

    def _summed(self, key: str) -> DataFrame:
        """Totals of days, or of products, from those of both."""
        return self.by_day_product.read().groupBy(key).agg(*[F.sum(s).alias(s) for s in self.by_day_product.sums])

    def product_stats(self) -> DataFrame:
        customers = self._customers()[1].read().select(F.col("product_id").alias("_product"), F.col(ROWS).alias("unique_customers"))
        return self._summed("product_id").join(customers, F.col("product_id").eqNullSafe(F.col("_product")), "left").select(
            "product_id",
            F.col(ROWS).alias("total_orders"),
            _money("").alias("total_revenue"),
            F.coalesce("unique_customers", F.lit(0).cast("bigint")).alias("unique_customers"),
        )

    def user_totals(self) -> DataFrame:
        """As ``gold.user_totals`` has them."""
        return self.by_user.read().select(
            "user_id",
            F.col("live").alias("total_orders"),
            _money("live_").alias("total_spent"),
            _mean("live_").alias("avg_order_value"),
            F.col("orders").alias("all_orders"),
            _money("").alias("lifetime_value"),
        )

    def refresh(self, specs: Mapping[str, TableSpec], refreshed: Column) -> dict[str, int]:
        """Bring totals up to date and write the marts from them and from silver
        users and products; no order is read. Returns the rows written."""
        self.update()
        users, products = (self.lake.silver_if_present(specs[name]) for name in ("users", "products"))
        marts = {"sales_summary": self.sales_summary(refreshed)}
        if users is not None:
            totals = self.user_totals()
            marts["user_analytics"] = gold.user_analytics_from(users, totals, refreshed, classes.USER_SEGMENTS, specs["users"].epoch_unit)
            marts["user_stats"] = gold.user_stats_from(users, totals)
        if products is not None:
            marts["product_analytics"] = gold.product_analytics_from(products, self.product_stats(), refreshed)
        return {name: self.lake.gold(name).replace(frame) for name, frame in marts.items()}


def _update_in_turn(chain: list[Totals]) -> dict[str, int]:
    """Each total of a chain reads the feed of the one before."""
    written = {}
    for total in chain:
        total.source.feed()
        written[total.table.name] = total.update()
    return written


def _money(prefix: str) -> Column:
    """As ``exact_sum``: NULL without amounts, NaN if any is no number."""
    total = F.when(F.col(f"{prefix}amounts") > 0, F.col(f"{prefix}amount").cast("double"))
    every_odd = F.col(f"{prefix}odd") > 0
    return F.when(every_odd, F.lit(float("nan"))).otherwise(total)


def _mean(prefix: str) -> Column:
    return _money(prefix) / F.nullif(F.col(f"{prefix}amounts"), F.lit(0)).cast("double")
