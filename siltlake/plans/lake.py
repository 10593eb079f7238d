"""Names and places of the layer tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from siltlake.operators.profile import PROFILE_COLUMNS
from siltlake.spec import BATCH, DAY, SPECS, STREAM, TableSpec, schema_of
from siltlake.tables import ParquetHistory, ParquetState
from siltlake.tables.catalog import CatalogTable, create_gold_sql, create_layer_sql, create_table_sql

GOLD_COLUMNS = {
    "user_analytics": [
        ("user_id", "bigint"),
        ("full_name", "string"),
        ("email_domain", "string"),
        ("registration_date", "string"),
        ("total_orders", "bigint"),
        ("total_spent", "double"),
        ("avg_order_value", "double"),
        ("user_segment", "string"),
        ("last_activity", "timestamp"),
        ("refresh_date", "timestamp"),
    ],
    "product_analytics": [
        ("product_id", "bigint"),
        ("product_name", "string"),
        ("category", "string"),
        ("price", "double"),
        ("total_orders", "bigint"),
        ("total_revenue", "double"),
        ("unique_customers", "bigint"),
        ("performance_category", "string"),
        ("refresh_date", "timestamp"),
    ],
    "sales_summary": [
        ("date_key", "string"),
        ("total_orders", "bigint"),
        ("total_revenue", "double"),
        ("avg_order_value", "double"),
        ("unique_customers", "bigint"),
        ("top_product", "bigint"),
        ("refresh_date", "timestamp"),
    ],
    "user_stats": [
        ("id", "bigint"),
        ("name", "string"),
        ("total_orders", "bigint"),
        ("lifetime_value", "double"),
        ("segment", "string"),
    ],
}
RUN_AUDIT_COLUMNS = [
    ("run_at", "timestamp"),
    ("table_name", "string"),
    ("layer", "string"),
    ("row_count", "bigint"),
    ("active_rows", "bigint"),
    ("error", "string"),
]
QUARANTINE_COLUMNS = [
    ("topic", "string"),
    ("partition", "int"),
    ("offset", "bigint"),
    ("timestamp", "timestamp"),
    ("source_table", "string"),
    ("value", "string"),
    ("processed_at", "timestamp"),
]


GATE_AUDIT_COLUMNS = [
    ("run_at", "timestamp"),
    ("table_name", "string"),
    ("stream", "string"),
    ("batch", "bigint"),
    ("passed", "boolean"),
    ("error", "string"),
]


PROFILE_AUDIT_COLUMNS = [("run_at", "timestamp"), ("table_name", "string"), ("passed", "boolean"), *PROFILE_COLUMNS]


def gold_schema(name: str) -> StructType:
    return schema_of(GOLD_COLUMNS[name])


class Lake:
    """The tables of one lakehouse as Parquet below a shared root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def on(self, session: SparkSession) -> Lake:
        """The same tables, read and written by another session."""
        return Lake(session, self.root)

    def bronze(self, spec: TableSpec):
        return self.history(f"bronze_{spec.name}", spec.bronze_schema(), DAY)

    def silver(self, spec: TableSpec):
        return ParquetState(self.spark, f"{self.root}/silver_{spec.name}", spec.silver_schema(), buckets=True)

    def gold(self, name: str):
        return ParquetState(self.spark, f"{self.root}/gold_{name}", gold_schema(name))

    def quarantine(self):
        """Messages that no table could take, as they came."""
        return self.history("quarantine", schema_of(QUARANTINE_COLUMNS))

    def run_audit(self):
        return self.history("run_audit", schema_of(RUN_AUDIT_COLUMNS))

    def gate_audit(self):
        """Up to which batch of which stream each table was checked, and how."""
        return self.history("gate_audit", schema_of(GATE_AUDIT_COLUMNS))

    def profiles(self):
        """Profiles of the columns that the gate looks at, by run."""
        return self.history("profiles", schema_of(PROFILE_AUDIT_COLUMNS))

    def history(self, name: str, schema: StructType, partition_by: str | None = None):
        """A table of any name that batches of streams are added to."""
        return ParquetHistory(self.spark, f"{self.root}/{name}", schema, partition_by)

    def silver_if_present(self, spec: TableSpec) -> DataFrame | None:
        """The current silver rows, or None before the first commit."""
        table = self.silver(spec)
        return table.read() if table.exists() else None

    def register_views(self, specs: Iterable[TableSpec] = tuple(SPECS.values())) -> list[str]:
        """Make the current rows of every table visible to ``spark.sql``."""
        tables = {}
        for spec in specs:
            tables[f"bronze_{spec.name}"] = self.bronze(spec)
            tables[f"silver_{spec.name}"] = self.silver(spec)
        for name in GOLD_COLUMNS:
            tables[f"gold_{name}"] = self.gold(name)
        tables["run_audit"] = self.run_audit()
        tables["quarantine"] = self.quarantine()
        present = {name: table for name, table in tables.items() if table.exists()}
        for name, table in present.items():
            table.read().createOrReplaceTempView(name)
        return list(present)


class CatalogLake(Lake):
    """The same tables in a database of a V2 catalog, ``catalog.database``."""

    def __init__(self, spark: SparkSession, database: str, provider: str = "iceberg"):
        super().__init__(spark, database)
        self.provider = provider

    def on(self, session: SparkSession) -> CatalogLake:
        return CatalogLake(session, self.root, self.provider)

    def _table(self, name: str, ddl: str) -> CatalogTable:
        return CatalogTable(self.spark, f"{self.root}.{name}", self.provider, ddl)

    def bronze(self, spec: TableSpec):
        return self._table(f"bronze_{spec.name}", create_layer_sql(spec, "bronze", self.root, self.provider))

    def silver(self, spec: TableSpec):
        return self._table(f"silver_{spec.name}", create_layer_sql(spec, "silver", self.root, self.provider))

    def gold(self, name: str):
        return self._table(f"gold_{name}", create_gold_sql(name, GOLD_COLUMNS[name], self.root, self.provider))

    def history(self, name: str, schema: StructType, partition_by: str | None = None):
        kinds = [(field.name, field.dataType.simpleString()) for field in schema.fields]
        columns = [*kinds, (STREAM, "string"), (BATCH, "bigint")]
        return self._table(name, create_table_sql(f"{self.root}.{name}", columns, self.provider))
