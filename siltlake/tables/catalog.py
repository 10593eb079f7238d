"""Layer tables in a catalog: DDL for any provider, and a thin adapter for V2.

The DDL runs on stock Spark with ``parquet``. The adapter needs a catalog whose
tables take row-level changes (an Iceberg catalog, for one); it only hands the
same frames and rules to that catalog's own operations.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from siltlake.operators.merge import LATE_WINS, SOFT, newer_sql
from siltlake.spec import ARRIVAL, AUDIT, BATCH, BUCKET, DAY, STREAM, TableSpec

V2_PROVIDERS = ("iceberg",)
TARGET_FILE_BYTES = 134_217_728
LAYER_PROPERTIES = {"format-version": "2", "write.target-file-size-bytes": str(TARGET_FILE_BYTES)}
GOLD_PROPERTIES = {"format-version": "2"}


def create_database_sql(database: str) -> str:
    return f"CREATE DATABASE IF NOT EXISTS {database}"


def create_layer_sql(
    spec: TableSpec, layer: str, database: str, provider: str = "parquet", location: str | None = None
) -> str:
    """DDL of ``bronze_<table>`` or ``silver_<table>``.

    A V2 provider partitions by ``days(processed_at)``; Parquet tables cannot,
    so they carry the day (bronze) or the bucket (silver) as a column.
    Bronze of a V2 provider also has the stream and batch of each row.
    """
    columns = spec.bronze_columns if layer == "bronze" else spec.silver_columns
    name = f"{database}.{layer}_{spec.name}"
    if provider in V2_PROVIDERS:
        if layer == "bronze":
            columns = [*columns, (STREAM, "string"), (BATCH, "bigint")]
        return create_table_sql(name, columns, provider, f"days({ARRIVAL})", location, LAYER_PROPERTIES)
    extra = (DAY, "string") if layer == "bronze" else (BUCKET, "int")
    return create_table_sql(name, [*columns, extra], provider, extra[0], location)


def create_gold_sql(
    name: str, columns: list[tuple[str, str]], database: str, provider: str = "parquet", location: str | None = None
) -> str:
    properties = GOLD_PROPERTIES if provider in V2_PROVIDERS else None
    return create_table_sql(f"{database}.gold_{name}", columns, provider, None, location, properties)


def create_table_sql(
    name: str,
    columns: list[tuple[str, str]],
    provider: str,
    partition: str | None = None,
    location: str | None = None,
    properties: dict[str, str] | None = None,
) -> str:
    body = ", ".join(f"`{column}` {kind.upper()}" for column, kind in columns)
    parts = [f"CREATE TABLE IF NOT EXISTS {name} ({body}) USING {provider}"]
    if partition:
        parts.append(f"PARTITIONED BY ({partition})")
    if location:
        parts.append(f"LOCATION '{location}'")
    if properties:
        parts.append("TBLPROPERTIES (" + ", ".join(f"'{k}'='{v}'" for k, v in properties.items()) + ")")
    return " ".join(parts)


def merge_sql(
    target: str, source: str, spec: TableSpec, delete_mode: str = "soft", late_delete: str = "win"
) -> str:
    """The keyed merge as one statement, for catalogs that take ``MERGE INTO``.

    ``source`` holds prepared changes, one per key.
    """
    columns = [name for name, _ in spec.silver_columns]
    every = ", ".join(f"t.`{c}` = s.`{c}`" for c in columns)
    insert = f"INSERT ({', '.join(f'`{c}`' for c in columns)}) VALUES ({', '.join(f's.`{c}`' for c in columns)})"
    head = f"MERGE INTO {target} AS t USING {source} AS s ON t.`{spec.key}` = s.`{spec.key}`"
    if delete_mode == "hard":
        return (
            f"{head} WHEN MATCHED AND s.op = 'd' THEN DELETE "
            f"WHEN MATCHED AND s.op <> 'd' THEN UPDATE SET {every} "
            f"WHEN NOT MATCHED AND NOT (s.op <=> 'd') THEN {insert}"
        )
    replace = f"WHEN MATCHED AND {newer_sql(spec, late_delete)} THEN UPDATE SET {every}"
    if late_delete != LATE_WINS:
        return f"{head} {replace} WHEN NOT MATCHED THEN {insert}"
    mark = f"t.is_active = false, t.op = 'd', t.`{AUDIT}` = s.`{AUDIT}`"
    return f"{head} {replace} WHEN MATCHED AND s.op = 'd' THEN UPDATE SET {mark} WHEN NOT MATCHED THEN {insert}"


class CatalogTable:
    """A table of a V2 catalog, as a history or as a state.

    Statements are the catalog's own; nothing is kept next to them. A batch of a
    history replaces the rows of an earlier try, by its stream and number. A
    merge that is run again changes nothing, so a state has no marks of intakes;
    what ``run_silver`` has merged is a property of the table.
    """

    MARKS = "siltlake.merged"

    def __init__(self, spark: SparkSession, name: str, provider: str = "iceberg", ddl: str | None = None):
        self.spark = spark
        self.name = name
        self.provider = provider
        self.ddl = ddl

    def on(self, session: SparkSession) -> CatalogTable:
        return CatalogTable(session, self.name, self.provider, self.ddl)

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def read(self) -> DataFrame:
        rows = self.spark.read.table(self.name)
        return rows.drop(STREAM, BATCH)

    def counts(self) -> tuple[int, int | None]:
        rows = self.spark.read.table(self.name)
        active = F.count_if("is_active") if "is_active" in rows.columns else F.lit(None).cast("bigint")
        found = rows.agg(F.count(F.lit(1)), active).first()
        return found[0], found[1]

    def stored_bytes(self) -> int:
        """Unknown here; adaptive execution sizes what reads the table."""
        return 0

    # -- history ------------------------------------------------------------

    def append(self, df: DataFrame, stream: str | None = None, batch: int | None = None) -> int:
        self._create()
        seen = Observation()
        rows = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        if stream is None:
            stream, batch = f"by-hand-{uuid.uuid4().hex}", 0
        tagged = rows.withColumns({STREAM: F.lit(stream), BATCH: F.lit(batch).cast("bigint")})
        tagged.writeTo(self.name).option("mergeSchema", "true").overwrite(self._batch(stream, batch))
        return seen.get["rows"]

    def _batch(self, stream: str, batch: int) -> Column:
        return (F.col(STREAM) == stream) & (F.col(BATCH) == batch)

    def has_applied(self, stream: str, batch: int) -> bool:
        if not self.exists():
            return False
        rows = self.spark.read.table(self.name)
        return STREAM in rows.columns and not rows.filter(self._batch(stream, batch)).isEmpty()

    def read_batch(self, stream: str, batch: int) -> DataFrame:
        return self.spark.read.table(self.name).filter(self._batch(stream, batch)).drop(STREAM, BATCH)

    def read_since(self, marks: Mapping[str, int], upto: Mapping[str, int] | None = None) -> DataFrame:
        rows = self.spark.read.table(self.name)
        for bound, keep in ((marks, lambda m: F.col(BATCH) > m), (upto or {}, lambda m: F.col(BATCH) <= m)):
            for stream, last in bound.items():
                rows = rows.filter((F.col(STREAM) != stream) | keep(last))
        return rows.drop(STREAM, BATCH)

    # -- state --------------------------------------------------------------

    def held(self) -> dict:
        return {}

    def marks(self) -> dict[str, int]:
        """Of a history the last batch of each stream; of a state what was merged."""
        if not self.exists():
            return {}
        rows = self.spark.read.table(self.name)
        if STREAM in rows.columns:
            return dict(tuple(r) for r in rows.groupBy(STREAM).agg(F.max(BATCH)).collect())
        properties = {r[0]: r[1] for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.name}").collect()}
        return json.loads(properties.get(self.MARKS, "{}"))

    def replace(self, df: DataFrame) -> int:
        seen = Observation()
        rows = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        rows.writeTo(self.name).using(self.provider).createOrReplace()
        return seen.get["rows"]

    def merge(
        self,
        latest: DataFrame,
        spec: TableSpec,
        delete_mode: str = SOFT,
        late_delete: str = LATE_WINS,
        marks: Mapping[str, int] | None = None,
        held: dict | None = None,
    ) -> int:
        if held is not None:
            raise ValueError("changes are not held back from tables of a catalog")
        if spec.placeholder is not None:
            raise ValueError(f"{spec.name} has partial images: derived columns are not computed in the catalog's MERGE")
        self._create()
        view = f"changes_{spec.name}_{uuid.uuid4().hex}"
        latest.drop(BUCKET).createOrReplaceTempView(view)
        try:
            latest.sparkSession.sql(merge_sql(self.name, view, spec, delete_mode, late_delete))
        finally:
            latest.sparkSession.catalog.dropTempView(view)
        if marks:
            text = json.dumps({**self.marks(), **marks}).replace("'", "\\'")
            self.spark.sql(f"ALTER TABLE {self.name} SET TBLPROPERTIES ('{self.MARKS}' = '{text}')")
        return 0

    def _create(self) -> None:
        if self.ddl and not self.exists():
            self.spark.sql(self.ddl)
