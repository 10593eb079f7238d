"""Table specifications: everything the operators need to know about a table.

One generic operator per task is driven by a ``TableSpec``; adding a source
table means adding a specification, not code.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from siltlake.functions import classes, values

TYPES: dict[str, DataType] = {
    "bigint": LongType(),
    "int": IntegerType(),
    "double": DoubleType(),
    "string": StringType(),
    "boolean": BooleanType(),
    "timestamp": TimestampType(),
    "binary": BinaryType(),
    "array<string>": ArrayType(StringType()),
    "map<string,string>": MapType(StringType(), StringType()),
}

# Columns every change carries besides the business columns.
CHANGE_COLUMNS = [("created_at", "bigint"), ("updated_at", "bigint"), ("op", "string"), ("ts_ms", "bigint")]
ARRIVAL = "processed_at"
POSITION = "_position"
CORRUPT = "_corrupt_record"
AUDIT = "_audit_updated_at"
DAY = "processed_day"
BUCKET = "key_bucket"
# Columns that a change record left out, undeclared fields, and which change set each column.
UNSENT = "_unsent"
REST = "_rest"
CELLS = "_cells"
# Whether a row was taken out (-1) or put in (1).
SIGN = "_sign"
# The batch of a stream that brought a bronze row; folders in the Parquet store.
STREAM = "_stream"
BATCH = "_batch"


@dataclass(frozen=True)
class Derived:
    """A silver column computed from the change row."""

    name: str
    type_name: str
    build: Callable[[], Column]


@dataclass(frozen=True)
class TableSpec:
    name: str
    fields: tuple[tuple[str, str], ...]
    derived: tuple[Derived, ...] = ()
    key: str = "id"
    # Parts of silver by hash of the key, so that keys of any kind spread evenly.
    # Fixed once the table exists; about 1 GB of rows per bucket is a good size.
    buckets: int = 16
    # Where a flat record's ``__source`` has the position in the source's log.
    position_path: str = "$.lsn"
    epoch_unit: str = "ms"
    foreign_keys: dict[str, str] = field(default_factory=dict)
    # What the source sends in the place of a value that it leaves out.
    placeholder: str | None = None
    # Whether the intake keeps undeclared fields, and those that became columns.
    capture: bool = False
    promoted: tuple[tuple[str, str], ...] = ()

    @property
    def business(self) -> list[str]:
        return [name for name, _ in (*self.fields, *self.promoted)]

    @property
    def cell_columns(self) -> list[str]:
        """Columns that partial images set one by one."""
        return [*[name for name in self.business if name != self.key], "created_at", "updated_at"]

    @property
    def landing_columns(self) -> list[tuple[str, str]]:
        return [*self.fields, *CHANGE_COLUMNS]

    @property
    def bronze_columns(self) -> list[tuple[str, str]]:
        more = [(UNSENT, "array<string>")] * (self.placeholder is not None) + [(REST, "map<string,string>")] * self.capture
        return [*self.landing_columns, (ARRIVAL, "timestamp"), (POSITION, "bigint"), (CORRUPT, "string"), *more]

    @property
    def silver_columns(self) -> list[tuple[str, str]]:
        return [
            *self.fields,
            *self.promoted,
            ("created_at", "bigint"),
            ("updated_at", "bigint"),
            *[(d.name, d.type_name) for d in self.derived],
            ("is_active", "boolean"),
            ("op", "string"),
            ("ts_ms", "bigint"),
            (ARRIVAL, "timestamp"),
            (POSITION, "bigint"),
            (AUDIT, "timestamp"),
            *([(CELLS, self._cells_type())] if self.placeholder is not None else []),
        ]

    def _cells_type(self) -> DataType:
        order = schema_of([("ts_ms", "bigint"), (POSITION, "bigint"), ("deletes", "boolean")])
        return StructType([StructField(name, order, True) for name in self.cell_columns])

    def bronze_schema(self) -> StructType:
        return schema_of([*self.bronze_columns, (DAY, "string")])

    def silver_schema(self) -> StructType:
        return schema_of([*self.silver_columns, (BUCKET, "int")])

    @property
    def order_columns(self) -> list[str]:
        """Values that order changes of one time, position and kind."""
        return [*[name for name in self.business if name != self.key], "created_at", "updated_at", "op"]

    def bucket(self, key: Column | None = None) -> Column:
        """Silver bucket of a key."""
        key = F.col(self.key) if key is None else key
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def with_options(self, **changes) -> TableSpec:
        return replace(self, **changes)


def schema_of(columns: list[tuple[str, str | DataType]]) -> StructType:
    return StructType([StructField(name, TYPES.get(kind, kind) if isinstance(kind, str) else kind, True) for name, kind in columns])


def _email_domain() -> Column:
    return values.email_domain(F.col("email"))


def _price_tier() -> Column:
    return classes.price_tier(F.col("price"))


def _order_value_tier() -> Column:
    return classes.order_value_tier(F.col("total_amount"))


USERS = TableSpec(
    name="users",
    fields=(("id", "bigint"), ("name", "string"), ("email", "string")),
    derived=(Derived("email_domain", "string", _email_domain),),
)
PRODUCTS = TableSpec(
    name="products",
    fields=(("id", "bigint"), ("name", "string"), ("price", "double"), ("category", "string")),
    derived=(Derived("price_category", "string", _price_tier),),
)
ORDERS = TableSpec(
    name="orders",
    fields=(
        ("id", "bigint"),
        ("user_id", "bigint"),
        ("product_id", "bigint"),
        ("quantity", "int"),
        ("total_amount", "double"),
        ("status", "string"),
    ),
    derived=(Derived("order_value_category", "string", _order_value_tier),),
    foreign_keys={"users": "user_id", "products": "product_id"},
)
SPECS = {spec.name: spec for spec in (USERS, PRODUCTS, ORDERS)}
