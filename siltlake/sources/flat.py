"""Flat change records: one JSON object per change, ``__op`` and ``__ts_ms`` added.

The landing schema is all strings. With inferred or typed schemas one quoted
number would turn a whole column, or a whole row, unreadable; here it is cast
leniently afterwards and only the bad value becomes NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from siltlake.functions.values import typed
from siltlake.sources.drift import undeclared
from siltlake.spec import ARRIVAL, CORRUPT, POSITION, REST, UNSENT, TableSpec
from siltlake.tables.files import Files

WIRE_NAMES = {"op": "__op", "ts_ms": "__ts_ms"}
# Where a change came from in the source, as JSON.
SOURCE = "__source"


def landing_schema(spec: TableSpec) -> StructType:
    return StructType([StructField(name, StringType(), True) for name in [*_wire_names(spec), SOURCE, CORRUPT]])


def _wire_names(spec: TableSpec) -> list[str]:
    return [WIRE_NAMES.get(name, name) for name, _ in spec.landing_columns]


def read_changes(spark: SparkSession, path: str, spec: TableSpec, processed_at: Column) -> DataFrame:
    """All change files below ``path``; no rows when there is no such folder."""
    if not Files(spark).exists(path):
        return normalise(spark.createDataFrame([], landing_schema(spec)), spec, processed_at)
    return normalise(_load(spark.read, path, spec), spec, processed_at)


def stream_changes(
    spark: SparkSession,
    path: str,
    spec: TableSpec,
    max_files_per_trigger: int | None = None,
    archive: str | None = None,
) -> DataFrame:
    """New change files below ``path`` as raw rows; the checkpoint of the
    query that reads them remembers which files were taken.

    With ``archive`` taken files move there, so that the folder, which every
    batch lists, stays short.
    """
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return _load(reader, path, spec)


def _load(reader, path: str, spec: TableSpec) -> DataFrame:
    if spec.capture:
        return parse_lines(reader.text(path), spec)
    return (
        reader.schema(landing_schema(spec))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def parse_lines(lines: DataFrame, spec: TableSpec) -> DataFrame:
    """Lines of JSON (column value) as raw landing rows that keep, in ``_rest``,
    the fields that the specification does not declare. Empty lines are no rows."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    row = F.from_json("value", landing_schema(spec), options)
    rest = undeclared(F.col("value"), [*_wire_names(spec), SOURCE, CORRUPT])
    parsed = lines.filter(F.trim("value") != "").select(F.explode(F.array(F.struct(row.alias("row"), rest.alias(REST)))).alias("_line"))
    return parsed.select("_line.row.*", f"_line.{REST}")


def rename_wire_columns(raw: DataFrame) -> DataFrame:
    return raw.withColumnsRenamed({wire: name for name, wire in WIRE_NAMES.items()})


def normalise(raw: DataFrame, spec: TableSpec, processed_at: Column) -> DataFrame:
    """Raw landing rows to bronze rows: wire names, types, arrival time.

    The position is the one in the source's log, so that changes of one instant
    keep the order they were made in."""
    renamed = rename_wire_columns(raw)
    position = F.lit(None)
    if POSITION in renamed.columns:
        position = typed(F.col(POSITION).cast("string"), "bigint")
    elif SOURCE in renamed.columns:
        position = typed(F.get_json_object(F.col(SOURCE).cast("string"), spec.position_path), "bigint")
    corrupt = F.col(CORRUPT) if CORRUPT in renamed.columns else F.lit(None)
    return renamed.select(
        *[_cast(renamed, name, kind, spec.placeholder) for name, kind in spec.landing_columns],
        processed_at.cast("timestamp").alias(ARRIVAL),
        position.cast("bigint").alias(POSITION),
        corrupt.cast("string").alias(CORRUPT),
        *kept_aside(spec, {name: F.col(name) for name in renamed.columns}, F.col(REST) if REST in renamed.columns else None),
    )


def kept_aside(spec: TableSpec, raw: dict[str, Column], rest: Column | None) -> list[Column]:
    """What a specification keeps of a record besides its values: the columns for
    which the placeholder came, NULL for none, and undeclared fields."""
    found = []
    if spec.placeholder is not None:
        names = [F.when(raw[name].cast("string") == spec.placeholder, F.lit(name)) for name in spec.cell_columns if name in raw]
        unsent = F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")
        found.append(F.when(F.size(unsent) > 0, unsent).alias(UNSENT))
    if spec.capture:
        found.append((F.lit(None) if rest is None else rest).cast("map<string,string>").alias(REST))
    return found


def _cast(frame: DataFrame, name: str, kind: str, placeholder: str | None = None) -> Column:
    """A missing column reads as NULL, so older files keep loading; so does a
    value that was left out."""
    if name not in frame.columns:
        return F.lit(None).cast(kind).alias(name)
    text = F.col(name).cast("string")
    if placeholder is not None:
        text = F.nullif(text, F.lit(placeholder))
    return (text if kind == "string" else typed(text, kind)).alias(name)


def archive_raw(records: DataFrame, event_time: Column, path: str) -> None:
    """Keep raw records as JSON, partitioned by year, month and day, each day in
    files of a usual size however many tasks there are."""
    (
        records.withColumns(
            {
                "year": F.date_format(event_time, "yyyy"),
                "month": F.date_format(event_time, "MM"),
                "day": F.date_format(event_time, "dd"),
            }
        )
        .hint("rebalance", "year", "month", "day")
        .write.mode("append")
        .partitionBy("year", "month", "day")
        .json(path)
    )
