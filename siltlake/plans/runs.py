"""Whole runs that a scheduler can call."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from siltlake.operators.profile import PROFILE_COLUMNS, ShapeLimits, check_shape, distance, profile
from siltlake.operators.quality import GateLimits, QualityGateError, check_gate, gate_metrics
from siltlake.plans import gold
from siltlake.plans.lake import GATE_AUDIT_COLUMNS, PROFILE_AUDIT_COLUMNS, RUN_AUDIT_COLUMNS, Lake
from siltlake.plans.layers import merge_new_bronze
from siltlake.session import scratch_path, sized_session
from siltlake.spec import DAY, SPECS, TableSpec, schema_of
from siltlake.streaming.jobs import MAX_FILES, ingest_files, ingest_messages
from siltlake.tables.files import Files


# The name under which the gate keeps what it has seen of the quarantine.
QUARANTINE = "quarantine"


class RunFailedError(RuntimeError):
    """At least one table of a run failed; the others were still processed."""


def run_instant() -> tuple[dt.datetime, Column]:
    """One instant for a whole run, as a value and as a literal column."""
    now = dt.datetime.now(dt.timezone.utc)
    return now, F.timestamp_micros(F.lit(int(now.timestamp() * 1_000_000)))


def run_cdc(
    lake: Lake,
    raw_root: str,
    checkpoint_root: str,
    specs: Iterable[TableSpec] = tuple(SPECS.values()),
    late_delete: str = "win",
    max_files_per_trigger: int | None = MAX_FILES,
    archive_root: str | None = None,
    dedup_delay: str | None = None,
    dedup_any_age: bool = False,
) -> dict[str, str | None]:
    """Take all new change files of each table into bronze and silver.

    The tables run side by side. A table without a raw folder has no new data.
    Each outcome goes to the run audit; when a table failed, the run raises
    after the others are done.
    """
    specs = list(specs)
    files = Files(lake.spark)
    errors: dict[str, str | None] = {spec.name: None for spec in specs}
    queries = {}
    for spec in specs:
        try:
            if files.exists(f"{raw_root}/{spec.name}"):
                queries[spec.name] = ingest_files(
                    lake,
                    spec,
                    f"{raw_root}/{spec.name}",
                    f"{checkpoint_root}/{spec.name}",
                    late_delete=late_delete,
                    max_files_per_trigger=max_files_per_trigger,
                    archive=f"{archive_root}/{spec.name}" if archive_root else None,
                    dedup_delay=dedup_delay,
                    dedup_any_age=dedup_any_age,
                )
        except Exception as error:
            errors[spec.name] = str(error)
    for name, query in queries.items():
        errors[name] = _outcome(query.awaitTermination)
    return _finish(lake, specs, errors)


def low_watermark(
    lake: Lake, specs: Iterable[TableSpec] = tuple(SPECS.values()), heartbeats: Mapping[str, int] | None = None
) -> int | None:
    """The position below which every table has all its changes; None while a
    table has no position.

    Tables of one source share its log, and each intake follows it in order. A
    table is complete below the highest position it has seen; at that position
    itself more rows of the same transaction may come. ``heartbeats`` has, for
    tables that are idle, positions up to which the source says that nothing is
    missing.
    """
    bounds = []
    for spec in specs:
        bronze = lake.bronze(spec)
        seen = bronze.position() if bronze.exists() else None
        known = [seen] if seen is not None else []
        if spec.name in (heartbeats or {}):
            known.append(heartbeats[spec.name] + 1)
        bounds.append(max(known, default=None))
    return min(bounds) if bounds and None not in bounds else None


def run_silver_to_cut(
    lake: Lake,
    specs: Iterable[TableSpec] = tuple(SPECS.values()),
    late_delete: str = "win",
    heartbeats: Mapping[str, int] | None = None,
) -> int | None:
    """Merge into all tables what lies below their common watermark, which is
    returned, and hold the rest back: marts of several tables then see one state of
    the source. Positions have to be those of commits, so that all changes of a
    transaction have one. Without a watermark nothing is merged."""
    specs = list(specs)
    cut = low_watermark(lake, specs, heartbeats)
    if cut is not None:
        run_silver(lake, specs, late_delete, cut)
    return cut


def run_silver(
    lake: Lake, specs: Iterable[TableSpec] = tuple(SPECS.values()), late_delete: str = "win", cut: int | None = None
) -> dict[str, str | None]:
    """Merge the bronze rows that arrived since the last time, for intakes that
    write bronze only, up to a position if ``cut`` names one; tables and errors are
    treated as in ``run_cdc``."""
    specs = list(specs)
    _, run_ts = run_instant()

    def merge(spec: TableSpec) -> str | None:
        bronze, silver = lake.bronze(spec), lake.silver(spec)
        return _outcome(lambda: merge_new_bronze(bronze, silver, spec, run_ts, late_delete=late_delete, cut=cut))

    inherit = inheritable_thread_target(lake.spark)
    with ThreadPoolExecutor(max(len(specs), 1)) as pool:
        errors = dict(zip([spec.name for spec in specs], pool.map(inherit(merge), specs)))
    return _finish(lake, specs, errors)


def _outcome(work: Callable[[], object]) -> str | None:
    try:
        work()
        return None
    except Exception as error:
        return str(error)


def _finish(lake: Lake, specs: list[TableSpec], errors: dict[str, str | None]) -> dict[str, str | None]:
    record_run(lake, specs, errors)
    failed = {name: error for name, error in errors.items() if error}
    if failed:
        raise RunFailedError("; ".join(f"{name}: {error}" for name, error in failed.items()))
    return errors


def record_run(lake: Lake, specs: list[TableSpec], errors: dict[str, str | None]) -> DataFrame:
    """Append the row counts and errors of this run to the run audit. The counts
    were observed when the rows were written; no layer is read."""
    now, _ = run_instant()
    rows = []
    for spec in specs:
        for layer, table in (("bronze", lake.bronze(spec)), ("silver", lake.silver(spec))):
            count, active = table.counts() if table.exists() else (0, 0 if layer == "silver" else None)
            rows.append((now, spec.name, layer, count, active, errors.get(spec.name)))
    audit = lake.run_audit()
    audit.append(lake.spark.createDataFrame(rows, schema_of(RUN_AUDIT_COLUMNS)).coalesce(1))
    return audit.read()


def check_quality(
    lake: Lake,
    limits: GateLimits = GateLimits(),
    specs: Iterable[TableSpec] = tuple(SPECS.values()),
    shapes: Mapping[str, Sequence[str]] | None = None,
    shape_limits: ShapeLimits = ShapeLimits(),
) -> dict[str, dict]:
    """Gate metrics of the bronze batches, and quarantined messages, that no gate
    has passed yet; raises when a table is over its limits.

    ``shapes`` names, by table, columns whose distribution is compared with that of
    the last batches which passed; their profiles go to the table of profiles.

    What is checked, and how it ended, goes to the gate audit. A batch that did
    not pass is checked again, with those that came after it, however late.
    """
    passed = gated_marks(lake)
    now, _ = run_instant()
    found, tables = {}, {spec.name: lake.bronze(spec) for spec in specs}
    marks = {name: table.marks() for name, table in tables.items()}
    for spec in specs:
        rows = tables[spec.name].read_since(passed.get(spec.name, {}), marks[spec.name])
        found[spec.name] = gate_metrics(rows, spec.key).first().asDict()
    quarantine = lake.quarantine()
    if quarantine.exists():
        marks[QUARANTINE] = quarantine.marks()
        left = quarantine.read_since(passed.get(QUARANTINE, {}), marks[QUARANTINE]).count()
        rows = sum(metrics["rows"] for metrics in found.values())
        nothing = dict.fromkeys(["corrupt_rows", "null_keys", "unknown_ops"], 0)
        found[QUARANTINE] = {"rows": rows, **nothing, "max_lag_ms": None, "quarantined_rows": left}
    errors = {}
    for name, metrics in found.items():
        try:
            check_gate(metrics, limits)
        except QualityGateError as error:
            errors[name] = f"{name}: {error}"
    shaped = {}
    for spec in specs:
        if (shapes or {}).get(spec.name) and found[spec.name]["rows"]:
            rows = tables[spec.name].read_since(passed.get(spec.name, {}), marks[spec.name])
            new = profile(rows, shapes[spec.name])
            # A row for each column: written once, it is not computed again.
            shaped[spec.name] = lake.spark.createDataFrame(new.collect(), schema_of(PROFILE_COLUMNS))
            try:
                check_shape(distance(shaped[spec.name], last_profile(lake, spec.name)), shape_limits)
            except QualityGateError as error:
                errors[spec.name] = f"{errors.get(spec.name, spec.name + ':')} {error}"
    for name, new in shaped.items():
        kept = new.select(F.lit(now).alias("run_at"), F.lit(name).alias("table_name"), F.lit(not errors).alias("passed"), "*")
        lake.profiles().append(kept.coalesce(1))
    # Marts use all tables, so a batch has passed when all tables did.
    seen = [
        (now, name, stream, batch, not errors, errors.get(name))
        for name, streams in marks.items()
        for stream, batch in streams.items()
    ]
    if seen:
        lake.gate_audit().append(lake.spark.createDataFrame(seen, schema_of(GATE_AUDIT_COLUMNS)).coalesce(1))
    if errors:
        raise QualityGateError("; ".join(errors.values()))
    return found


def last_profile(lake: Lake, table: str) -> DataFrame:
    """The profiles of a table's columns that passed last."""
    names = [name for name, _ in PROFILE_COLUMNS]
    profiles = lake.profiles()
    if not profiles.exists():
        return lake.spark.createDataFrame([], schema_of(PROFILE_AUDIT_COLUMNS)).select(*names)
    rows = profiles.read().filter(F.col("passed") & (F.col("table_name") == table))
    return rows.groupBy("column").agg(F.max_by(F.struct(*names), "run_at").alias("p")).select("p.*")


def gated_marks(lake: Lake) -> dict[str, dict[str, int]]:
    """The last batch of each stream of each table that passed a gate."""
    audit = lake.gate_audit()
    if not audit.exists():
        return {}
    marks: dict[str, dict[str, int]] = {}
    last = audit.read().filter("passed").groupBy("table_name", "stream").agg(F.max("batch"))
    for table, stream, batch in last.collect():
        marks.setdefault(table, {})[stream] = batch
    return marks


def bronze_day(lake: Lake, spec: TableSpec, day: str) -> DataFrame:
    """The changes that arrived on one day; other folders are not read."""
    return lake.bronze(spec).read().filter(F.col(DAY) == day).drop(DAY)


def run_gold(lake: Lake, specs: Mapping[str, TableSpec] = SPECS) -> dict[str, int]:
    """Refresh every mart whose silver tables exist; returns the rows written."""
    _, run_ts = run_instant()
    lake = lake.on(sized_session(lake.spark, sum(lake.silver(spec).stored_bytes() for spec in specs.values())))
    users, products, orders = (lake.silver_if_present(specs[name]) for name in ("users", "products", "orders"))
    marts: dict[str, DataFrame] = {}
    totals_at = scratch_path(lake.spark, "user-totals")
    try:
        if orders is not None:
            marts["sales_summary"] = gold.sales_summary(orders, run_ts, specs["orders"].epoch_unit)
            if users is not None:
                # Both marts of users need the orders by user; they are read once.
                by_user = gold.user_totals(orders)
                by_user.write.parquet(totals_at)
                totals = lake.spark.read.schema(by_user.schema).parquet(totals_at)
                unit = specs["users"].epoch_unit
                marts["user_analytics"] = gold.user_analytics_from(users, totals, run_ts, unit=unit)
                marts["user_stats"] = gold.user_stats_from(users, totals)
            if products is not None:
                marts["product_analytics"] = gold.product_analytics(products, orders, run_ts)
        # The marts do not depend on each other; the tail of one job leaves room
        # for the next.
        inherit = inheritable_thread_target(lake.spark)
        with ThreadPoolExecutor(max(len(marts), 1)) as pool:
            written = {n: pool.submit(inherit(lake.gold(n).replace), frame) for n, frame in marts.items()}
        return {name: future.result() for name, future in written.items()}
    finally:
        Files(lake.spark).delete(totals_at)


def run_pipeline(
    lake: Lake,
    raw_root: str,
    checkpoint_root: str,
    limits: GateLimits = GateLimits(),
    specs: Mapping[str, TableSpec] = SPECS,
    **options,
) -> dict[str, int]:
    """Change files, quality gate, marts. A failing step stops the later ones.
    ``options`` go to ``run_cdc``."""
    run_cdc(lake, raw_root, checkpoint_root, list(specs.values()), **options)
    return _gate_and_marts(lake, limits, specs)


def run_message_pipeline(
    lake: Lake,
    messages: DataFrame,
    checkpoint: str,
    limits: GateLimits = GateLimits(),
    specs: Mapping[str, TableSpec] = SPECS,
    **options,
) -> dict[str, int]:
    """A stream of messages, quality gate, marts; ``options`` go to
    ``ingest_messages``. Silver is merged once for all batches of the run."""
    tables = list(specs.values())
    late_delete = options.pop("late_delete", "win")
    query: StreamingQuery = ingest_messages(lake, messages, checkpoint, tables, merge_each_batch=False, **options)
    query.awaitTermination()
    run_silver(lake, tables, late_delete)
    return _gate_and_marts(lake, limits, specs)


def _gate_and_marts(lake: Lake, limits: GateLimits, specs: Mapping[str, TableSpec]) -> dict[str, int]:
    check_quality(lake, limits, list(specs.values()))
    return run_gold(lake, specs)
