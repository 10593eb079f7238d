"""Layer tables as Parquet folders, for a shared file system without a catalog.

A history is a folder for each batch of each stream, written with Spark's
overwrite: a batch that is delivered again replaces itself, so nothing has to
remember what was taken. A state is a folder for each commit, and one small
pointer to the folders that count; readers see a commit whole or not at all.

Neither is a table format: a table has one writer at a time, and older versions
are not kept. Where tables need more, use a catalog (``tables/catalog.py``).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from siltlake.operators.feed import fed, feed_bucket
from siltlake.operators.merge import LATE_WINS, SOFT, merge_latest
from siltlake.session import fork_session, scratch_path, sized_session
from siltlake.spec import BATCH, BUCKET, POSITION, SIGN, STREAM, TableSpec
from siltlake.tables.files import Files

# The stream of rows that are appended by hand, one batch after the other.
BY_HAND = "by-hand"
# Fixed value: the folder of rows without a partition value.
HIVE_NULL = "__HIVE_DEFAULT_PARTITION__"
# Files that a task of a commit may write side by side.
OPEN_FILES = 32


class ConcurrentCommitError(RuntimeError):
    """Another writer committed first; run the step again."""


class ParquetHistory:
    """Rows that are only ever added."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, partition_by: str | None = None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.declared_schema = schema
        self.partition_by = partition_by
        self._files = Files(spark)

    @property
    def name(self) -> str:
        return self.path.rsplit("/", 1)[1]

    def on(self, session: SparkSession) -> ParquetHistory:
        """The same table, read and written by another session."""
        return ParquetHistory(session, self.path, self.declared_schema, self.partition_by)

    def _folder(self, stream: str, batch: int) -> str:
        return f"{self.path}/{STREAM}={stream}/{BATCH}={batch}"

    def _state(self) -> dict:
        """The schema, and for each stream its last batch, how many rows it and
        those before it have, the highest position, and the bounds of the last
        batch's partitions (``bounds`` has those of all batches before): no work
        grows with the number of batches."""
        found = self._files.read_json(f"{self.path}/_state.json")
        return found or {"schema": self.declared_schema.jsonValue(), "streams": {}}

    def schema(self) -> StructType:
        return StructType.fromJson(self._state()["schema"])

    def exists(self) -> bool:
        return self._files.exists(f"{self.path}/_state.json")

    def marks(self) -> dict[str, int]:
        """The last batch of each stream."""
        return {stream: entry[0] for stream, entry in self._state()["streams"].items()}

    def position(self) -> int | None:
        """The highest position in the source's log that any row has."""
        found = [entry[3] for entry in self._state()["streams"].values() if len(entry) > 3 and entry[3] is not None]
        return max(found, default=None)

    def counts(self) -> tuple[int, int | None]:
        """Rows, as counted when they were written; histories have no active ones."""
        return sum(entry[1] + entry[2] for entry in self._state()["streams"].values()), None

    def append(self, df: DataFrame, stream: str | None = None, batch: int | None = None) -> int:
        """Write a batch of a stream, in the place of an earlier try; returns its
        rows. New columns widen the table; older rows read them as NULL."""
        state = self._state()
        if stream is None:
            stream, batch = BY_HAND, state["streams"].get(BY_HAND, [-1])[0] + 1
        last, last_rows, before, highest, last_bounds = [*state["streams"].get(stream, [-1, 0, 0]), None, {}][:5]
        schema = widen(StructType.fromJson(state["schema"]), df.schema)
        seen = Observation()
        position = F.max(POSITION) if POSITION in df.columns else F.max(F.lit(None).cast("bigint"))
        newest = F.max("ts_ms") if "ts_ms" in df.columns else F.max(F.lit(None).cast("bigint"))
        counted = [F.count(F.lit(1)).alias("rows"), position.alias("position"), newest.alias("newest")]
        writer = df.observe(seen, *counted).write.mode("overwrite")
        if self.partition_by:
            writer = writer.partitionBy(self.partition_by)
        writer.parquet(self._folder(stream, batch))
        rows, position = seen.get["rows"], seen.get["position"]
        if batch > last:
            before += last_rows
            state["bounds"] = _joined(state.get("bounds", {}), last_bounds)
        known = [p for p in (highest, position) if p is not None]
        bounds = self._partition_bounds(self._folder(stream, batch), rows, seen.get["newest"]) if self.partition_by else {}
        state["streams"][stream] = [batch, rows, before, max(known, default=None), bounds]
        state["schema"] = schema.jsonValue()
        self._files.write_json(f"{self.path}/_state.json", state)
        return rows

    def _partition_bounds(self, folder: str, rows: int, newest: int | None) -> dict[str, list]:
        """Rows and latest source time of each partition of a batch. Most batches
        arrive on one day, and were observed; others are counted by two columns."""
        names = [name.split("=", 1)[1] for name in self._files.sizes(folder) if "=" in name]
        if len(names) < 2:
            return {name: [rows, newest] for name in names}
        written = self.spark.read.parquet(folder)
        latest = F.max("ts_ms") if "ts_ms" in written.columns else F.lit(None)
        by = written.groupBy(F.col(self.partition_by).cast("string").alias("p")).agg(F.count(F.lit(1)).alias("n"), latest.alias("newest"))
        return {HIVE_NULL if p is None else p: [n, t] for p, n, t in by.collect()}

    def bounds(self) -> dict[str | None, tuple[int, int | None]]:
        """Rows and latest source time of each partition, None being that of rows
        without a value; as many numbers as there are partitions."""
        state = self._state()
        found = state.get("bounds", {})
        for entry in state["streams"].values():
            found = _joined(found, entry[4] if len(entry) > 4 else {})
        return {None if name == HIVE_NULL else name: tuple(x) for name, x in found.items()}

    def has_applied(self, stream: str, batch: int) -> bool:
        """Whether the batch counts: its rows alone, left by a writer that died
        before it noted them, do not, and are overwritten by the next try."""
        return self.marks().get(stream, -1) >= batch

    def read(self) -> DataFrame:
        """All rows that count; filters on the partition column prune folders."""
        return self.read_since({})

    def read_batch(self, stream: str, batch: int) -> DataFrame:
        """The rows of one batch, in a session whose shuffles fit them."""
        folder = self._folder(stream, batch)
        session = sized_session(self.spark, sum(self._files.sizes(folder).values()))
        return session.read.schema(self.schema()).parquet(folder)

    def read_since(self, marks: Mapping[str, int], upto: Mapping[str, int] | None = None) -> DataFrame:
        """The rows of batches after ``marks``, up to ``upto``; folders of others
        are pruned. A stream that ``marks`` does not name is new."""
        upto = self.marks() if upto is None else upto
        if not upto:
            return _no_rows(self.spark, self.schema())
        wanted = [
            (F.col(STREAM) == stream) & (F.col(BATCH) > marks.get(stream, -1)) & (F.col(BATCH) <= last)
            for stream, last in upto.items()
        ]
        return self.tagged().filter(reduce(lambda a, b: a | b, wanted)).drop(STREAM, BATCH)

    def tagged(self) -> DataFrame:
        """The rows of all folders with their stream and batch."""
        fields = self.schema().fields
        schema = StructType([*fields, StructField(STREAM, StringType()), StructField(BATCH, LongType())])
        if not self.exists():
            return _no_rows(self.spark, schema)
        return self.spark.read.schema(schema).parquet(self.path).select(*schema.fieldNames())


class ParquetState:
    """Rows that merges and refreshes replace, whole or bucket by bucket."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, buckets: bool = False):
        self.spark = spark
        self.path = path.rstrip("/")
        self.declared_schema = schema
        self.buckets = buckets
        self._files = Files(spark)

    @property
    def name(self) -> str:
        return self.path.rsplit("/", 1)[1]

    def on(self, session: SparkSession) -> ParquetState:
        return ParquetState(session, self.path, self.declared_schema, self.buckets)

    def _pointer(self) -> dict:
        """The commit that counts: folders by bucket as [folder, bytes, rows,
        active rows], the last batch of each stream, folders no longer used, how
        many buckets keys are dealt to, changes held back (``held``), and, where
        commits are fed to readers, since which commit and the folders of each."""
        found = self._files.read_json(f"{self.path}/current.json")
        found = found or {"number": 0, "schema": self.declared_schema.jsonValue(), "folders": {}, "marks": {}, "unused": []}
        if any(isinstance(folder, str) for _, folder in found.get("deltas", [])):
            # A feed of an older form: its readers read the table once instead.
            found |= {"fed_from": found["number"], "deltas": []}
        return found

    def _check_buckets(self, base: dict, spec: TableSpec) -> None:
        stored = base.get("buckets", spec.buckets)
        if stored != spec.buckets:
            raise ValueError(
                f"{self.path} has {stored} buckets, its specification {spec.buckets}: rebucket() rewrites the table once"
            )

    def rebucket(self, spec: TableSpec) -> int:
        """Deal the keys out to as many buckets as the specification has now."""
        base = self._pointer()
        session = sized_session(self.spark, self.stored_bytes())
        dealt = self.on(session)._read(base).withColumn(BUCKET, spec.bucket())
        written = self._write(dealt.repartition(BUCKET))
        return self._commit(base, written, base["marks"], buckets=spec.buckets)

    def rebuild(self, rows: DataFrame, marks: Mapping[str, int], buckets: int | None = None) -> int:
        """Make ``rows``, with their buckets, the whole content, keeping what else
        is known of the table; readers of its commits have to start anew."""
        base = self._pointer()
        written = self._write(rows.repartition(BUCKET))
        return self._commit(base, written, marks, rows.schema, buckets, restart=True)

    def held(self) -> dict:
        """Up to which position changes were merged, and for each stream the first
        batch with changes that were held back; empty if none ever were."""
        return self._pointer().get("held", {})

    def feed(self) -> None:
        """From now on keep the rows that each commit replaced and put in."""
        base = self._pointer()
        if "fed_from" not in base:
            self._files.write_json(f"{self.path}/current.json", {**base, "fed_from": base["number"], "deltas": []})

    def fed_from(self) -> int | None:
        """The commit after which all changes are known; readers that are not so
        far have to read the table."""
        return self._pointer().get("fed_from")

    def deltas_since(self, number: int) -> DataFrame:
        """The rows that commits after ``number`` took out (sign -1) and put in
        (sign 1)."""
        pointer = self._pointer()
        schema = StructType([*StructType.fromJson(pointer["schema"]).fields, StructField(SIGN, LongType())])
        folders = [f"{self.path}/data/{folder}" for commit, found in pointer.get("deltas", []) if commit > number for folder in found]
        if not folders:
            return _no_rows(self.spark, schema)
        rows = self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(*folders)
        return rows.withColumn(BUCKET, feed_bucket(F.col(BUCKET))).select(*schema.fieldNames())

    def forget_deltas(self, upto: int) -> None:
        """Delete what all readers have taken."""
        base = self._pointer()
        done = [entry for entry in base.get("deltas", []) if entry[0] <= upto]
        if done:
            left = [entry for entry in base["deltas"] if entry[0] > upto]
            pointer = {**base, "deltas": left, "fed_from": max(base["fed_from"], upto)}
            self._files.write_json(f"{self.path}/current.json", pointer)
        for folder in (folder for _, found in done for folder in found):
            self._files.delete(f"{self.path}/data/{folder}")

    def exists(self) -> bool:
        return self._pointer()["number"] > 0

    def number(self) -> int:
        """How many commits there were."""
        return self._pointer()["number"]

    def marks(self) -> dict[str, int]:
        return self._pointer()["marks"]

    def folders(self) -> dict[str, str]:
        return {bucket: folder[0] for bucket, folder in self._pointer()["folders"].items()}

    def counts(self) -> tuple[int, int | None]:
        """Rows and active rows, as counted when they were written."""
        folders = self._pointer()["folders"].values()
        active = [f[3] for f in folders if f[3] is not None]
        return sum(f[2] for f in folders), sum(active) if active else None

    def stored_bytes(self) -> int:
        return sum(f[1] for f in self._pointer()["folders"].values())

    def has_applied(self, stream: str, batch: int) -> bool:
        return self.marks().get(stream, -1) >= batch

    def read(self) -> DataFrame:
        return self._read(self._pointer())

    def _read(self, pointer: dict, buckets: Iterable[str] | None = None) -> DataFrame:
        schema = StructType.fromJson(pointer["schema"])
        folders = pointer["folders"]
        chosen = [folders[b][0] for b in (folders if buckets is None else buckets) if b in folders]
        if not chosen:
            return _no_rows(self.spark, schema)
        reader = self.spark.read.schema(schema).option("basePath", f"{self.path}/data")
        return reader.parquet(*[f"{self.path}/data/{folder}" for folder in chosen]).select(*schema.fieldNames())

    def replace(self, df: DataFrame) -> int:
        """Make ``df`` the whole content, schema included; returns its rows."""
        base = self._pointer()
        written = self._write(df)
        self._commit(base, written, {}, schema=df.schema)
        return sum(folder[2] for folder in written.values())

    def merge(
        self,
        latest: DataFrame,
        spec: TableSpec,
        delete_mode: str = SOFT,
        late_delete: str = LATE_WINS,
        marks: Mapping[str, int] | None = None,
        held: dict | None = None,
    ) -> int:
        """Merge prepared changes, one per key; returns the number of the commit."""
        base = self._pointer()
        self._check_buckets(base, spec)
        if base["number"] and StructType.fromJson(base["schema"]).simpleString() != spec.silver_schema().simpleString():
            raise ValueError(f"{self.path} has other columns than its specification: rebuild it from its history")

        def combine(old: DataFrame, new: DataFrame, with_images: bool = False) -> DataFrame:
            return merge_latest(old, new, spec, delete_mode, late_delete, with_images)

        return self.fold(latest, combine, marks, spec.buckets, held, spec.silver_schema())

    def fold(
        self,
        changes: DataFrame,
        combine: Callable[..., DataFrame],
        marks: Mapping[str, int] | None = None,
        buckets: int | None = None,
        held: dict | None = None,
        schema: StructType | None = None,
    ) -> int:
        """Replace the rows of the buckets that ``changes`` fall into by what
        ``combine`` makes of (rows, changes); returns the number of the commit.
        Where commits are fed to readers it is called ``with_images``, and what was
        taken out and put in (``operators/feed.py``) is written along with the rows.

        The changes are first written to the shared scratch folder: they are not
        computed again, and a lost executor costs a re-read only. The buckets
        they fall into, as many as the specification has at most, are read and
        rewritten. Both sides are dealt out once: by bucket if there are as many
        as shuffle partitions, which keeps files few, else by bucket and key, so
        that the work is not held to as many tasks as there are buckets.
        """
        base = self._pointer()
        staged_at = scratch_path(self.spark, f"changes-{self.name}")
        try:
            seen = Observation()
            # A number for each bucket: as many as the specification has at most.
            found = F.concat_ws(",", F.collect_set(F.col(BUCKET).cast("string")))
            changes.observe(seen, found.alias("buckets")).write.parquet(staged_at)
            touched = [bucket for bucket in seen.get["buckets"].split(",") if bucket]
            stored = sum(self._files.sizes(staged_at).values())
            stored += sum(base["folders"][b][1] for b in touched if b in base["folders"])
            fed_too = "fed_from" in base
            folders = len(touched) * (2 if fed_too else 1)
            session = fork_session(
                sized_session(self.spark, stored),
                **{
                    "spark.sql.requireAllClusterKeysForCoPartition": "false",
                    # Rows need no sort before the write if a task may keep a file open for each folder.
                    "spark.sql.maxConcurrentOutputFileWriters": str(folders if folders <= OPEN_FILES else 0),
                    # The default, INT96, takes a third of the time of reading orders back.
                    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
                },
            )
            old = self.on(session)._read(base, touched)
            new = session.read.schema(schema or changes.schema).parquet(staged_at)
            width = max(1, int(session.conf.get("spark.sql.shuffle.partitions")))
            if width <= len(touched):
                old, new = (side.repartition(width, BUCKET) for side in (old, new))
            if fed_too:
                names = (schema or changes.schema).fieldNames()
                written, delta = self._apart(self._write(fed(combine(old, new, with_images=True), names)))
            else:
                written, delta = self._write(combine(old, new)), None
        finally:
            self._files.delete(staged_at)
        kept = {b: folder for b, folder in base["folders"].items() if b not in touched}
        marks = {**base["marks"], **(marks or {})}
        return self._commit(base, {**kept, **written}, marks, buckets=buckets, held=held, delta=delta)

    @staticmethod
    def _apart(written: dict[str, list]) -> tuple[dict[str, list], list[str]]:
        """The folders of a commit's rows, and those of its feed."""
        rows = {bucket: folder for bucket, folder in written.items() if int(bucket) >= 0}
        return rows, sorted(folder[0] for bucket, folder in written.items() if bucket not in rows)

    def _write(self, df: DataFrame) -> dict[str, list]:
        """Write rows to a folder that no pointer names yet, and count them there
        by bucket, reading a column or two of what was written."""
        commit = f"commit={uuid.uuid4().hex}"
        root = f"{self.path}/data/{commit}"
        (df.write.partitionBy(BUCKET) if self.buckets else df.write).parquet(root)
        sizes = self._files.sizes(root)
        if not sizes:
            return {}
        written = df.sparkSession.read.schema(df.schema).parquet(root)
        active = F.count_if("is_active") if "is_active" in df.columns else F.lit(None)
        by = [F.col(BUCKET).cast("string")] if self.buckets else [F.lit("")]
        counted = written.groupBy(by[0].alias("bucket")).agg(F.count(F.lit(1)).alias("rows"), active.alias("active"))
        counts = {bucket: (rows, live) for bucket, rows, live in counted.collect()}
        out = {}
        for folder, size in sizes.items():
            bucket = folder.split("=", 1)[1] if folder else ""
            rows, live = counts.get(bucket, (0, None))
            out[bucket] = [f"{commit}/{folder}".rstrip("/"), size, rows, live]
        return out

    def _commit(
        self,
        base: dict,
        folders: dict[str, list],
        marks: Mapping[str, int],
        schema: StructType | None = None,
        buckets: int | None = None,
        held: dict | None = None,
        delta: list[str] | None = None,
        restart: bool = False,
    ) -> int:
        if self._pointer()["number"] != base["number"]:
            raise ConcurrentCommitError(f"{self.path} was changed meanwhile")
        used = {folder[0] for folder in folders.values()}
        pointer = {
            **base,
            "number": base["number"] + 1,
            "schema": schema.jsonValue() if schema else base["schema"],
            "folders": folders,
            "marks": dict(marks),
            "unused": [folder[0] for folder in base["folders"].values() if folder[0] not in used],
        }
        if buckets is not None:
            pointer["buckets"] = buckets
        if held is not None:
            pointer["held"] = held
        if delta is not None:
            pointer["deltas"] = [*base["deltas"], [pointer["number"], delta]]
        if restart and "fed_from" in base:
            pointer.update(fed_from=pointer["number"], deltas=[])
        self._files.write_json(f"{self.path}/current.json", pointer)
        # Readers of the commit before may still be at work; the one before that is done.
        for folder in base["unused"]:
            self._files.delete(f"{self.path}/data/{folder}")
        return pointer["number"]


def _joined(a: Mapping[str, list], b: Mapping[str, list]) -> dict[str, list]:
    """Bounds of two sets of batches together."""
    out = dict(a)
    for name, (rows, newest) in b.items():
        n, t = out.get(name, [0, None])
        out[name] = [n + rows, max((x for x in (t, newest) if x is not None), default=None)]
    return out


def _no_rows(spark: SparkSession, schema: StructType) -> DataFrame:
    """The filter lets the optimizer see that there are no rows."""
    return spark.createDataFrame([], schema).filter(F.lit(False))


def widen(old: StructType, new: StructType) -> StructType:
    """``old`` plus the columns only ``new`` has; a changed type is refused."""
    types = {f.name: f.dataType for f in old.fields}
    added = []
    for f in new.fields:
        if f.name not in types:
            added.append(StructField(f.name, f.dataType, True))
        elif types[f.name].simpleString() != f.dataType.simpleString():
            raise TypeError(f"column {f.name} is {types[f.name].simpleString()}, not {f.dataType.simpleString()}")
    return StructType([*old.fields, *added])
