"""Replay removal without a limit of time.

An index of what a history holds: for each run of batches the digests of its rows,
by part, and a Bloom filter. New rows ask all filters; only parts of runs that
answer are read, and compared digest by digest. So a filter that is wrong costs a
look, never a row.

The index is derived from the history and catches up with it before each look, so
rows that came by another way are known too, and a writer that died between the two
leaves nothing out. Runs of the same age are merged, ``FAN`` at a time: there are
some FAN * log(batches) of them, and a digest is rewritten log(batches) times. A row
costs 16 bytes of digest and two to four of filter, whatever it holds.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from siltlake.operators import bloom
from siltlake.operators.bloom import DIGEST
from siltlake.operators.dedup import digest
from siltlake.plans.layers import append_bronze
from siltlake.session import scratch_path, sized_session
from siltlake.spec import ARRIVAL, DAY, POSITION, TableSpec
from siltlake.tables import ParquetHistory
from siltlake.tables.files import Files

# Runs of one age that are merged into one of the next.
FAN = 8
# Digests to a part (64 MB), and parts to a run at most; beyond that parts grow.
PER_PART = 1 << 22
MOST_PARTS = 1024


def identity_of(spec: TableSpec, positions: bool) -> list[str]:
    """What makes a change of a table the same as another: all that bronze keeps of
    it but the time of arrival, and, where sources number a repeat anew, the position."""
    without = {ARRIVAL, DAY} if positions else {ARRIVAL, DAY, POSITION}
    return [name for name in spec.bronze_schema().fieldNames() if name not in without]


class Seen:
    """The rows that a history has by ``identity``. One writer at a time."""

    def __init__(self, history, identity: Sequence[str], fan: int = FAN):
        if not isinstance(history, ParquetHistory):
            raise ValueError("replays of any age are found in histories below a folder only")
        self.history = history
        self.identity = list(identity)
        self.fan = fan
        self.spark = history.spark
        self.path = "{0}/_seen_{2}".format(*history.path.rpartition("/"))
        self._files = Files(self.spark)

    def state(self) -> dict:
        """Up to which batch of each stream rows are known, and the runs. With
        another identity all is read again."""
        found = self._files.read_json(f"{self.path}/state.json")
        if found and found["identity"] == self.identity:
            return found
        old = found or {"next": 0, "runs": [], "unused": []}
        unused = old["unused"] + [run["id"] for run in old["runs"]]
        return {"identity": self.identity, "marks": {}, "next": old["next"], "runs": [], "unused": unused}

    def catch_up(self) -> dict:
        """Take in the batches that the history has since the last time."""
        state, newest = self.state(), self.history.marks()
        if all(state["marks"].get(stream, -1) >= last for stream, last in newest.items()):
            return state
        base = list(state["unused"])
        came = self._rows_since(state["marks"], newest)
        staged_at = scratch_path(self.spark, "digests")
        try:
            counted = Observation()
            came.observe(counted, F.count(F.lit(1)).alias("rows")).write.parquet(staged_at)
            if counted.get["rows"]:
                self._add_run(state, self._digests(self.spark, [staged_at]), counted.get["rows"], 0)
        finally:
            self._files.delete(staged_at)
        state["marks"] = newest
        self._merge_runs(state)
        self._files.write_json(f"{self.path}/state.json", state)
        for run in base:  # what the state before no longer named
            for kind in ("digests", "filter"):
                self._files.delete(f"{self.path}/{kind}/run={run}")
        state["unused"] = [run for run in state["unused"] if run not in base]
        return state

    def _rows_since(self, marks: dict, upto: dict) -> DataFrame:
        rows = self.history.read_since(marks, upto)
        present = [name for name in self.identity if name in rows.columns]
        return rows.select(digest(present).alias(DIGEST))

    def _digests(self, session: SparkSession, folders: list[str]) -> DataFrame:
        """The digests of folders that are all of the index, or one by itself."""
        reader = session.read.schema(f"{DIGEST} binary")
        if folders[0].startswith(f"{self.path}/"):
            reader = reader.option("basePath", f"{self.path}/digests")
        return reader.parquet(*folders).select(DIGEST)

    def _add_run(self, state: dict, digests: DataFrame, rows: int, tier: int) -> None:
        """Write a run; a try that died before the state named it is overwritten."""
        run, level, parts = state["next"], bloom.level(rows), min(MOST_PARTS, math.ceil(rows / PER_PART))
        at = f"{self.path}/digests/run={run}"
        dealt = bloom.hashed(digests).select(DIGEST, F.pmod("_g", F.lit(parts)).alias("part"))
        dealt.hint("rebalance", "part").write.mode("overwrite").partitionBy("part").parquet(at)
        session = sized_session(self.spark, rows * 24)
        words = bloom.build(self._digests(session, [at]), level)
        words.write.mode("overwrite").parquet(f"{self.path}/filter/run={run}/level={level}")
        state["next"] = run + 1
        state["runs"].append({"id": run, "tier": tier, "rows": rows, "level": level, "parts": parts})

    def _merge_runs(self, state: dict) -> None:
        tier = 0
        while any(run["tier"] >= tier for run in state["runs"]):
            same = [run for run in state["runs"] if run["tier"] == tier]
            if len(same) >= self.fan:
                state["runs"] = [run for run in state["runs"] if run["tier"] != tier]
                rows = self._digests(self.spark, [f"{self.path}/digests/run={run['id']}" for run in same])
                self._add_run(state, rows, sum(run["rows"] for run in same), tier + 1)
                state["unused"] = state["unused"] + [run["id"] for run in same]
            tier += 1

    def append_unseen(self, changes: DataFrame, stream: str, batch: int) -> int:
        """Add the changes that the history does not have yet, each once, as a batch
        of a stream; returns how many. Of repeats in the batch the first one stays."""
        if self.history.has_applied(stream, batch):
            return 0
        state = self.catch_up()
        came_at, answers_at = scratch_path(self.spark, "came"), scratch_path(self.spark, "answers")
        try:
            present = [name for name in self.identity if name in changes.columns]
            first = [name for name in (ARRIVAL, POSITION) if name in changes.columns]
            whole, order = F.struct(*changes.columns), F.struct(*first)
            once = changes.groupBy(digest(present).alias(DIGEST)).agg(F.min_by(whole, order).alias("row"))
            once.write.parquet(came_at)
            filters = sum(run["rows"] * 4 for run in state["runs"])
            session = sized_session(self.spark, sum(self._files.sizes(came_at).values()) + filters)
            came = session.read.schema(once.schema).parquet(came_at)
            new = came
            if folders := self.answering(state, came.select(DIGEST), answers_at):
                answers = self._digests(session, [answers_at]).distinct()
                known = answers.join(self._digests(session, folders), DIGEST, "left_semi")
                new = came.join(known, DIGEST, "left_anti")
            return append_bronze(self.history, new.select("row.*"), stream, batch)
        finally:
            self._files.delete(came_at)
            self._files.delete(answers_at)

    def answering(self, state: dict, digests: DataFrame, answers_at: str) -> list[str]:
        """The folders of the parts in which filters let ``digests`` be looked for;
        those digests are written to ``answers_at``."""
        runs = state["runs"]
        if not runs:
            return []
        schema = "slot bigint, w0 bigint, w1 bigint, w2 bigint, w3 bigint, run bigint, level int"
        reader = digests.sparkSession.read.schema(schema).option("basePath", f"{self.path}/filter")
        filters = reader.parquet(*[f"{self.path}/filter/run={run['id']}" for run in runs])
        parts = F.create_map(*[F.lit(x).cast("bigint") for run in runs for x in (run["id"], run["parts"])])
        asked = bloom.ask(digests, filters, sorted({run["level"] for run in runs}))
        part = F.concat_ws("/part=", "run", F.pmod("_g", F.element_at(parts, F.col("run"))))
        seen = Observation()
        # A name for each part that answers: as many as there are parts at most.
        names = F.concat_ws(",", F.collect_set("part")).alias("parts")
        asked.select(DIGEST, part.alias("part")).observe(seen, names).select(DIGEST).write.parquet(answers_at)
        wanted = [name for name in seen.get["parts"].split(",") if name]
        stored = {
            f"{run}/{name}"
            for run in {name.split("/")[0] for name in wanted}
            for name in self._files.names(f"{self.path}/digests/run={run}")
        }
        return [f"{self.path}/digests/run={name}" for name in sorted(wanted) if name in stored]
