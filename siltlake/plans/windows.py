"""Window counts that late events correct.

A stream with a watermark drops what comes behind it. Here each batch adds partial
counts of the windows it touches, whenever those were; a batch that is delivered
again replaces its own. A reader sums the parts, so a count is right as soon as its
events are there, in whatever order they came. ``settle`` folds parts into one row
for each window, which bounds what a reader sums.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from siltlake.operators.audit import windowed_op_counts
from siltlake.operators.totals import add_totals
from siltlake.plans.lake import Lake
from siltlake.spec import BUCKET, schema_of
from siltlake.streaming.jobs import AVAILABLE_NOW, Trigger, append_stream
from siltlake.tables.store import ParquetState

KEYS = ("window_start", "window_end", "op")
COLUMNS = [("window_start", "timestamp"), ("window_end", "timestamp"), ("op", "string"), ("cnt", "bigint")]


class LateWindows:
    """Counts by operation in windows of ``time``, kept under ``name`` in the lake."""

    def __init__(self, lake: Lake, name: str, time: str, duration: str, slide: str | None = None, buckets: int = 16):
        self.window = (time, duration, slide)
        self.buckets = buckets
        self.parts = lake.history(f"{name}_parts", schema_of(COLUMNS))
        self.settled = ParquetState(lake.spark, f"{lake.root}/{name}_settled", schema_of([*COLUMNS, (BUCKET, "int")]), buckets=True)

    def count(self, events: DataFrame, checkpoint: str, trigger: Trigger = AVAILABLE_NOW) -> StreamingQuery:
        """Add the counts of every batch of a stream of events. Events without a
        time are in no window."""
        return append_stream(events, self.parts, checkpoint, lambda batch: windowed_op_counts(batch, *self.window), trigger)

    def settle(self) -> int:
        """Fold the parts that came since the last time into the totals; returns the
        number of the commit. Only buckets with windows that changed are rewritten."""
        upto = self.parts.marks()
        bucket = F.pmod(F.xxhash64(*KEYS), F.lit(self.buckets)).cast("int").alias(BUCKET)
        new = _summed(self.parts.read_since(self.settled.marks(), upto)).select("*", bucket)
        return self.settled.fold(new, partial(add_totals, keys=KEYS, sums=["cnt"]), upto, self.buckets)

    def read(self) -> DataFrame:
        """window_start, window_end, op and cnt, as far as events have come."""
        open_ = self.parts.read_since(self.settled.marks())
        return _summed(self.settled.read().drop(BUCKET).unionByName(open_))


def _summed(parts: DataFrame) -> DataFrame:
    return parts.groupBy(*KEYS).agg(F.sum("cnt").alias("cnt"))
