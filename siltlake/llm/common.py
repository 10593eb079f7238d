"""What the operators share: words, scratch tables, links to components."""

from __future__ import annotations

import re
import shutil
import tempfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltlake.session import scratch_path

# A word is a run of anything but these characters.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"

# Rows up to which a table of one row per source or group is broadcast.
BROADCAST_ROWS = 20_000


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers of the application, which may
    not have it installed; once for each application."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        name = f"{tempfile.mkdtemp(prefix='siltlake-')}/{package.name}"
        context.addPyFile(shutil.make_archive(name, "zip", package.parent, package.name))
        _SHIPPED.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: later steps
    neither recompute it nor depend on the executors that made it."""
    spark = df.sparkSession
    path = scratch_path(spark, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole_row(df: DataFrame) -> Column:
    """All columns in one struct, so that added columns cannot clash with them."""
    return F.struct(*[F.col("`" + name.replace("`", "``") + "`") for name in df.columns])


def unpack(df: DataFrame, row: str = "row") -> DataFrame:
    """The columns of ``whole_row`` again, and nothing else."""
    return df.select(f"{row}.*")


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, to be broadcast if a count shows that it has few rows."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def utf8(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def word_blocks(data: bytes, limit: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a text, in lists for about ``limit`` bytes each, so that
    the memory a very long text takes does not grow with its words."""
    start = 0
    while start < len(data):
        gap = re.compile(rb"[\x20\x09-\x0D]").search(data, start + limit)
        end = gap.start() if gap else len(data)
        yield data[start:end].split()
        start = end


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b); the root is the least
    node that can be reached.

    Alternating large and small stars: each round hangs the neighbours of a
    node below its least neighbour, so chains shrink by their logarithm. Each
    round is written to the scratch folder. The least neighbour of a node is
    found with map-side aggregation and stored before it is joined, so that
    adaptive execution can split the rows of a node with many neighbours.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    edges = stored(links.filter("a <> b").select(high.alias("hi"), low.alias("lo")).distinct(), "edges")
    before = None
    while (now := _state(edges)) != before:
        before = now
        both = edges.selectExpr("hi AS u", "lo AS v").unionAll(edges.selectExpr("lo AS u", "hi AS v"))
        least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = stored(both.join(least, "u").filter("v > u").selectExpr("v AS hi", "m AS lo").distinct(), "large")
        least = stored(large.groupBy("hi").agg(F.min("lo").alias("m")), "least")
        moved = large.join(least, "hi").filter("lo <> m").selectExpr("lo AS hi", "m AS lo")
        edges = stored(moved.unionAll(least.selectExpr("hi", "m AS lo")).distinct(), "edges")
    return edges.selectExpr("hi AS node", "lo AS root").unionAll(edges.selectExpr("lo AS node", "lo AS root").distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first())
