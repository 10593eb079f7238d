"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target, in words. A document of it is expected target /
source size times: whole copies of that are certain, the rest is the chance of one
more, which differs between documents: longer ones are favoured, up to ten times
as much as one of ten words. Documents are ranked by random odds divided by inclusion odds and taken
in this order until the words still to be taken are filled; one more document,
the one whose size fits best into what is left, closes the gap.

A source is never ranked as a whole. The ranks are cut into buckets by value,
the words of each are summed, and only the documents of the one bucket in which
the target falls are put in order. What a document gets then follows from its
own row and one row of its source, so texts are not shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltlake.llm.common import WORD, broadcast_if_small, stored, unpack, whole_row

# The weights of the sources in order, repeating, and the digits
# of the hash that make a random number between 0 and 1.
WEIGHTS = (3, 1, 2)
HEX_DIGITS = 13


@dataclass(frozen=True)
class Mix:
    """``share`` of all words is dealt out by weight. No source is repeated
    more than ``most`` times, or less than ``least`` times on average."""

    weights: tuple[int, ...] = WEIGHTS
    share: float = 1.5
    most: float = 2.0
    least: float = 0.0
    buckets: int = 4096
    seed: str = "mix"


# Chances stay below one, as odds have to be finite.
MOST_CHANCE = 0.999
# Parts that equal rows are numbered in.
SALTS = 1024


def n_words(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """(source, source_size, target) from (source, source_size), a row for each
    source. Where all weights together pass a bound of some sources, these stay
    at the bound and the others share the rest by weight."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*map(F.lit, mix.weights))
    place = (F.row_number().over(order) - 1) % len(mix.weights)
    rows = sizes.withColumn("weight", F.element_at(weights, (place + 1).cast("int")))
    everything = Window.partitionBy()
    total = F.sum("source_size").over(everything) * F.lit(mix.share)
    rows = rows.withColumn("total", total)
    # Sources reach the upper bound in the order of size by weight: what is
    # left beyond the first k of them is shared by the others.
    by_ratio = Window.orderBy((F.col("source_size") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    taken = F.coalesce(F.sum(F.col("source_size") * F.lit(mix.most)).over(before), F.lit(0.0))
    level = (F.col("total") - taken) / F.sum("weight").over(rest)
    rows = rows.withColumn("level", level)
    open_ = F.col("level") * F.col("weight") <= F.col("source_size") * F.lit(mix.most)
    rows = rows.withColumn("open_level", F.when(open_, F.col("level")))
    first = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    chosen = F.first("open_level", ignorenulls=True).over(first)
    shared = F.least(F.col("weight") * chosen, F.col("source_size") * F.lit(mix.most))
    raised = F.greatest(F.coalesce(shared, F.col("source_size") * F.lit(mix.most)), F.col("source_size") * F.lit(mix.least))
    return rows.select("source", "source_size", raised.cast("double").alias("target"))


def _digest(doc_id: Column, size: Column, text: Column, mix: Mix) -> Column:
    """Random digits that depend on the document only."""
    words = F.md5(F.coalesce(text, F.lit("")).cast("binary"))
    return F.md5(F.concat_ws(":", F.lit(mix.seed), F.coalesce(doc_id.cast("string"), F.lit("")), size.cast("string"), words))


def favour(size: Column) -> Column:
    """How much likelier a document is to be sampled, in thousandths: longer ones,
    up to ten times as likely as one of ten words."""
    return F.floor(1000 * size / (size + 100)).cast("bigint")


def _place(size: Column, digest: Column) -> Column:
    """Random odds by inclusion odds; ties by the digits. The inclusion chance is
    the part of the source that is wanted, times the document's favour by the
    source's mean, so that the expected number of words is the one wanted."""
    u = F.conv(F.substring(digest, 1, HEX_DIGITS), 16, 10).cast("bigint") / F.lit(float(16**HEX_DIGITS))
    chance = F.least(F.col("part") * (favour(size).cast("double") * F.col("source_size").cast("double") / F.nullif(F.col("favours"), F.lit(0.0))), F.lit(MOST_CHANCE))
    return F.struct(((u / (1 - u)) / F.nullif(chance / (1 - chance), F.lit(0.0))).alias("odds"), digest.alias("digest"))


def _source_key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source), F.lit("-"))


def _with_copies(rows: DataFrame) -> DataFrame:
    """``rows`` (size, digest and the plan of their source) with their ``copies``.

    Of rows that share the place at which a source is cut only some are taken.
    Equal rows are many in bad tables: those in question, and only those, are
    stored with salts, and counted and numbered salt by salt.
    """
    placed = rows.withColumn("place", _place(F.col("size"), F.col("digest")))
    open_ = (F.col("part") > 0) & (F.col("size") > 0)
    at_cut, at_closing = F.col("place") == F.col("cut"), F.col("place") == F.col("closing")
    quota = F.when(at_cut, F.col("cut_n")).when(at_closing, F.lit(1)).cast("bigint")
    among = F.when(at_cut, F.col("cut_m")).when(at_closing, F.col("closing_m")).cast("bigint")
    # What a cut leaves out of a tie, and the closing row of another.
    split = open_ & F.coalesce((quota > 0) & (quota < among), F.lit(False))
    sampled = open_ & F.coalesce((F.col("place") < F.col("cut")) | (quota >= among), F.lit(False))
    plain = placed.filter(~split).withColumn("copies", F.col("whole") + sampled.cast("int"))
    salted = placed.filter(split).withColumns({"quota": quota, "salt": F.pmod(F.monotonically_increasing_id(), F.lit(SALTS))})
    tied = stored(salted, "ties")
    tie = ["source_key", "place", "salt"]
    ahead = Window.partitionBy("source_key", "place").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    before = tied.groupBy(*tie).agg(F.count("*").alias("n")).select(*tie, F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))
    number = F.row_number().over(Window.partitionBy(*tie).orderBy("digest"))
    numbered = tied.withColumn("number", number).join(before, tie)
    more = numbered.withColumn("copies", F.col("whole") + (F.col("before") + F.col("number") <= F.col("quota")).cast("int"))
    return plain.unionByName(more.select(*plain.columns))


def plan(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """A row for each source: source_key, source_size, target, whole copies,
    part (inclusion chance of one more), and the places cut and closing.

    ``docs`` has doc_id, source and size, and is stored.
    """
    sizes = docs.groupBy("source").agg(F.sum("size").cast("bigint").alias("source_size"))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    sources = stored(
        targets(sizes, mix)
        .withColumn("ratio", ratio)
        .withColumn("whole", F.floor("ratio").cast("int"))
        .withColumn("part", F.col("ratio") - F.col("whole"))
        .withColumn("wanted", F.col("target") - F.col("whole") * F.col("source_size"))
        .withColumn("source_key", _source_key(F.col("source"))),
        "sources",
    )
    favours = docs.groupBy(_source_key(F.col("source")).alias("source_key")).agg(
        F.sum(favour(F.col("size")) * F.col("size")).cast("double").alias("favours")
    )
    sources = stored(sources.join(favours, "source_key"), "favours")
    # Rows of one place are equal: they count as one, from the map side on.
    ranked = (
        docs.filter("size > 0")
        .select(_source_key(F.col("source")).alias("source_key"), "size", "digest")
        .join(broadcast_if_small(sources.select("source_key", "part", "wanted", "source_size", "favours")), "source_key")
        .filter("part > 0")
        .withColumn("place", _place(F.col("size"), F.col("digest")))
        .groupBy("source_key", "place", "size", "wanted").agg(F.count("*").alias("m"))
        .withColumn("bucket", F.floor(F.col("place.odds") / (1 + F.col("place.odds")) * mix.buckets))
    )
    ranked = stored(ranked, "places")
    by_bucket = Window.partitionBy("source_key").orderBy("bucket")
    buckets = (
        ranked.groupBy("source_key", "bucket")
        .agg(F.sum(F.col("size") * F.col("m")).alias("words"), F.first("wanted").alias("wanted"))
        .withColumn("through", F.sum("words").over(by_bucket))
        .withColumn("before", F.col("through") - F.col("words"))
    )
    # The bucket in which the words wanted are reached; its places in order.
    split = stored(buckets.filter("before <= wanted AND wanted < through").select("source_key", "bucket", "before"), "split")
    by_place = Window.partitionBy("source_key").orderBy("place")
    reached = (
        ranked.join(broadcast_if_small(split), ["source_key", "bucket"])
        .withColumn("through", F.col("before") + F.sum(F.col("size") * F.col("m")).over(by_place))
        .filter("through > wanted")
        .groupBy("source_key")
        .agg(F.min(F.struct("place", "size", "m", "through", "wanted")).alias("first"))
        .select("source_key", "first.*")
        .withColumn("start", F.col("through") - F.col("size") * F.col("m"))
        .withColumn("cut_n", F.floor((F.col("wanted") - F.col("start")) / F.col("size")).cast("bigint"))
    )
    # Places before the cut are taken whole, at the cut cut_n of cut_m rows.
    cuts = stored(
        reached.select(
            "source_key", F.col("place").alias("cut"), "cut_n", F.col("m").alias("cut_m"),
            (F.col("wanted") - F.col("start") - F.col("cut_n") * F.col("size")).alias("gap"),
        ),
        "cuts",
    )
    # One row more, the one that comes nearest to the words wanted, if it does.
    left = F.col("m") - F.when(F.col("place") == F.col("cut"), F.col("cut_n")).otherwise(F.lit(0))
    off = F.abs(F.col("gap") - F.col("size"))
    closing = (
        ranked.join(broadcast_if_small(cuts), "source_key")
        .filter((F.col("place") >= F.col("cut")) & (left > 0) & (off < F.col("gap")))
        .groupBy("source_key")
        .agg(F.min(F.struct(off.alias("off"), F.col("place").alias("place"), F.col("m").alias("m"))).alias("best"))
        .select("source_key", F.col("best.place").alias("closing"), F.col("best.m").alias("closing_m"))
    )
    same = F.coalesce(F.col("closing") == F.col("cut"), F.lit(False))
    ends = cuts.drop("gap").join(closing, "source_key", "left").withColumns(
        {"cut_n": F.col("cut_n") + same.cast("int"), "closing": F.when(~same, F.col("closing"))}
    )
    return stored(sources.join(ends, "source_key", "left"), "plan")


def sized(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """doc_id, source, size and digest of ``docs``, stored."""
    rows = docs.select("doc_id", "source", "text", n_words(F.col("text")).alias("size"))
    return stored(rows.withColumn("digest", _digest(F.col("doc_id"), F.col("size"), F.col("text"), mix)).drop("text"), "sizes")


def taken(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """doc_id, size, source_size, target and taken (words that the mix takes,
    repeats counted) for each row of ``docs``.

    A null source is a source of its own, the last. Null ids and texts are
    ranked like others; texts without words take nothing. Rows that are equal in
    id and text share their rank: where the sample ends among them, as many are
    taken as fit. Without rows there is no source.
    """
    rows = sized(docs, mix)
    keyed = rows.withColumn("source_key", _source_key(F.col("source")))
    planned = keyed.join(broadcast_if_small(plan(rows, mix).drop("source")), "source_key")
    return _with_copies(planned).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


def mixed(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The rows of the mix, with all columns of ``docs``: a row as often as the
    mix takes it. Texts do not move, but for those of equal rows among which the
    sample ends."""
    size = n_words(F.col("row.text"))
    rows = docs.select(whole_row(docs).alias("row")).withColumn("size", size)
    rows = rows.withColumn("digest", _digest(F.col("row.doc_id"), F.col("size"), F.col("row.text"), mix))
    rows = rows.withColumn("source_key", _source_key(F.col("row.source")))
    planned = rows.join(broadcast_if_small(plan(sized(docs, mix), mix).drop("source")), "source_key")
    return unpack(
        _with_copies(planned).filter("copies > 0").select("row", F.explode(F.expr("sequence(1, copies)"))).select("row")
    )
