"""Near-duplicates by SimHash fingerprints and pivot distance tables.

A fingerprint has a bit for each hyperplane: 1 if over half of the shingle
hashes of the text have it. Distances to fixed reference fingerprints (pivots)
are tabulated; by the triangle inequality two fingerprints within the radius
differ by at most the radius in every coordinate, so a pair with a larger
difference anywhere is discarded, and only survivors are compared bit by bit.

The distance tables also deal the fingerprints out. Each table has references
that differ on some bits only; the distances on these bits are its coordinates,
and fingerprints that agree in all of them meet in a cell.

* ``exact_masks``: the bits are cut into ``radius + 2`` blocks and a table is
  kept for every two of them. Fingerprints within the radius differ in at most
  ``radius`` blocks, so they meet in a table: no link is lost.
* ``sampled_masks``: for radii too wide for that, tables over random bits; their
  number follows from the recall asked for.

Copies are one fingerprint from the start. A cell of very many different
fingerprints is dealt out once more, by tables over the bits that its own table
leaves out, in which the same argument holds: pairs within the radius meet there.
What is left in one cell is cut into blocks, and every two blocks meet in a task
of their own: all members are compared, none is dropped, and a task emits at most
one link for each member it holds.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltlake.llm.common import components, stored, unpack, utf8, whole_row, word_blocks

# Fixed value: the seed of the shingle hashes.
SEED = 42
# Members of a cell that one task compares with each other.
CELL = 128
PIVOTS = 16
# Members from which a cell is dealt out once more, for radii up to MOST_REFINED
# (the tables that takes grow with the square of the radius).
HOT_CELL, MOST_REFINED = 64 * CELL, 4


# Fingerprints


def shingle_hashes(data: bytes | None, size: int) -> Iterator[np.ndarray]:
    """XXH64 of all shingles of ``size`` words, A-Z in lower case, in arrays.
    Texts of fewer words are one shingle, texts without words have none."""
    digest, carry, n_shingles = xxhash.xxh64_intdigest, [], 0
    for block in word_blocks(data or b""):
        words = carry + [word.lower() for word in block] if carry else [*map(bytes.lower, block)]
        if len(words) >= size:
            lengths = np.fromiter(map(len, words), np.int64, len(words))
            ends = np.cumsum(lengths + 1) - 1
            joined = b" ".join(words)
            spans = zip((ends - lengths)[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist())
            out = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, len(words) - size + 1)
            n_shingles += len(out)
            yield out
            carry = words[len(words) - size + 1 :]
        else:
            carry = words
    if carry and not n_shingles:
        yield np.array([digest(b" ".join(carry), SEED)], np.uint64)


def widen(hashes: np.ndarray, width: int) -> np.ndarray:
    """``width`` bits from each hash, the first 64 being the hash itself."""
    out = np.empty((len(hashes), width // 64), np.uint64)
    out[:, 0] = hashes
    for i in range(1, width // 64):
        x = hashes + np.uint64((0x9E3779B97F4A7C15 * i) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        out[:, i] = x ^ (x >> np.uint64(31))
    return out


def bit_counts(words: np.ndarray) -> np.ndarray:
    """How many rows have each bit, most significant first."""
    total = np.zeros(words.shape[1] * 64, np.int64)
    for start in range(0, len(words), 255 * 64):
        part = words[start : start + 255 * 64].astype(">u8").view(np.uint8)
        bits = np.unpackbits(part, axis=1).view(np.uint64)  # eight counters of a byte each
        sums = np.add.reduceat(bits, np.arange(0, len(bits), 255), axis=0)
        total += sums.view(np.uint8).sum(axis=0, dtype=np.int64)
    return total


def fingerprint(data: bytes | None, size: int, width: int = 64, distinct: bool = False) -> bytes:
    """The fingerprint as big-endian bytes; zero for a text without words."""
    votes, n = np.zeros(width, np.int64), 0
    parts = shingle_hashes(data, size)
    if distinct:
        held = list(parts)
        parts = iter([np.unique(np.concatenate(held))] if held else [])
    for hashes in parts:
        votes += bit_counts(widen(hashes, width))
        n += len(hashes)
    return np.packbits(2 * votes > n).tobytes()


def fingerprint_column(text: Column, size: int, width: int = 64, distinct: bool = False) -> Column:
    @F.arrow_udf("binary")
    def compute(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(x, size, width, distinct) for x in utf8(texts)], pa.binary())

    return compute(text)


def as_words(prints: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(prints), ">u8").astype(np.uint64).reshape(len(prints), -1)


# Pivot tables


def exact_masks(width: int, radius: int) -> list[np.ndarray]:
    """Bits of every two of ``radius + 2`` blocks."""
    blocks = np.array_split(np.arange(width), radius + 2)
    return [np.concatenate(pair) for pair in itertools.combinations(blocks, 2)]


def sampled_masks(width: int, radius: int, n_prints: int, recall: float, seed: int = 7) -> list[np.ndarray]:
    """Random bits, enough for cells of few unrelated fingerprints, in as many
    tables as pairs at 0.9 of the radius need to meet with chance ``recall``."""
    bits = max(16, math.ceil(math.log2(max(n_prints, 2))) - 2)
    meets = (1 - 0.9 * radius / width) ** bits
    rng = np.random.default_rng(seed)
    n_tables = math.ceil(math.log(1 - recall) / math.log(1 - meets))
    return [rng.choice(width, bits, replace=False) for _ in range(n_tables)]


@dataclass(frozen=True)
class PivotTables:
    width: int
    radius: int
    masks: list[np.ndarray]
    seed: int = 11

    def cells(self, prints: np.ndarray) -> np.ndarray:
        """The cell of each fingerprint in each table: its distances to the
        references of the table, on the bits of the table, as one number."""
        rng = np.random.default_rng(self.seed)
        out = np.empty((len(prints), len(self.masks)), np.uint64)
        for i, bits in enumerate(self.masks):
            mask = _pack(np.isin(np.arange(self.width), bits)[None])
            pivots = _pack(rng.integers(0, 2, (PIVOTS, self.width)))
            factors = rng.integers(0, 2**63, PIVOTS + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
            distances = _distances(prints & mask, pivots & mask)
            out[:, i] = (distances * factors[:-1]).sum(axis=1, dtype=np.uint64) + factors[-1]
        return out.view(np.int64)

    def refined(self, table: int) -> PivotTables:
        """Tables for the members of one cell of a table: over its bits and every
        two blocks of the others."""
        own = self.masks[table]
        blocks = np.array_split(np.setdiff1d(np.arange(self.width), own), self.radius + 2)
        masks = [np.concatenate([own, *pair]) for pair in itertools.combinations(blocks, 2)]
        return PivotTables(self.width, self.radius, masks, self.seed + 1000 * (table + 1))

    def coordinates(self, prints: np.ndarray) -> np.ndarray:
        """Distances to the references that all fingerprints share."""
        rng = np.random.default_rng(self.seed + 1)
        return _distances(prints, _pack(rng.integers(0, 2, (PIVOTS, self.width)))).astype(np.int16)

    def links(self, cell: np.ndarray, prints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of rows within the radius, rows being sorted by cell.

        Pairs that earlier pairs of the batch join already are skipped, so at
        most one link is given for each row."""
        where, label = self.coordinates(prints), np.arange(len(prints))
        for lag in range(1, len(prints)):
            one = np.flatnonzero(cell[lag:] == cell[:-lag])
            if not len(one):
                return
            one = one[label[one] != label[one + lag]]
            near = np.abs(where[one] - where[one + lag]).max(axis=1, initial=0) <= self.radius
            one = one[near]
            apart = np.bitwise_count(prints[one] ^ prints[one + lag]).sum(axis=1) <= self.radius
            one = one[apart]
            new = []
            for i in one.tolist():
                a, b = label[i], label[i + lag]
                if a != b:
                    new.append(i)
                    first = np.searchsorted(cell, cell[i], "left")
                    last = np.searchsorted(cell, cell[i], "right")
                    part = label[first:last]
                    part[part == max(a, b)] = min(a, b)
            if new:
                yield np.array(new), np.array(new) + lag


def _pack(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits.astype(np.uint8), axis=1).view(">u8").astype(np.uint64)


def _distances(prints: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    out = np.zeros((len(prints), len(pivots)), np.uint64)
    for word in range(prints.shape[1]):
        out += np.bitwise_count(prints[:, word, None] ^ pivots[None, :, word])
    return out


def near_links(prints: DataFrame, tables: PivotTables) -> DataFrame:
    """(a, b): links of different fingerprints within the radius. Those that
    the links join are all those that chains of pairs within it would join."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 2000) for i in range(0, batch.num_rows, 2000)):
                held = part.column("fp").to_pylist()
                cells = tables.cells(as_words(held))
                n = len(tables.masks)
                fps = pa.array([x for x in held for _ in range(n)], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(cells.ravel()), pa.array(np.tile(np.arange(n, dtype=np.int32), len(held))), fps], ["cell", "tab", "fp"])

    def deal_again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps, tabs = batch.column("fp").to_pylist(), batch.column("tab").to_numpy()
            for tab in np.unique(tabs):
                held = [fps[i] for i in np.flatnonzero(tabs == tab)]
                finer = tables.refined(int(tab))
                cells, n = finer.cells(as_words(held)), len(finer.masks)
                again = pa.array([x for x in held for _ in range(n)], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(cells.ravel()), pa.array(np.full(len(again), tab, np.int32)), again], ["cell", "tab", "fp"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[tuple] = []
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                rest += zip(*(batch.column(x).to_pylist() for x in ("cell", "lo", "hi", "fp")))
            # The last cell may go on in the next batch.
            end = len(rest)
            while batch is not None and end and rest[end - 1][:3] == rest[-1][:3]:
                end -= 1
            now, rest = rest[:end], rest[end:]
            if now:
                starts = [i == 0 or now[i][:3] != now[i - 1][:3] for i in range(len(now))]
                fps = [row[3] for row in now]
                for a, b in tables.links(np.cumsum(starts), as_words(fps)):
                    pairs = [[fps[i] for i in a], [fps[i] for i in b]]
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in pairs], ["a", "b"])

    def within(members: DataFrame, sizes: DataFrame) -> DataFrame:
        blocks = F.ceil(F.col("n") / CELL).cast("int")
        own = F.pmod(F.xxhash64("fp"), blocks).cast("int")
        met = members.drop("tab").join(sizes.drop("tab"), "cell").select(
            "cell", "fp", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other")
        )
        keys = ["cell", "lo", "hi"]
        cut = met.select("cell", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "fp")
        return cut.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(compare, "a binary, b binary")

    def counted(members: DataFrame) -> DataFrame:
        # A cell is of one table, but for a meeting of hashes.
        sizes = members.groupBy("cell").agg(F.count("*").alias("n"), F.min("tab").alias("tab"), F.max("tab").alias("last"))
        return stored(sizes.filter("n > 1"), "cells")

    shape = "cell bigint, tab int, fp binary"
    dealt = prints.select("fp").mapInArrow(deal, shape)
    sizes = counted(dealt)
    hot = sizes.filter((F.col("n") > HOT_CELL) & (F.col("tab") == F.col("last")))
    if tables.radius > MOST_REFINED or hot.isEmpty():
        return within(dealt, sizes)
    cool = sizes.filter((F.col("n") <= HOT_CELL) | (F.col("tab") != F.col("last")))
    finer = dealt.join(hot.select("cell"), "cell", "left_semi").mapInArrow(deal_again, shape)
    return within(dealt, cool).unionAll(within(finer, counted(finer)))


# Groups


@dataclass(frozen=True)
class SimHash:
    """``radius`` in bits; ``recall`` None asks for all links."""

    shingle: int = 3
    width: int = 64
    radius: int = 2
    distinct: bool = False
    recall: float | None = None

    def tables(self, n_prints: int) -> PivotTables:
        masks = (
            exact_masks(self.width, self.radius)
            if self.recall is None
            else sampled_masks(self.width, self.radius, n_prints, self.recall)
        )
        return PivotTables(self.width, self.radius, masks)


# For similarities of words instead of bits: shingles of five. At a Jaccard similarity of 0.8 their sets have a cosine
# of 0.889, so that 39 of 256 bits are expected to differ, give or take 6; the
# radius leaves room for that.
FIVE_WORDS = SimHash(shingle=5, width=256, radius=45, distinct=True, recall=0.95)


def with_groups(rows: DataFrame, method: SimHash = SimHash()) -> DataFrame:
    """``rows``, which are stored and have a column fp, and their ``group``: a
    fingerprint that all rows have in common that links join."""
    prints = stored(rows.select("fp").distinct(), "distinct")
    tables = method.tables(prints.count())
    roots = stored(components(near_links(prints, tables)).withColumnRenamed("node", "fp"), "roots")
    return rows.join(roots, "fp", "left").withColumn("group", F.coalesce("root", "fp")).drop("root")


def prints_of(text: Column, method: SimHash) -> Column:
    return fingerprint_column(text, method.shingle, method.width, method.distinct)


def component_ids(docs: DataFrame, method: SimHash = SimHash()) -> DataFrame:
    """doc_id, fingerprint (hex digits) and component_id (the smallest doc_id
    that links reach, itself included), a row for each row of ``docs``.

    Null and empty texts have no words: their fingerprint is zero and links
    like any other. Null ids count for component_id only if all are null.
    Repeated rows stay. Other columns of ``docs`` are not read.
    """
    rows = stored(docs.select("doc_id", prints_of(F.col("text"), method).alias("fp")), "prints")
    rows = with_groups(rows, method)
    # Stored, so that both sides come from a shuffle and a hot group can be split.
    least = stored(rows.groupBy("group").agg(F.min("doc_id").alias("component_id")), "least")
    return rows.join(least, "group").select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, method: SimHash = SimHash()) -> DataFrame:
    """One row of each group that ``component_ids`` finds, with all its columns:
    that of the smallest doc_id (nulls last), of rows with equal ids any one. Texts without words (null
    ones too) are copies of each other."""
    rows = stored(
        docs.select(
            whole_row(docs).alias("row"),
            F.monotonically_increasing_id().alias("number"),
            prints_of(F.col("text"), method).alias("fp"),
        ),
        "prints",
    )
    place = F.struct(F.col("row.doc_id").isNull(), F.coalesce("row.doc_id", F.lit(0)), "number")
    first = with_groups(rows.select("number", "fp", place.alias("place")), method).groupBy("group").agg(
        F.min("place").alias("place")
    )
    return unpack(rows.join(first.select("place.number"), "number", "left_semi").select("row"))
