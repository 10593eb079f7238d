"""Document fingerprints: SimHash by weighted terms, and a search by blocks.

Each term (two neighbouring words) votes with its weight, 1 + ln(times it
occurs), for or against every bit. All fingerprints within a Hamming radius are
found in permuted block tables: the bits are cut into blocks, and there is a
table for each choice of blocks that may hold all the differing bits. Its key
is the other blocks, moved to the front; fingerprints within the radius are
equal there in one table at least.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltlake.llm.common import stored, utf8, word_blocks

BITS = 64
TERM_WORDS = 2
# Fixed value: the seed of the term hashes.
SEED = 42
# Documents to a range of ids, and the most ranges; beyond, ranges grow.
RANGE_DOCS = 4096
MOST_RANGES = 65_536
# Bounds to a group, when the range of an id is looked up.
GROUP = 256
# Documents without an id come first.
LEAST_ID = -(2**63)


def term_counts(data: bytes, size: int = TERM_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the different terms and how often each occurs. A text of fewer
    words is one term; without words there is none."""
    hashes, counts, carry, digest = [], [], [], xxhash.xxh64_intdigest
    for block in word_blocks(data):
        words = carry + block
        joined = map(b" ".join, zip(*(words[i:] for i in range(size))))
        found = np.fromiter((digest(x, SEED) for x in joined), np.uint64)
        if len(found):
            values, times = np.unique(found, return_counts=True)
            hashes.append(values)
            counts.append(times)
        carry = words[len(words) - size + 1 :] if len(words) >= size else words
    if not hashes:
        whole = [digest(b" ".join(carry), SEED)] if carry else []
        return np.array(whole, np.uint64), np.ones(len(whole), np.int64)
    if len(hashes) == 1:
        return hashes[0], counts[0]
    values, where = np.unique(np.concatenate(hashes), return_inverse=True)
    return values, np.bincount(where, weights=np.concatenate(counts)).astype(np.int64)


def simhash(data: bytes | None) -> int:
    """The fingerprint; 0 for a text without words."""
    hashes, counts = term_counts(data or b"")
    if not len(hashes):
        return 0
    weights = (1 + np.log(counts)).astype(np.float32)
    votes = np.zeros(BITS, np.float64)
    for start in range(0, len(hashes), 4096):
        bits = np.unpackbits(hashes[start : start + 4096].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        votes += weights[start : start + 4096] @ bits.astype(np.float32)
    return int.from_bytes(np.packbits(2 * votes > weights.sum(dtype=np.float64)).tobytes(), "big")


def likeness(a: int, b: int) -> float:
    """Share of equal bits."""
    return 1 - (a ^ b).bit_count() / BITS


def edited(text: str, after: str) -> str:
    """The last quarter of the code points replaced by the first as many of
    ``after``."""
    cut = len(text) // 4
    return text[: len(text) - cut] + after[:cut]


# Documents in the order of their ids


def _bounds(ids: DataFrame) -> list[int]:
    """Least ids of all ranges but the first."""
    parts = min(MOST_RANGES, math.ceil(ids.count() / RANGE_DOCS))
    if parts < 2:
        return []
    steps = [i / parts for i in range(1, parts)]
    return sorted(set(ids.agg(F.percentile_approx("id", steps, 10 * parts)).first()[0]))


def _range_of(key: Column, bounds: list[int]) -> Column:
    """How many of ``bounds`` are not above the key, looked up in two steps."""
    if not bounds:
        return F.lit(0)
    groups = [bounds[i : i + GROUP] for i in range(0, len(bounds), GROUP)]
    firsts = F.from_json(F.lit(json.dumps([group[0] for group in groups[1:]])), "array<bigint>")
    group = F.size(F.filter(firsts, lambda x: x <= key))
    own = F.get(F.from_json(F.lit(json.dumps(groups)), "array<array<bigint>>"), group)
    return group * GROUP + F.size(F.filter(own, lambda x: x <= key))


def with_next(docs: DataFrame) -> DataFrame:
    """(range, id, doc_id, text, guest) in order within ranges of ids, each followed
    by the first row of the next range as a guest; the last one by the first.

    The ranges are cut by counted ids, so texts are shuffled once, and a task
    streams through its ranges. Nulls come first, equal ids in order of text;
    null texts are empty.
    """
    ids = docs.select(F.coalesce("doc_id", F.lit(LEAST_ID)).alias("id"))
    place = _range_of(F.col("id"), _bounds(ids))
    # One id for each range: at most MOST_RANGES.
    firsts = sorted(tuple(row) for row in ids.groupBy(place.alias("range")).agg(F.min("id")).collect())
    rows = docs.select(
        F.coalesce("doc_id", F.lit(LEAST_ID)).alias("id"), "doc_id", F.coalesce("text", F.lit("")).alias("text")
    )
    before = [(firsts[i - 1][0], first) for i, (_, first) in enumerate(firsts)]
    guests = (
        rows.join(F.broadcast(docs.sparkSession.createDataFrame(before, "range int, id bigint")), "id")
        .groupBy("range", "id", "doc_id")
        .agg(F.min("text").alias("text"))
        .withColumn("guest", F.lit(True))
    )
    both = rows.withColumn("range", place).withColumn("guest", F.lit(False)).unionByName(guests)
    width = max(len(firsts), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return both.repartition(width, "range").sortWithinPartitions("range", "guest", "id", "text")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint (hex),
    near_edited and near_next of each row of ``docs``.

    Null texts are empty; an empty text has fingerprint zero, equals its edited
    text, and stays empty. The only document follows itself. Equal ids follow
    each other in order of text. Other columns are not read.
    """
    schema = (
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # range, id, text and fingerprint of the row that waits for the next one
        for batch in batches:
            out = []
            columns = (batch.column(x) for x in ("range", "doc_id", "text", "guest"))
            for part, doc_id, text, guest in zip(*(x.to_pylist() for x in columns)):
                own = simhash(text.encode())
                if last is not None and last[0] == part:
                    out.append(_row(*last[1:], text, own))
                last = None if guest else (part, doc_id, text, own)
            if out:
                yield pa.RecordBatch.from_pylist(out, _arrow(schema))

    return with_next(docs).mapInArrow(compute, schema)


def _row(doc_id: int | None, text: str, own: int, after: str, next_print: int) -> dict:
    changed = edited(text, after)
    data = changed.encode()
    other = simhash(data)
    return {
        "doc_id": doc_id,
        "n_chars": len(text),
        "edited_sha256": hashlib.sha256(data).hexdigest(),
        "fingerprint": f"{own:016x}",
        "edited_fingerprint": f"{other:016x}",
        "near_edited": likeness(own, other),
        "near_next": likeness(own, next_print),
    }


def _arrow(schema: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "string": pa.string(), "double": pa.float64()}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in schema.split(", "))])


# Search


def block_masks(radius: int, blocks: int) -> list[int]:
    """Bits that a table compares, for each choice of ``radius`` other blocks."""
    parts = [sum(1 << int(i) for i in part) for part in np.array_split(np.arange(BITS), blocks)]
    return [sum(kept) for kept in itertools.combinations(parts, blocks - radius)]


def search(queries: DataFrame, prints: DataFrame, radius: int = 3, blocks: int = 5) -> DataFrame:
    """(query, fp, distance): every different value of ``prints`` (column fp,
    bigint) within the radius of each different value of ``queries``, which is
    the small side. A pair is found once, in the first table in which it meets.
    """
    masks = [mask - (1 << BITS) if mask >> (BITS - 1) else mask for mask in block_masks(radius, blocks)]

    def dealt(df: DataFrame, name: str) -> DataFrame:
        keys = [F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m).cast("bigint")).alias("k")) for i, m in enumerate(masks)]
        return df.select("fp").distinct().select(F.col("fp").alias(name), F.explode(F.array(*keys)).alias("key"))

    apart = F.col("query").bitwiseXOR(F.col("fp"))
    earlier = [(F.lit(i) < F.col("key.t")) & (apart.bitwiseAND(F.lit(m).cast("bigint")) == 0) for i, m in enumerate(masks)]
    met = dealt(queries, "query").join(dealt(prints, "fp"), "key")
    near = met.filter(F.bit_count(apart) <= radius)
    for other in earlier:
        near = near.filter(~other)
    return near.select("query", "fp", F.bit_count(apart).alias("distance"))


def with_found(docs: DataFrame, query: str, radius: int = 3) -> DataFrame:
    """``fingerprints`` and n_found: for rows that ``query`` (a condition on
    doc_id) chooses, how many rows of ``docs`` have a fingerprint within the
    radius, itself included; null for the others."""
    rows = stored(fingerprints(docs), "fingerprints")
    number = F.conv(F.col("fingerprint"), 16, -10).cast("bigint")
    rows = rows.withColumn("fp", number)
    counts = rows.groupBy("fp").agg(F.count("*").alias("n"))
    chosen = rows.filter(query)
    hits = search(chosen, rows).join(counts, "fp").groupBy("query").agg(F.sum("n").alias("n_found"))
    found = rows.join(hits, rows["fp"] == hits["query"], "left")
    return found.withColumn("n_found", F.when(F.expr(query), F.col("n_found"))).drop("fp", "query")
