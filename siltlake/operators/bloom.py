"""Bloom filters as tables: a row holds the words of bits of one slot.

A key sets eight bits of its slot, two in each of four words. A filter is built by
an aggregate, which combines on the map side, and is asked by a join on the slot,
so neither has to fit into one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIGEST = "_digest"
WORDS = ("w0", "w1", "w2", "w3")
# Keys to a slot of 256 bits at most, on average: one stranger in some 700 is answered yes.
KEYS_PER_SLOT = 16
# No filter has fewer slots than 2 to this power, so that strangers spread over them.
LEAST_LEVEL = 10


def level(keys: int) -> int:
    """The power of two that a filter for so many keys has slots."""
    return max(LEAST_LEVEL, math.ceil(math.log2(max(keys, 1) / KEYS_PER_SLOT)))


def hashed(digests: DataFrame) -> DataFrame:
    """The rows with two hashes of their digest: one for slots, one for bits."""
    return digests.withColumns({"_h": F.xxhash64(DIGEST), "_g": F.xxhash64(F.lit(1), DIGEST)})


def slot(level: Column) -> Column:
    return F.expr("_h").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), level.cast("int")) - 1)


def masks() -> list[Column]:
    """The bits of a key in each word."""

    def bit(n: int) -> Column:
        place = F.shiftrightunsigned("_g", 6 * n).bitwiseAND(63).cast("int")
        return F.call_function("shiftleft", F.lit(1).cast("bigint"), place)

    return [bit(2 * i).bitwiseOR(bit(2 * i + 1)) for i in range(len(WORDS))]


def build(digests: DataFrame, level: int) -> DataFrame:
    """The filter of ``digests``: slot and words."""
    bits = hashed(digests).select(slot(F.lit(level)).alias("slot"), *[m.alias(w) for m, w in zip(masks(), WORDS)])
    return bits.groupBy("slot").agg(*[F.bit_or(w).alias(w) for w in WORDS])


def ask(digests: DataFrame, filters: DataFrame, levels: list[int]) -> DataFrame:
    """Rows of ``digests`` with the columns of every filter that answers yes. The
    filters have their level in a column; a row is sent once to each level."""
    asked = hashed(digests).withColumn("level", F.explode(F.array(*map(F.lit, levels))))
    asked = asked.withColumn("slot", slot(F.col("level")))
    asked = asked.withColumns({f"_{w}": m for m, w in zip(masks(), WORDS)})
    joined = asked.join(filters, ["level", "slot"])
    for w in WORDS:
        joined = joined.filter(F.col(w).bitwiseAND(F.col(f"_{w}")) == F.col(f"_{w}"))
    return joined.drop(*WORDS, *[f"_{w}" for w in WORDS])
