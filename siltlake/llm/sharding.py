"""Sharding by fixed virtual slots.

A record's key decides its slot for good, whatever the number of shards. The rows
of a key that is heavier than a slot should be are spread over slots by their text
and place, so no key makes a shard heavy. Bytes are added up per slot; a map gives each slot a shard. The map is a small table
with a version: rebalancing writes a new version in which few slots have moved,
so only their records move.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltlake.llm.common import stored
from siltlake.session import scratch_path
from siltlake.tables.files import Files

# The number of slots is fixed for the life of a data set. All that the driver
# holds is a number for each of them.
SLOTS = 4096
SHARDS = 24


def virtual_slot(doc_id: Column, text_crc32: Column, slots: int = SLOTS) -> Column:
    """The slot of a record: by its id, without one by its text."""
    return F.pmod(F.when(doc_id.isNotNull(), F.xxhash64(doc_id)).otherwise(F.xxhash64(text_crc32)), F.lit(slots)).cast("int")


def assign(loads: Mapping[int, int], shards: int, slots: int = SLOTS) -> dict[int, int]:
    """A map for an empty data set: heaviest slot first, to the lightest shard."""
    heap = [(0, shard) for shard in range(shards)]
    out = {}
    for slot in sorted(range(slots), key=lambda s: (-loads.get(s, 0), s)):
        load, shard = heapq.heappop(heap)
        out[slot] = shard
        heapq.heappush(heap, (load + loads.get(slot, 0), shard))
    return out


def rebalance(current: Mapping[int, int], loads: Mapping[int, int], shards: int, slack: float = 0.01) -> dict[int, int]:
    """An edited map for ``shards`` shards. Slots leave shards that are gone, and
    shards above the mean by more than ``slack`` until they come nearest to it;
    all others stay."""
    mean = sum(loads.values()) / shards
    total = dict.fromkeys(range(shards), 0)
    for slot, shard in current.items():
        if shard < shards:
            total[shard] += loads.get(slot, 0)
    heavy = {shard for shard, load in total.items() if load > mean * (1 + slack)}
    out, moving = {}, []
    for slot in sorted(current, key=lambda s: (loads.get(s, 0), s)):
        shard, load = current[slot], loads.get(slot, 0)
        if shard >= shards:
            moving.append(slot)
        elif load and shard in heavy and total[shard] - load / 2 >= mean:
            moving.append(slot)
            total[shard] -= load
        else:
            out[slot] = shard
    heap = [(load, shard) for shard, load in total.items()]
    heapq.heapify(heap)
    for slot in sorted(moving, key=lambda s: (-loads.get(s, 0), s)):
        load, shard = heapq.heappop(heap)
        out[slot] = shard
        heapq.heappush(heap, (load + loads.get(slot, 0), shard))
    return out


def write_map(spark: SparkSession, path: str, version: int, slot_map: Mapping[int, int]) -> None:
    """Version ``version`` of the map below ``path``; versions are never edited."""
    rows = spark.createDataFrame(sorted(slot_map.items()), "slot int, shard int")
    rows.coalesce(1).write.mode("error").parquet(f"{path}/version={version}")


def read_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """(slot, shard) of a version, or of the newest."""
    maps = spark.read.schema("slot int, shard int, version int").parquet(path)
    if version is None:
        version = maps.agg(F.max("version")).first()[0]
    return maps.filter(F.col("version") == version).drop("version")


def records(docs: DataFrame) -> DataFrame:
    """doc_id, size (UTF-8 bytes of the text and 8), text_crc32 and vslot of each
    row, stored; null texts have no bytes."""
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    rows = docs.select("doc_id", (F.octet_length(text) + 8).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"))
    rows = rows.withColumn("vslot", virtual_slot(F.col("doc_id"), F.col("text_crc32")))
    return spread(stored(rows.withColumn("row", F.monotonically_increasing_id()), "records"))


def spread(rows: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``rows`` with those of heavy keys spread over slots. A heavy key has more
    bytes than a slot's share of all: there are fewer of them than slots."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), F.col("text_crc32").cast("string")))
    keyed = rows.withColumn("key", key)
    total = keyed.agg(F.sum("size")).first()[0] or 0
    heavy = keyed.groupBy("key").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).filter((F.col("bytes") * slots > total) & (F.col("n") > 1))
    marked = keyed.join(F.broadcast(heavy.select("key", F.lit(True).alias("heavy"))), "key", "left")
    own = F.pmod(F.xxhash64("key", "text_crc32", "row"), F.lit(slots)).cast("int")
    vslot = F.when(F.col("heavy"), own).otherwise(F.col("vslot"))
    return stored(marked.withColumn("vslot", vslot).drop("key", "heavy", "row"), "spread")


def slot_loads(rows: DataFrame) -> dict[int, tuple[int, int]]:
    """Rows and bytes of each slot: as many numbers as there are slots."""
    loads = rows.groupBy("vslot").agg(F.count("*"), F.sum("size")).collect()
    return {slot: (n, size) for slot, n, size in loads}


def sharded(docs: DataFrame, shards: int = SHARDS, map_path: str | None = None, grow: bool = False) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot (place in the shard, from 0),
    grown_shard (null: this law does not promise it) and next_shard of each row of
    ``docs``.

    The law is ``bytes``: sums of sizes by shard are near equal. Rows with equal
    ids share a slot unless they are more than a slot should hold; without an id
    the text decides. Places go by virtual slot, then id, text and size, so
    repeated rows have places of their own.

    The map below ``map_path`` (the scratch folder by default) is read if there is
    one, and edited for these rows as its next version; else version 0 is written.
    With ``grow`` a further version edits it for one more shard: ``next_shard`` is
    where the row lies then (else null), another shard for rows of moved slots only.
    """
    spark = docs.sparkSession
    rows = records(docs)
    loads = slot_loads(rows)
    sizes = {slot: size for slot, (_, size) in loads.items()}
    path = map_path or scratch_path(spark, "slot-map")
    version = -1
    if Files(spark).exists(path):
        version = max((int(name.split("=")[1]) for name in Files(spark).names(path) if name.startswith("version=")), default=-1)
    if version < 0:
        slot_map = assign(sizes, shards)
    else:
        slot_map = rebalance({r["slot"]: r["shard"] for r in read_map(spark, path, version).collect()}, sizes, shards)
    write_map(spark, path, version + 1, slot_map)
    grown: dict[int, int] = {}
    if grow:
        grown = rebalance(slot_map, sizes, shards + 1)
        write_map(spark, path, version + 2, grown)
    filled, first = dict.fromkeys(range(shards), 0), []
    for slot in range(SLOTS):
        first.append((slot, filled[slot_map[slot]], grown.get(slot)))
        filled[slot_map[slot]] += loads.get(slot, (0, 0))[0]
    places = read_map(spark, path, version + 1).join(spark.createDataFrame(first, "slot int, first bigint, next_shard int"), "slot")
    places = places.withColumnRenamed("slot", "vslot")
    within = Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size")
    numbered = rows.withColumn("place", F.row_number().over(within) - 1)
    return numbered.join(F.broadcast(places), "vslot").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("first") + F.col("place")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "next_shard",
    )
