"""URL filters by a cascade of Bloom filters.

The first filter holds the listed keys. Of all keys that the corpus can ask
for, those that it lets through by mistake are held by the second; listed keys
that the second lets through by mistake by the third, and so on until none is
left. Over this universe of keys the answer is exact, and asking needs no join:
all filters together are a constant whose size follows from the listed keys.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltlake.llm.common import stored

# The most bits a filter may have: 8 MB.
MOST_BITS = 1 << 26
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The rules that pages are judged by, as (verdict, host and path).
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)


@dataclass(frozen=True)
class Level:
    """One Bloom filter: ``n_bits`` bits in words of 64."""

    n_bits: int
    hashes: int
    seed: int
    words: tuple[int, ...] = ()

    def positions(self, key: Column) -> list[Column]:
        first = F.pmod(F.xxhash64(F.lit(2 * self.seed), key), F.lit(self.n_bits))
        step = F.pmod(F.xxhash64(F.lit(2 * self.seed + 1), key), F.lit(self.n_bits))
        return [F.pmod(first + step * F.lit(i), F.lit(self.n_bits)) for i in range(self.hashes)]

    def passes(self, key: Column) -> Column:
        words = F.from_json(F.lit(json.dumps(self.words)), "array<bigint>")
        bits = [
            F.bit_get(F.get(words, F.floor(p / 64).cast("int")), (p % 64).cast("int"))
            for p in self.positions(key)
        ]
        return reduce(lambda a, b: a & b, [bit == 1 for bit in bits])

    def filled(self, keys: DataFrame) -> Level:
        """This level, holding all ``keys``. What the driver gets is bounded by
        ``n_bits``."""
        at = keys.select(F.explode(F.array(*self.positions(F.col("key")))).alias("p"))
        bit = F.expr("shiftleft(1L, cast(p % 64 AS int))")
        found = at.groupBy(F.floor(F.col("p") / 64).cast("int").alias("word")).agg(F.bit_or(bit).alias("bits")).collect()
        words = [0] * math.ceil(self.n_bits / 64)
        for word, bits in found:
            words[word] = bits
        return Level(self.n_bits, self.hashes, self.seed, tuple(words))


def sized_level(n_keys: int, rate: float, seed: int) -> Level:
    """An empty filter for ``n_keys`` keys that lets others through at ``rate``."""
    n_bits = max(64, math.ceil(-max(n_keys, 1) * math.log(rate) / math.log(2) ** 2))
    if n_bits > MOST_BITS:
        raise ValueError(f"a filter of {n_bits} bits is too large to be a constant; split the list")
    return Level(n_bits, max(1, round(-math.log2(rate))), seed)


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def holds(self, key: Column) -> Column:
        """Whether a key of the universe is listed; a null key is not."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for i in reversed(range(len(self.levels))):
            answer = F.when(self.levels[i].passes(key), answer).otherwise(F.lit(i % 2 == 1))
        return F.when(key.isNull(), F.lit(False)).otherwise(answer)


def build(listed: DataFrame, universe: DataFrame, first_rate: float | None = None) -> Cascade:
    """The cascade of the keys of ``listed`` over those of ``universe`` (both
    column key, repeats allowed, nulls ignored).

    The universe itself is not shuffled: only keys that pass the filters built
    so far are. By default the first filter lets through about 0.7 false keys
    for each listed one, the others every second, which makes the whole small.
    """
    listed = stored(listed.select("key").filter("key IS NOT NULL").distinct(), "listed")
    n_listed = listed.count()
    if not n_listed:
        return Cascade(())
    if first_rate is None:
        n_all = universe.agg(F.approx_count_distinct("key")).first()[0]
        first_rate = min(0.5, math.sqrt(0.5) * n_listed / max(n_all, 1))
    levels = [sized_level(n_listed, first_rate, 0).filled(listed)]
    inside, outside = listed, None
    while True:
        if len(levels) % 2:
            source = outside if outside is not None else universe.select("key").filter("key IS NOT NULL")
            wrong = source.filter(levels[-1].passes(F.col("key"))).distinct()
            wrong = wrong.join(listed, "key", "left_anti") if outside is None else wrong
            outside = wrong = stored(wrong, "wrong")
        else:
            inside = wrong = stored(inside.filter(levels[-1].passes(F.col("key"))), "wrong")
        n_wrong = wrong.count()
        if not n_wrong:
            return Cascade(tuple(levels))
        levels.append(sized_level(n_wrong, 0.5, len(levels)).filled(wrong))


# Pages


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def keys_of(host: Column, path: Column, labels: int, lengths: Sequence[int]) -> Column:
    """All keys that a rule of up to ``labels`` labels and a path of one of
    ``lengths`` could have to fit the url."""
    parts = F.split(host, r"\.", -1)
    n = F.size(parts)
    keys = [
        F.when(
            (n >= k) & (F.length(path) >= length),
            F.concat(F.substring_index(host, ".", -k), F.substring(path, 1, length)),
        )
        for k in range(1, labels + 1)
        for length in lengths
    ]
    return F.array_distinct(F.array_compact(F.array(*keys)))


def _candidate(verdict: str) -> Callable[[Column], Column]:
    return lambda key: F.struct(F.length(key).alias("n"), F.lit(verdict).alias("verdict"), key.alias("rule"))


def judged(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule (the longest that fits, or null) and verdict of
    each row of ``pages``.

    A url that is null or has no ``://`` has an empty host and path; no rule fits
    it. Pages that no rule fits get ``default``. A key listed both ways blocks.
    Repeated rows stay; other columns are not read.
    """
    spark = pages.sparkSession
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    labels = max((key.split("/")[0].count(".") + 1 for _, key in rules), default=1)
    lengths = sorted({len(key) - key.index("/") for _, key in rules})
    if not lengths:
        return rows.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    rows = stored(rows.withColumn("keys", keys_of(F.col("host"), F.col("path"), labels, lengths)), "keys")
    universe = rows.select(F.explode("keys").alias("key"))
    best = []
    for verdict in ("allow", "block"):
        listed = spark.createDataFrame([(key,) for kind, key in rules if kind == verdict], "key string")
        cascade = build(listed, universe)
        best.append(F.transform(F.filter("keys", cascade.holds), _candidate(verdict)))
    found = F.array_max(F.concat(*best))
    return rows.withColumn("found", found).select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce(F.col("found.verdict"), F.lit(default)).alias("verdict"),
    )
