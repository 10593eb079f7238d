"""Phrases that occur together, mined with weighted acyclic automata.

Each task counts the phrases of its shard of texts, sorts them and builds a count
transducer for each range of phrases (``transducer.py``). The automata of a range
meet in one task, which unites them and sums their weights; phrases that are
frequent enough stay. A candidate is judged by the counts of its parts, whose
first words may lie in any range: the parts asked for are automata themselves,
one for each range, and are composed with the counts there.

Ranges are cut between sampled phrases, so a frequent first word, or a frequent
pair, is spread over ranges like any other; equal phrases are counted in a shard
before they move.
"""

from __future__ import annotations

import bisect
import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltlake.llm.common import stored
from siltlake.llm.transducer import CountTransducer, in_order, union

# Only A-Z have a lower case; these characters end a piece.
_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else 10 if c in _ENDS else 32 if c == 9 else c for c in range(256))

# Bytes of a text cut into words at once, words counted together, different words
# among them, and phrases (before they are united) to a range.
SLICE, BLOCK, DIFFERENT, RANGE = 1 << 20, 1 << 21, 1_500_000, 3_000_000
# Ranges at most, and how the sample that cuts them is drawn: bytes of text, in
# windows of so many characters, and phrases kept for each range.
MOST_RANGES, SAMPLE_BYTES, WINDOW, PER_RANGE = 65_536, 1 << 25, 4096, 32

# Parts that the phrases of a language are put in order in.
PARTS = 64


@dataclass(frozen=True)
class Mining:
    """Candidates are phrases of 2 to ``longest`` words found ``least`` times. A
    candidate inside a longer one goes if that has ``covered`` percent of its count."""

    longest: int = 3
    least: int = 10
    covered: int = 50
    top: int = 2000
    unknown: str = "und"


class _Words(dict):
    """Numbers words as they come; -1 is nothing, 0 the end of a piece."""

    def __init__(self):
        super().__init__({b"": -1, b"\n": 0})

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self) - 1
        return number


def slices(text: str) -> Iterator[list[bytes]]:
    """The words of a text and the ends of its pieces, with empty words between."""
    data = text.encode().translate(_PLAIN)
    start = 0
    while start < len(data):
        gap = data.find(b" ", start + SLICE) if len(data) - start > SLICE else -1
        end = gap if gap >= 0 else len(data)
        yield data[start:end].replace(b"\n", b" \n ").split(b" ")
        start = end


@dataclass
class _Shard:
    """Words of one language since phrases were last counted; the first ``told``
    of them were counted before and only begin phrases that go on."""

    words: _Words = field(default_factory=_Words)
    held: list[np.ndarray] = field(default_factory=list)
    n: int = 0
    told: int = 0

    def add(self, words: list[bytes]) -> None:
        ids = np.fromiter(map(self.words.__getitem__, words), np.int32, len(words))
        ids = ids[ids >= 0]
        self.held.append(ids)
        self.n += len(ids)

    def counted(self, longest: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """(words, phrases in order, counts), and starts anew."""
        names = list(self.words)[2:]
        order = sorted(range(len(names)), key=names.__getitem__)
        rank = np.zeros(len(names) + 1, np.int64)
        rank[np.array(order, np.int64) + 1] = np.arange(1, len(names) + 1)
        ids = rank[np.concatenate([np.zeros(0, np.int32), *self.held])]
        bits = len(names).bit_length()
        packed = bits * longest <= 63
        keys = []
        for length in range(1, longest + 1):
            n = len(ids) - length + 1
            if n <= 0:
                break
            ends = np.arange(length - 1, len(ids)) >= self.told
            for place in range(length):
                ends &= ids[place : place + n] > 0
            at = np.flatnonzero(ends)
            if packed:
                key = np.zeros(len(at), np.int64)
                for place in range(longest):
                    key = (key << bits) | (ids[at + place] if place < length else 0)
            else:
                key = np.column_stack([ids[at + place] if place < length else np.zeros(len(at), np.int64) for place in range(longest)])
            keys.append(key)
        names = [names[i] for i in order]
        tail = [names[i - 1] if i else b"\n" for i in ids[max(0, len(ids) - longest + 1) :].tolist()]
        self.words, self.held, self.n, self.told = _Words(), [], 0, 0
        self.add(tail)
        self.told = self.n
        if not keys or not sum(map(len, keys)):
            return [], np.zeros((0, longest), np.int64), np.zeros(0, np.int64)
        if packed:
            key = np.sort(np.concatenate(keys))
            heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            counts = np.diff(np.append(heads, len(key)))
            key, mask = key[heads], (1 << bits) - 1
            rows = np.column_stack([(key >> (bits * (longest - 1 - place))) & mask for place in range(longest)])
        else:
            every = np.concatenate(keys)
            order, heads = in_order(every, len(names))
            rows, counts = every[order[heads]], np.diff(np.append(heads, len(every)))
        return names, rows, counts


@dataclass(frozen=True)
class Ranges:
    """(language, phrase) that begin ranges 1, 2, ..., in order."""

    borders: list[tuple[bytes, tuple[bytes, ...]]]

    @property
    def n(self) -> int:
        return len(self.borders) + 1

    def cut(self, lang: bytes, words: list[bytes], rows: np.ndarray) -> Iterator[tuple[int, slice]]:
        """(range, place in ``rows``) of the phrases of one language, in order."""
        if not len(rows):
            return
        low = bisect.bisect_left(self.borders, (lang, ()))
        high = bisect.bisect_left(self.borders, (lang + b"\0", ()), low)
        places = [self._place(phrase, words, rows) for _, phrase in self.borders[low:high]]
        for k, (a, b) in enumerate(zip([0, *places], [*places, len(rows)])):
            if a < b:
                yield low + k, slice(a, b)

    @staticmethod
    def _place(phrase: tuple[bytes, ...], words: list[bytes], rows: np.ndarray) -> int:
        """The first row that is not before ``phrase``."""
        low, high = 0, len(rows)
        for column, word in enumerate(phrase[: rows.shape[1]]):
            number = bisect.bisect_left(words, word)
            known = number < len(words) and words[number] == word
            part = rows[low:high, column]
            low, high = low + int(np.searchsorted(part, number + 1, "left")), low + int(np.searchsorted(part, number + 1, "right"))
            if not known:
                return low
        return low if len(phrase) <= rows.shape[1] else high


BLOBS = pa.schema([("range", pa.int32()), ("lang", pa.binary()), ("blob", pa.binary())])
BLOB_ROWS = "range int, lang binary, blob binary"


def _table(columns: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, schema)], schema=schema)


def _texts(docs: DataFrame, method: Mining) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit(method.unknown)).cast("binary").alias("lang"), "text").filter("text IS NOT NULL")


# Counting


def plan(docs: DataFrame, method: Mining) -> Ranges:
    """Ranges for so much text, cut between phrases sampled from windows of all
    texts. They decide where phrases meet, not what is counted."""
    texts = _texts(docs, method)
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = min(MOST_RANGES, math.ceil(size / 6 * method.longest / RANGE))
    if n <= 1:
        return Ranges([])
    share = min(1.0, SAMPLE_BYTES / size)
    step = max(1, int(size * share / 6 / (n * PER_RANGE)))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, place = [], 0
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("part").to_pylist()):
                words = [word for some in slices(text) for word in some if word and word != b"\n"][1:-1]
                for at in range(step - 1 - place % step, len(words) - method.longest + 1, step):
                    found.append((lang, b" ".join(words[at : at + method.longest])))
                place += len(words)
            yield _table([list(x) for x in zip(*found)] or [[], []], pa.schema([("lang", pa.binary()), ("phrase", pa.binary())]))

    windows = F.sequence(F.lit(0), (F.char_length("text") / WINDOW).cast("int"))
    chosen = F.filter(windows, lambda i: F.pmod(F.xxhash64(i, F.substring("text", 1, 64), F.char_length("text")), F.lit(1_000_000)) < share * 1_000_000)
    parts = texts.select("lang", "text", F.explode(chosen).alias("i")).select(
        "lang", F.col("text").substr(F.col("i") * WINDOW + 1, F.lit(WINDOW)).alias("part")
    )
    sample = sorted((bytes(lang), tuple(bytes(phrase).split(b" "))) for lang, phrase in parts.mapInArrow(pick, "lang binary, phrase binary").collect())
    return Ranges(sorted({sample[len(sample) * k // n] for k in range(1, n)})) if sample else Ranges([])


def shards(docs: DataFrame, ranges: Ranges, method: Mining) -> DataFrame:
    """Count transducers of parts of the texts, cut by range."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, _Shard] = defaultdict(_Shard)

        def out() -> Iterator[pa.RecordBatch]:
            for lang, shard in held.items():
                if shard.n > shard.told:
                    words, rows, counts = shard.counted(method.longest)
                    for place, at in ranges.cut(lang, words, rows):
                        yield _table([[place], [lang], [CountTransducer.build(words, rows[at], counts[at]).dump()]], BLOBS)

        waiting = different = 0
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                shard = held[lang]
                for words in slices(text):
                    before = len(shard.words), shard.n
                    shard.add(words)
                    different, waiting = different + len(shard.words) - before[0], waiting + shard.n - before[1]
                    if waiting > BLOCK or different > DIFFERENT:
                        yield from out()
                        held = defaultdict(_Shard, {lang: shard})  # a text may go on
                        waiting = different = 0
                shard.add([b"\n"])
        yield from out()

    return _texts(docs, method).mapInArrow(count, BLOB_ROWS)


def _groups(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple[tuple, list[tuple]]]:
    """(range, lang) and the rows of each, as they come in order."""
    key, held = None, []
    for batch in batches:
        for row in zip(*(batch.column(x).to_pylist() for x in ("range", "lang", *names))):
            if row[:2] != key:
                if held:
                    yield key, held
                key, held = row[:2], []
            held.append(row[2:])
    if held:
        yield key, held


def counts(docs: DataFrame, ranges: Ranges, method: Mining) -> DataFrame:
    """range, lang, blob, n: for each range and language the automaton of the
    phrases found ``least`` times, and n, how many words begin there in all."""

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (place, lang), rows in _groups(batches, ("blob",)):
            words, phrases, summed = union([CountTransducer.load(blob) for (blob,) in rows])
            single = phrases[:, 1:].max(axis=1, initial=0) == 0
            total, kept = int(summed[single].sum()), summed >= method.least
            # Not only ``words`` that are left: building leaves the others out.
            blob = CountTransducer.build(words, phrases[kept], summed[kept]).dump() if kept.any() else None
            yield _table([[place], [lang], [blob], [total]], pa.schema([*BLOBS, ("n", pa.int64())]))

    met = shards(docs, ranges, method).repartitionById(ranges.n, F.col("range")).sortWithinPartitions("range", "lang")
    return met.mapInArrow(unite, BLOB_ROWS + ", n bigint")


# Parts


def phrases_of(counted: DataFrame) -> DataFrame:
    """lang, phrase (words joined by spaces), f of all phrases in the automata."""

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, blob in zip(batch.column("lang").to_pylist(), batch.column("blob").to_pylist()):
                held = CountTransducer.load(blob)
                for rows, n in held.phrases():
                    yield _spelt(lang, held.words, rows, n)

    return _as_text(counted.filter("blob IS NOT NULL").select("lang", "blob").mapInArrow(spell, "lang binary, phrase binary, f bigint"))


def _spelt(lang: bytes, words: list[bytes], rows: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    found = [b" ".join([words[i - 1] for i in row]) for row in rows.tolist()]
    return _table([[lang] * len(found), found, n], pa.schema([("lang", pa.binary()), ("phrase", pa.binary()), ("f", pa.int64())]))


def _as_text(df: DataFrame) -> DataFrame:
    return df.withColumns({"lang": F.col("lang").cast("string"), "phrase": F.col("phrase").cast("string")})


def parts(counted: DataFrame, ranges: Ranges) -> DataFrame:
    """lang, phrase, f of the parts before and behind each cut of each candidate:
    automata of the parts asked for are composed with those of the counts."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, blob in zip(batch.column("lang").to_pylist(), batch.column("blob").to_pylist()):
                held = CountTransducer.load(blob)
                found = []
                for rows, _ in held.phrases():
                    width = rows.shape[1]
                    found += [rows[:, :k] for k in range(1, width)] + [rows[:, k:] for k in range(1, width)]
                if not found:
                    continue
                longest = max(x.shape[1] for x in found)
                asked = np.concatenate([np.pad(x, ((0, 0), (0, longest - x.shape[1]))) for x in found])
                order, heads = in_order(asked, len(held.words))
                asked = asked[order[heads]]
                for place, at in ranges.cut(lang, held.words, asked):
                    rows = asked[at]
                    yield _table([[place], [lang], [CountTransducer.build(held.words, rows, np.ones(len(rows), np.int64)).dump()]], BLOBS)

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, lang), rows in _groups(batches, ("asks", "blob")):
            if rows[0][0]:
                continue  # nothing frequent is here
            own = CountTransducer.load(rows[0][1])
            words, sought, _ = union([CountTransducer.load(blob) for _, blob in rows[1:]])
            if len(sought):
                asked = CountTransducer.build(words, sought, np.ones(len(sought), np.int64))
                for found, n in own.compose(asked):
                    yield _spelt(lang, asked.words, found, n)

    own = counted.filter("blob IS NOT NULL").select("range", "lang", F.lit(False).alias("asks"), "blob")
    asked = own.select("range", "lang", "blob").mapInArrow(ask, BLOB_ROWS).select("range", "lang", F.lit(True).alias("asks"), "blob")
    met = own.unionAll(asked).repartitionById(ranges.n, F.col("range")).sortWithinPartitions("range", "lang", "asks")
    return _as_text(met.mapInArrow(compose, "lang binary, phrase binary, f bigint"))


# Phrases


def _joined(words: Column) -> Column:
    return F.array_join(words, " ")


def collocations(docs: DataFrame, method: Mining = Mining()) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``top`` phrases of each
    language of ``docs`` (text, lang).

    a, l and r are the counts of the phrase and of the parts of its weakest cut, n
    that of all words of the language. Null and empty texts have no words; a null
    language is ``unknown``. Repeated rows count each time; ties go to the larger
    count, then to the phrase that is first in UTF-8. Only text and lang are read.
    No candidates: no rows.
    """
    ranges = plan(docs, method)
    counted = stored(counts(docs, ranges, method), "counts")
    words = F.split("phrase", " ")
    found = stored(phrases_of(counted).withColumn("words", words).filter(F.size("words") > 1).withColumnRenamed("f", "a"), "candidates")

    # The parts of each cut, and the cut that scores least.
    size = F.size("words")
    cut = F.explode(F.sequence(F.lit(1), size - 1)).alias("k")
    cuts = found.select("lang", "phrase", "a", "words", cut).select(
        "lang", "phrase", "a", "k",
        _joined(F.slice("words", F.lit(1), F.col("k"))).alias("left"), _joined(F.slice("words", F.col("k") + 1, size - F.col("k"))).alias("right"),
    )
    known = stored(parts(counted, ranges), "parts")
    left = known.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = known.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    wide = lambda name: f"CAST({name} AS DECIMAL(15, 0))"
    score = F.expr(f"CAST(1000000 AS DECIMAL(7, 0)) * {wide('a')} * {wide('a')} DIV ({wide('l')} * {wide('r')})")
    weakest = (
        cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"])
        .groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    )

    # Candidates that a longer one covers.
    spans = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda n: F.transform(F.sequence(F.lit(1), size - n + 1), lambda i: _joined(F.slice("words", i, n)))))
    longer = found.filter(size > 2).select("lang", F.explode(spans).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    free = weakest.join(longer, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < method.covered * F.col("a"))
    )

    totals = counted.groupBy(F.col("lang").cast("string").alias("lang")).agg(F.sum("n").alias("n"))
    # The first of each part of a language hold the first of all.
    order = [F.desc("cut.score"), F.desc("a"), F.asc("phrase")]
    rank = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    parted = free.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    first = parted.withColumn("rank", rank("lang", "part")).filter(F.col("rank") <= method.top).drop("part", "rank")
    best = first.withColumn("rank", rank("lang")).filter(F.col("rank") <= method.top)
    return best.join(totals, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score")
    )
