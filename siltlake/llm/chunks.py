"""Substring dedup by content-defined chunks.

A gear hash rolls over the bytes of a text. Where it falls below a threshold
before a word, there is a cut, so the cuts of a passage depend on the passage
alone: text inserted before it shifts them but doesn't change them. A chunk goes
from a cut to the first cut that is some words later, so its length varies and
chunks overlap; both its ends are set by content. Chunks that several documents
hold are found by digest. Those that lie alike in two documents and touch are
united, and the texts of both compared outward from there, word by word. What they
share is a passage, which is removed from all documents but the first.

Words are separated by white space. Scripts that have none count each character as
a word (U+3000 to U+9FFF, Thai), and a word ends behind ``;``, ``{`` and ``}``, so
that code without blanks has words too.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltlake.llm.common import stored, unpack, utf8, whole_row

SPACES = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
# Bytes that begin a character of three bytes which is a word, the
# byte that does so before some second bytes (Thai), and bytes that end a word.
WIDE = np.isin(np.arange(256), range(0xE3, 0xEA))
THAI, THAI_SECOND = 0xE0, np.isin(np.arange(256), [0xB8, 0xB9])
STOPS = np.isin(np.arange(256), list(b";{}"))
# Fixed value: documents without an id are one document, the last.
NO_ID = 2**63 - 1


@dataclass(frozen=True)
class Chunking:
    """There is a cut before one word in ``words`` on average, and after
    ``most_bytes`` at the latest. The hash sees ``window`` bytes. A chunk ends at
    the first cut ``run_words`` words behind its start or later. A passage is found
    if a chunk lies in it: of 51 words, if the words before its first cut and those
    from the thirteenth behind that to the next are not more than 38 (all but about
    1 in 4,000); shorter ones are missed more often. Texts are compared over
    ``reach`` words outward from the chunks."""

    words: int = 4
    most_bytes: int = 1024
    window: int = 16
    run_words: int = 13
    reach: int = 48
    seed: int = 5


def gear(data: np.ndarray, chunking: Chunking) -> np.ndarray:
    """The gear hash behind each byte, over the last ``window`` bytes: each byte
    adds its random number, and what was there moves up by two bits."""
    numbers = np.random.default_rng(chunking.seed).integers(0, 2**32, 256, dtype=np.uint32)
    out, span = numbers[data], 1
    while span < chunking.window:
        shifted = out[:-span] << np.uint32(2 * span)
        out[span:] += shifted
        span *= 2
    return out


def cuts(data: bytes, chunking: Chunking, begins: np.ndarray | None = None) -> np.ndarray:
    """Where cuts are: before words but the first, and at the end."""
    raw = np.frombuffer(data, np.uint8)
    if not len(raw):
        return np.zeros(0, np.int64)
    word_starts = words_at(data)[0] if begins is None else begins
    word_starts = word_starts[word_starts > 0]
    found = gear(raw, chunking)[word_starts - 1]
    ends = word_starts[found < np.uint32(2**32 // chunking.words)]
    ends = np.append(ends, len(raw))
    wide = np.flatnonzero(np.diff(ends, prepend=0) > chunking.most_bytes)
    if not len(wide):
        return ends
    # Long stretches without a cut end at the first words past each full length.
    more = []
    for i in wide.tolist():
        at, end = int(ends[i - 1]) if i else 0, int(ends[i])
        while end - at > chunking.most_bytes:
            j = np.searchsorted(word_starts, at + chunking.most_bytes)
            if j == len(word_starts) or word_starts[j] >= end:
                break
            at = int(word_starts[j])
            more.append(at)
    return np.union1d(ends, np.array(more, np.int64))


def anchor_rows(docs: DataFrame, chunking: Chunking, places: bool) -> DataFrame:
    """(digest, id) of all chunks, with places also (part, start, stop).

    The digest is 64 bits wide."""
    schema = "digest bigint, id bigint" + (", part bigint, start bigint, stop bigint" if places else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in (batch.slice(i, 250) for i in range(0, batch.num_rows, 250)):
                digests, held = [], [np.zeros((0, 4), np.int64)]
                for doc_id, part, data in zip(*(rows.column(x).to_pylist() for x in ("id", "part")), utf8(rows.column("text"))):
                    start, stop = anchors(data or b"", chunking)
                    digests += [xxhash.xxh64_intdigest(data[a:b]) for a, b in zip(start.tolist(), stop.tolist())]
                    fixed = np.empty((len(start), 2), np.int64)
                    fixed[:] = doc_id, part
                    held.append(np.column_stack([fixed, start, stop]))
                fixed = np.concatenate(held)
                columns = [pa.array(np.array(digests, np.uint64).view(np.int64)), pa.array(fixed[:, 0])]
                if places:
                    columns += [pa.array(fixed[:, i]) for i in (1, 2, 3)]
                yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in schema.split(", ")])

    return docs.mapInArrow(cut, schema)


def words_at(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a text start and end. What a word is depends on its own
    bytes and the one before, so a part of a text has the same words."""
    raw = np.frombuffer(data, np.uint8)
    blank = np.concatenate([[True], SPACES[raw], [True]])
    begin, end = blank[:-1] & ~blank[1:], ~blank[:-1] & blank[1:]
    if data.isascii() and not any(stop in data for stop in (b";", b"{", b"}")):
        return np.flatnonzero(begin), np.flatnonzero(end)
    wide = WIDE[raw]
    wide[:-1] |= (raw[:-1] == THAI) & THAI_SECOND[raw[1:]]
    split = np.zeros(len(raw) + 1, bool)
    split[:-1] = wide
    split[3:] |= wide[: max(0, len(raw) - 2)]
    split[1:] |= STOPS[raw]
    if split.any():
        inside = ~blank[:-1] & ~blank[1:]
        begin, end = begin | (split & inside), end | (split & inside)
    return np.flatnonzero(begin), np.flatnonzero(end)


def words_in(data: bytes) -> list[bytes]:
    return [data[a:b] for a, b in zip(*(x.tolist() for x in words_at(data)))]


def anchors(data: bytes, chunking: Chunking) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the chunks of a text."""
    begins, ends = words_at(data)
    if len(begins) < chunking.run_words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    places = np.union1d([0], np.searchsorted(begins, cuts(data, chunking, begins)))  # the last one is behind all words
    last = np.searchsorted(places, places + chunking.run_words)
    first = places[last < len(places)]
    return begins[first], ends[places[last[: len(first)]] - 1]


def _margins(docs: DataFrame, edges: DataFrame, chunking: Chunking) -> DataFrame:
    """(id, part, at, after, margin) for ``edges``, which has arrays of (at, after)
    for each id and part: the words that follow or precede a place of a text."""
    schema = "id bigint, part bigint, at bigint, after boolean, margin binary"

    def margins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in (batch.slice(i, 250) for i in range(0, batch.num_rows, 250)):
                out = []
                for doc_id, part, data, places in zip(
                    *(rows.column(x).to_pylist() for x in ("id", "part")), utf8(rows.column("text")), rows.column("edges").to_pylist()
                ):
                    begins, ends = words_at(data)
                    for at, after in ((x["at"], x["after"]) for x in places):
                        i = int(np.searchsorted(begins, at))
                        last = min(i + chunking.reach, len(begins)) - 1
                        low, high = (at, int(ends[last]) if last >= i else at) if after else (int(begins[max(0, i - chunking.reach)]), at)
                        out.append({"id": doc_id, "part": part, "at": at, "after": after, "margin": data[low:high]})
                yield pa.RecordBatch.from_pylist(out, pa.schema(list(MARGINS.items())))

    return docs.join(edges, ["id", "part"]).mapInArrow(margins, schema).dropDuplicates(["id", "part", "at", "after"])


MARGINS = {"id": pa.int64(), "part": pa.int64(), "at": pa.int64(), "after": pa.bool_(), "margin": pa.binary()}
FOUND = ("id", "part", "start", "stop", "n_words", "n_chunks", "first_id")


def widened(data: bytes, spans: list[dict]) -> list[tuple[int, int, int, int, int]]:
    """(start, stop, n_words, n_chunks, first_id) of the passages of a text: its
    spans as far outward as the margins in the first documents agree, united if
    they touch and have the same first document. A passage takes the white space
    behind it along."""
    begins, ends = words_at(data)
    edges = [*begins.tolist(), len(data)]
    ends = ends.tolist()
    found = []
    for span in spans:
        i, j = np.searchsorted(begins, [span["start"], span["stop"]]).tolist()
        for word in reversed(words_in(span["before"])):
            if not i or data[edges[i - 1] : ends[i - 1]] != word:
                break
            i -= 1
        for word in words_in(span["behind"]):
            if j == len(ends) or data[edges[j] : ends[j]] != word:
                break
            j += 1
        found.append((span["first_id"], i, j, span["chunks"]))
    out: list[list[int]] = []
    for first_id, i, j, n in sorted(found):
        if out and out[-1][0] == first_id and i <= out[-1][2]:
            out[-1][2], out[-1][3] = max(out[-1][2], j), out[-1][3] + n
        else:
            out.append([first_id, i, j, n])
    return [(edges[i], edges[j], j - i, n, first_id) for first_id, i, j, n in out]


def passages(docs: DataFrame, chunking: Chunking = Chunking()) -> DataFrame:
    """(id, part, start, stop, n_words, n_chunks, first_id) of every passage that
    an earlier document holds too, in bytes of UTF-8.

    ``docs`` has id, part (a hash of the text) and text. ``first_id`` is the first
    document that holds a chunk of the passage; the whole passage stands in it,
    word for word. Passages of different documents may overlap. ``n_chunks``
    counts the chunks. What one document repeats, and no other has, is not shared.
    """
    digests = anchor_rows(docs, chunking, places=False)
    shared = stored(
        digests.groupBy("digest").agg(F.min("id").alias("first_id"), F.max("id").alias("last_id"))
        .filter("first_id < last_id").select("digest", "first_id"),
        "shared",
    )
    found = stored(anchor_rows(docs, chunking, places=True).join(shared, "digest"), "found")
    origin = found.filter("id = first_id").groupBy("digest").agg(F.min(F.struct("part", "start")).alias("o"))
    origin = stored(origin.select("digest", F.col("o.part").alias("first_part"), F.col("o.start").alias("first_start")), "origin")
    placed = found.filter("first_id < id").join(origin, "digest").withColumn("shift", F.col("start") - F.col("first_start"))
    along = ["id", "part", "first_id", "first_part", "shift"]
    own = Window.partitionBy(*along).orderBy("start")
    # Repeated rows give each chunk again.
    rows = placed.withColumn("again", F.lag("start").over(own)).filter("again IS NULL OR again <> start")
    begins = F.coalesce(F.col("start") > F.lag("stop").over(own), F.lit(True)).cast("int")
    runs = rows.withColumn("begins", begins)
    runs = runs.withColumn("run", F.sum("begins").over(own.rowsBetween(Window.unboundedPreceding, 0)))
    spans = runs.groupBy(*along, "run").agg(F.min("start").alias("start"), F.max("stop").alias("stop"), F.count("*").alias("chunks"))
    low, high = F.col("start") - F.col("shift"), F.col("stop") - F.col("shift")
    spans = stored(spans.withColumn("low", low).withColumn("high", high).drop("shift", "run"), "spans")

    edge = lambda at, after: F.struct(F.col(at).alias("at"), F.lit(after).alias("after"))
    edges = spans.select(
        F.col("first_id").alias("id"), F.col("first_part").alias("part"), F.explode(F.array(edge("low", False), edge("high", True))).alias("edge")
    )
    edges = stored(edges.groupBy("id", "part").agg(F.collect_set("edge").alias("edges")), "edges")
    margins = stored(_margins(docs, edges, chunking), "margins")

    def with_margin(spans: DataFrame, at: str, after: bool, name: str) -> DataFrame:
        side = margins.filter(F.col("after") == after)
        side = side.select(F.col("id").alias("first_id"), F.col("part").alias("first_part"), F.col("at").alias(at), F.col("margin").alias(name))
        return spans.join(side, ["first_id", "first_part", at])

    spans = stored(with_margin(spans, "low", False, "before"), "before")
    spans = stored(with_margin(spans, "high", True, "behind"), "behind")
    spans = spans.groupBy("id", "part").agg(F.collect_list(F.struct("start", "stop", "chunks", "first_id", "before", "behind")).alias("spans"))

    def widen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in (batch.slice(i, 250) for i in range(0, batch.num_rows, 250)):
                out = []
                for doc_id, part, data, held in zip(
                    *(rows.column(x).to_pylist() for x in ("id", "part")), utf8(rows.column("text")), rows.column("spans").to_pylist()
                ):
                    out += [(doc_id, part, *x) for x in widened(data, held)]
                columns = np.array(out, np.int64).reshape(-1, len(FOUND))
                yield pa.RecordBatch.from_arrays([pa.array(columns[:, i]) for i in range(len(FOUND))], list(FOUND))

    return docs.join(spans, ["id", "part"]).mapInArrow(widen, ", ".join(f"{x} bigint" for x in FOUND)).distinct()


def _numbered(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.xxhash64("text").alias("part"), "text")


def shared_passages(docs: DataFrame, chunking: Chunking = Chunking()) -> DataFrame:
    """doc_id, first_doc_id, start, stop (bytes), n_words and n_chunks of each
    passage of a document that an earlier one, first_doc_id, holds too.

    Null and empty texts have none. Rows with equal ids, or without an id, are
    one document: they share nothing with each other, and equal ones are given
    once. Rows without an id come last. Other columns are not read.
    """
    found = passages(_numbered(docs), chunking)
    null = lambda name: F.when(F.col(name) != NO_ID, F.col(name))
    return found.select(
        null("id").alias("doc_id"), null("first_id").alias("first_doc_id"), "start", "stop", "n_words", "n_chunks"
    )


def without_passages(docs: DataFrame, chunking: Chunking = Chunking()) -> DataFrame:
    """``docs`` without the passages that an earlier document holds; all rows and
    columns stay, n_chars (if there is such a column) counts what is left."""
    spans = passages(_numbered(docs), chunking)
    spans = spans.groupBy("id", "part").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("spans"))
    rows = docs.select(
        whole_row(docs).alias("row"), F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.xxhash64("text").alias("part")
    )

    @F.arrow_udf("string")
    def cut_out(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for data, parts in zip(utf8(texts), spans.to_pylist()):
            if data is not None and parts:
                left, at = [], 0
                for part in parts:
                    left.append(data[at : part["start"]])
                    at = max(at, part["stop"])
                data = b"".join([*left, data[at:]])
            out.append(None if data is None else data.decode())
        return pa.array(out, pa.string())

    both = rows.join(spans, ["id", "part"], "left")
    text = F.when(F.col("spans").isNull(), F.col("row.text")).otherwise(cut_out(F.col("row.text"), F.col("spans")))
    both = both.select("row", text.alias("text"))
    row = F.col("row").withField("text", F.col("text"))
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.length("text").cast("bigint"))
    return unpack(both.select(row.alias("row")))
