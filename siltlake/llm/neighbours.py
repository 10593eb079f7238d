"""Nearest neighbours by multiprobe p-stable hashing.

Vectors are projected on Gaussian directions; each projection is cut into cells
of equal width, the outer ones open, and the cells of a table's projections make
its buckets. A Gaussian is 2-stable: a neighbour's projection differs from the
query's by a normal number of their distance. Given the query's projection, which
is known, it is normal about a line whose slope is about the cosine; line and
spread are fitted to neighbours in a sample. This gives the chance of each cell
and, as projections are independent, of each bucket. A query
visits buckets in the order of this estimated success, its own and perturbed ones,
until their sum passes what the table has to contribute. Candidates of all tables
are scored exactly and merged.

The largest inner product is the nearest vector once all vectors have one length,
so a vector gets a further entry that fills its length up to the largest, and a
query is stretched to it.

Equal vectors are one candidate with as many of their least ids as a result can
hold. Buckets are dealt out in order, so that close buckets lie in one part and a
query is sent once to each part that it visits; a bucket that is larger than a
part is split by a hash, and each of its parts is visited.
"""

from __future__ import annotations

import math
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltlake.llm.common import stored

CELLS = 4
# Projections of a table at most: their buckets are counted and planned on the driver.
MOST_PROJECTIONS = 8
# Queries that are planned, and scored, at once.
TOGETHER = 256


@dataclass(frozen=True)
class Search:
    """``k`` nearest; ``success`` is the chance with which the tables together
    should meet the k-th neighbour. About ``sample`` vectors, chosen
    by hash, tell how far that neighbour is and how wide cells are; all vectors
    are indexed."""

    k: int = 20
    tables: int = 2
    success: float = 0.95
    bucket_rows: int = 512
    part_rows: int = 8192
    sample: int = 4096
    seed: int = 5


ASKED = "part int, asks boolean, id bigint, ids array<bigint>, bucket int, visits binary, v binary"
DEALT = pa.schema(
    [("part", pa.int32()), ("asks", pa.bool_()), ("id", pa.int64()), ("ids", pa.list_(pa.int64())),
     ("bucket", pa.int32()), ("visits", pa.binary()), ("v", pa.binary())]
)
FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _table(columns: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, schema)], schema=schema)


def _matrix(held: pa.Array | list[bytes], kind: str) -> np.ndarray:
    held = held.to_pylist() if isinstance(held, pa.Array) else held
    return np.frombuffer(b"".join(held), kind).reshape(len(held), -1).astype(np.float64)


# What takes part


def usable(rows: DataFrame, size: int, kind: str, least: int | None) -> DataFrame:
    """vec_id and v (bytes) of the vectors of ``size`` entries, all finite, not all
    zero, of rows with an id. With ``least``, only so many least ids of each vector
    of a batch are given, each once."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column("vec_id"), batch.column("embedding")
            fits = np.array([n == size for n in lists.value_lengths().to_pylist()], bool) & ids.is_valid().to_numpy(zero_copy_only=False)
            lists, ids = lists.filter(pa.array(fits)), ids.filter(pa.array(fits)).to_numpy()
            entries = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(ids), size)  # nulls become NaN
            good = np.isfinite(entries).all(axis=1) & (entries != 0).any(axis=1)
            data, ids = np.ascontiguousarray(entries[good] + 0.0, kind), ids[good]
            vectors = [row.tobytes() for row in data]
            if least is not None:
                seen = defaultdict(set)
                for v, i in zip(vectors, ids.tolist()):
                    seen[v].add(i)
                pairs = [(i, v) for v, own in seen.items() for i in sorted(own)[:least]]
                ids, vectors = [i for i, _ in pairs], [v for _, v in pairs]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(vectors, pa.binary())], ["vec_id", "v"])

    return rows.select(F.col("vec_id").cast("bigint"), "embedding").mapInArrow(pick, "vec_id bigint, v binary")


def classes(rows: DataFrame, size: int, kind: str, most_ids: int) -> DataFrame:
    """Each different vector and its least ids, ``most_ids`` at most."""
    order = F.dense_rank().over(Window.partitionBy("v").orderBy("vec_id"))
    ranked = usable(rows, size, kind, most_ids).withColumn("place", order).filter(F.col("place") <= most_ids)
    return ranked.groupBy("v").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))


# The index


def _chance(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.frompyfunc(math.erf, 1, 1)(x / math.sqrt(2)).astype(np.float64))


def visits(cells: np.ndarray, target: float, beam: int = 64) -> list[np.ndarray]:
    """For each row of ``cells`` (row, projection, cell: chances) the buckets whose
    chances, largest first, sum up to ``target``.

    The best buckets over some projections extend the best ones over fewer, so a
    beam loses none of the first; it is widened where its sum falls short.
    """
    n, projections, width = cells.shape
    chance, code = np.ones((n, 1)), np.zeros((n, 1), np.int64)
    for j in range(projections):
        chance = (chance[:, :, None] * cells[:, j, None, :]).reshape(n, -1)
        code = (code[:, :, None] * width + np.arange(width)).reshape(n, -1)
        if chance.shape[1] > beam:
            best = np.argpartition(-chance, beam - 1, axis=1)[:, :beam]
            chance, code = np.take_along_axis(chance, best, 1), np.take_along_axis(code, best, 1)
    order = np.argsort(-chance, axis=1, kind="stable")
    chance, code = np.take_along_axis(chance, order, 1), np.take_along_axis(code, order, 1)
    total = np.cumsum(chance, axis=1)
    enough = (total < target).sum(axis=1) + 1
    out = [row[:m] for row, m in zip(code, enough)]
    short = np.flatnonzero(enough > code.shape[1])
    if len(short) and code.shape[1] < width**projections:
        step = max(1, (1 << 22) // min(beam * 4, width**projections))
        for part in np.array_split(short, -(-len(short) // step)):
            for i, row in zip(part, visits(cells[part], target, beam * 4)):
                out[i] = row
    return out


@dataclass(frozen=True)
class Index:
    """Directions, cell borders (table, projection, border), the largest squared
    length, and for each projection how a neighbour's follows from the query's:
    slope, shift and spread; ``first`` and ``n`` are the parts of buckets."""

    kind: str
    directions: np.ndarray
    borders: np.ndarray
    longest: float
    line: tuple[np.ndarray, np.ndarray, np.ndarray]
    target: float
    first: np.ndarray | None = None
    n: np.ndarray | None = None

    @property
    def parts(self) -> int:
        return int((self.first + self.n).max(initial=1))

    def projections(self, data: np.ndarray, filled: bool) -> np.ndarray:
        """(row, table, projection); ``filled`` for vectors, else queries."""
        squares = (data * data).sum(axis=1)
        if filled:
            more = np.sqrt(np.maximum(self.longest - squares, 0))[:, None]
        else:
            data, more = data * np.sqrt(self.longest / squares)[:, None], np.zeros((len(data), 1))
        return np.einsum("nd,tdp->ntp", np.hstack([data, more]), self.directions, optimize=True)

    def buckets(self, data: np.ndarray) -> np.ndarray:
        """(row, table)."""
        at = (self.projections(data, True)[..., None] > self.borders).sum(axis=3)
        return at @ (CELLS ** np.arange(at.shape[2])[::-1])

    def probes(self, data: np.ndarray) -> Iterator[tuple[int, list[np.ndarray]]]:
        """For each table the buckets that each query visits."""
        at = self.projections(data, False)
        slope, shift, spread = self.line
        edges = _chance((self.borders - (slope * at + shift)[..., None]) / spread[..., None])
        cells = np.diff(np.concatenate([np.zeros((*at.shape, 1)), edges, np.ones((*at.shape, 1))], axis=3), axis=3)
        for table in range(cells.shape[1]):
            yield table, visits(cells[:, table], self.target)


def plan(vectors: DataFrame, n: int, longest: float, size: int, kind: str, method: Search) -> Index:
    """Directions, borders and what is known of the k-th neighbour, from a sample."""
    share = min(1, method.sample / n)
    chosen = F.pmod(F.xxhash64("v"), F.lit(1 << 40)) <= int((1 << 40) * share)
    sample = sorted(bytes(r.v) for r in vectors.select("v").filter(chosen).collect())
    if not sample:  # very few vectors
        sample = [bytes(r.v) for r in vectors.select("v").limit(method.sample).collect()]
    data = _matrix(sample, kind)
    squares = (data * data).sum(axis=1)
    asking = data[:TOGETHER] * np.sqrt(longest / squares[:TOGETHER])[:, None]
    cosines = asking @ data.T / longest
    cosines[np.arange(len(asking)), np.arange(len(asking))] = -np.inf
    place = min(len(data) - 1, max(1, math.ceil(method.k * len(data) / n)))
    nearest_first = np.argsort(-cosines, axis=1)[:, :place]
    near = np.take_along_axis(cosines, nearest_first[:, -1:], 1) if place else np.zeros(1)
    cosine = float(np.clip(near, 0, 1).mean())
    rng = np.random.default_rng(method.seed)
    projections = min(MOST_PROJECTIONS, max(1, round(math.log(max(n / method.bucket_rows, 1), CELLS))))
    directions = rng.standard_normal((method.tables, size + 1, projections))
    shift = rng.uniform(-0.25, 0.25, (method.tables, projections, 1))
    spread = np.full(directions[:, 0].shape, math.sqrt(longest * max(1 - cosine**2, 1e-9)))
    line = (np.full(spread.shape, cosine), np.zeros(spread.shape), spread)
    target = 1 - (1 - method.success) ** (1 / method.tables)
    index = Index(kind, directions, np.zeros((1, 1, 1)), longest, line, target)
    at = index.projections(data, True)
    if place and len(asking) >= 30:
        # The farther half of the neighbours: nearer ones are met more often.
        far = nearest_first[:, place // 2 : place]
        x = np.repeat(index.projections(data[: len(asking)], False), far.shape[1], axis=0)
        line = _fit(x, at[far.ravel()], longest)
    width = np.maximum(0.7 * at.std(axis=0), 1e-9 * math.sqrt(longest))[..., None]
    borders = at.mean(axis=0)[..., None] + width * (np.arange(1 - CELLS // 2, CELLS // 2) + shift)
    return Index(kind, directions, borders, longest, line, target)


def _fit(x: np.ndarray, y: np.ndarray, longest: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slope, shift and spread of y about x, for each table and projection."""
    middle, height = x.mean(axis=0), y.mean(axis=0)
    slope = ((x - middle) * (y - height)).mean(axis=0) / np.maximum(((x - middle) ** 2).mean(axis=0), 1e-12 * longest)
    shift = height - slope * middle
    return slope, shift, np.maximum((y - slope * x - shift).std(axis=0), 1e-6 * math.sqrt(longest))


def deal_out(vectors: DataFrame, index: Index, part_rows: int) -> Index:
    """With parts: buckets are counted and put into parts of ``part_rows`` in
    order, larger ones into several. There are at most 4 ** 8 to a table."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at = index.buckets(_matrix(batch.column("v"), index.kind))
                table = np.broadcast_to(np.arange(at.shape[1]), at.shape)
                code, n = np.unique(table.ravel() * CELLS**MOST_PROJECTIONS + at.ravel(), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(n)], ["code", "n"])

    counts = vectors.select("v").mapInArrow(count, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n"))
    n_tables, _, projections = index.directions.shape
    rows = np.zeros((n_tables, CELLS**projections), np.int64)
    for code, n in counts.collect():
        rows[code // CELLS**MOST_PROJECTIONS, code % CELLS**MOST_PROJECTIONS] = n
    first, n_parts = np.zeros_like(rows), np.ones_like(rows)
    at, held = 0, 0
    for place in np.ndindex(rows.shape):
        if held and held + rows[place] > part_rows:
            at, held = at + 1, 0
        first[place] = at
        if rows[place] > part_rows:
            n_parts[place] = -(-rows[place] // part_rows)
            at += n_parts[place]
        else:
            held += rows[place]
    return Index(index.kind, index.directions, index.borders, index.longest, index.line, index.target, first, n_parts)


# The search


def candidates(vectors: DataFrame, queries: DataFrame, index: Index, k: int) -> DataFrame:
    """query_id, vec_id, score: the ``k`` best of each part that a query visits."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, ids = batch.column("v").to_pylist(), batch.column("ids").to_pylist()
            at = index.buckets(_matrix(held, index.kind)) if held else np.zeros((0, 0), np.int64)
            salt = np.fromiter(map(zlib.crc32, held), np.int64, len(held))
            n = len(held)
            for table in range(at.shape[1]):
                own = at[:, table]
                part = index.first[table, own] + salt % index.n[table, own]
                bucket = own + table * CELLS**MOST_PROJECTIONS
                yield _table([part, [False] * n, [None] * n, ids, bucket, [None] * n, held], DEALT)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, TOGETHER) for b in batches for i in range(0, b.num_rows, TOGETHER)):
            held, ids = batch.column("v").to_pylist(), batch.column("vec_id").to_pylist()
            for table, visited in index.probes(_matrix(held, index.kind)):
                rows = []
                for i, buckets in enumerate(visited):
                    code = (buckets + table * CELLS**MOST_PROJECTIONS).astype(np.int32)
                    first, n = index.first[table, buckets], index.n[table, buckets]
                    wide = np.flatnonzero(n > 1)
                    part = np.concatenate([first, *(np.arange(first[j] + 1, first[j] + n[j]) for j in wide)])
                    code = np.concatenate([code, *(np.full(n[j] - 1, code[j]) for j in wide)])
                    order = np.argsort(part, kind="stable")
                    part, code = part[order], code[order]
                    edges = np.flatnonzero(np.diff(part)) + 1
                    rows += [(int(p[0]), ids[i], c.astype(np.int32).tobytes(), held[i])
                             for p, c in zip(np.split(part, edges), np.split(code, edges))]
                part, own, code, v = zip(*rows)
                n = len(rows)
                yield _table([part, [True] * n, own, [None] * n, [None] * n, code, v], DEALT)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, part = None, [], None
        for batch in batches:
            parts = batch.column("part").to_numpy()
            asks = batch.column("asks").to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((np.diff(parts) != 0) | (np.diff(asks.astype(np.int8)) != 0)) + 1
            for a, b in zip([0, *edges], [*edges, batch.num_rows]):
                if a == b:
                    continue
                if now != parts[a]:
                    now, held, part = parts[a], [], None
                piece = batch.slice(a, b - a)
                if not asks[a]:
                    held.append(piece)
                elif held:
                    part = part or Part(held, index.kind)
                    for i in range(0, piece.num_rows, TOGETHER):
                        yield part.best(piece.slice(i, TOGETHER), k)

    dealt = vectors.mapInArrow(deal, ASKED).unionAll(queries.mapInArrow(send, ASKED))
    met = dealt.repartitionById(index.parts, F.col("part")).sortWithinPartitions("part", "asks")
    return met.mapInArrow(answer, "query_id bigint, vec_id bigint, score double")


class Part:
    """The vectors of a part, by bucket."""

    def __init__(self, pieces: list[pa.RecordBatch], kind: str):
        bucket = np.concatenate([p.column("bucket").to_numpy() for p in pieces])
        order = np.argsort(bucket, kind="stable")
        self.kind = kind
        self.buckets, starts = np.unique(bucket[order], return_index=True)
        self.starts = np.append(starts, len(order))
        self.data = np.concatenate([_matrix(p.column("v"), kind) for p in pieces])[order]
        ids = [x for p in pieces for x in p.column("ids").to_pylist()]
        self.ids = [ids[i] for i in order]

    def best(self, queries: pa.RecordBatch, k: int) -> pa.RecordBatch:
        asked, own = _matrix(queries.column("v"), self.kind), queries.column("id").to_pylist()
        codes = [np.frombuffer(x, np.int32) for x in queries.column("visits").to_pylist()]
        row = np.repeat(np.arange(len(own)), [len(x) for x in codes])
        code = np.concatenate(codes)
        at = np.minimum(np.searchsorted(self.buckets, code), len(self.buckets) - 1)
        row, at = row[self.buckets[at] == code], at[self.buckets[at] == code]
        scores = np.full((len(own), len(self.data)), -np.inf)
        order = np.argsort(at, kind="stable")
        met, first = np.unique(at[order], return_index=True)
        for bucket, rows in zip(met, np.split(row[order], first[1:])):
            span = slice(self.starts[bucket], self.starts[bucket + 1])
            scores[rows, span] = asked[rows] @ self.data[span].T
        # The query's own vector may be one of them; sums in another order may differ in the last digits.
        most = min(k + 1, scores.shape[1])
        least = np.partition(scores, scores.shape[1] - most, axis=1)[:, scores.shape[1] - most]
        slack = 1e-9 * (1 + np.abs(np.where(np.isfinite(least), least, 0)))
        i, j = np.nonzero((scores >= (least - slack)[:, None]) & np.isfinite(scores))
        exact = (asked[i] * self.data[j]).sum(axis=1)
        held = sorted((a, -s, x) for a, b, s in zip(i.tolist(), j.tolist(), exact.tolist()) for x in self.ids[b] if x != own[a])
        rows, n, before = [], 0, None
        for a, minus, x in held:
            n, before = (n + 1 if a == before else 1), a
            if n <= k:
                rows.append((own[a], x, -minus))
        return _table([list(x) for x in zip(*rows)] or [[], [], []], FOUND)


def nearest(rows: DataFrame, asks: str, method: Search = Search()) -> DataFrame:
    """query_id, rank, vec_id and score: for each id of ``rows`` (vec_id,
    embedding) that the condition ``asks`` chooses the ``method.k`` vectors found of
    largest inner product, nearest first, ties to the smaller id.

    Rows without an id or a vector take no part, nor vectors that are zero, hold
    null or non-finite entries, or have another number of entries than most (ties:
    the smaller number). Rows repeated wholly count once. Rows of one id are one
    query, which never finds its own id; of several vectors of one id the better
    score counts. Other columns are not read. No vectors: no rows.
    """
    spark = rows.sparkSession
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    sizes = rows.groupBy(F.size("embedding").alias("size")).agg(F.count("*").alias("n")).filter("size > 0")
    common = sizes.orderBy(F.desc("n"), "size").first()
    if common is None:
        return empty
    size = common["size"]
    kind = "<f4" if rows.schema["embedding"].dataType.elementType.simpleString() == "float" else "<f8"

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                data = _matrix(batch.column("v"), kind)
                yield pa.RecordBatch.from_arrays([pa.array([len(data)]), pa.array([(data * data).sum(axis=1).max()])], ["n", "longest"])

    vectors = stored(classes(rows, size, kind, method.k + 1), "vectors")
    found = vectors.select("v").mapInArrow(lengths, "n bigint, longest double").agg(F.sum("n"), F.max("longest")).first()
    if found[0] is None:
        return empty
    index = deal_out(vectors, plan(vectors, found[0], found[1], size, kind, method), method.part_rows)
    queries = usable(rows.filter(asks), size, kind, None).distinct()
    scored = candidates(vectors, queries, index, method.k).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return scored.withColumn("rank", place).filter(F.col("rank") <= method.k).select("query_id", "rank", "vec_id", "score")
