"""Spelling variants by k-d trees over letter counts.

One inserted or deleted letter changes one entry of a word's vector of letter
counts by one, one replaced letter changes two: the L1 distance of two words one
edit apart is at most two. A k-d tree for each word length cuts the vectors into
boxes. A word looks into the tree of its own length for words with one letter
replaced, and into that of the next length for words with one letter more; boxes
that lie too far away are pruned, and words in the others are compared letter by
letter.

The upper levels of a tree are planned from a bounded sample of the words and
only deal the words out: a word lies in one box and is asked for in each box that
it can reach. A task holds one box, grows the lower levels over what is there,
and answers the words that come. A box that is larger than planned, because many
words share a vector, is split by a hash into parts that each get all questions.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltlake.llm.common import stored

# Letters are A-Z, a-z and U+00C0 to U+00FF; only A-Z have a lower case.
LETTERS = 26 + 64
_PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256)
)
_DIMENSION = np.array([c - 97 if 97 <= c <= 122 else 26 + c - 0xC0 if c >= 0xC0 else 0 for c in range(256)])

# Words of one length that a task holds, words of a lowest box, words sampled to
# plan the boxes, and boxes planned at most (beyond, boxes grow with the words).
BOX_WORDS, LOWEST, SAMPLE, MOST_BOXES = 8192, 24, 65_536, 4096
# Letters of a text that are looked through at once, and words held before counts go out.
SLICE, HELD = 1 << 22, 400_000


@dataclass(frozen=True)
class Spelling:
    """Words of ``least_length`` letters seen ``least_count`` times; the form of a
    word is a near word seen ``ratio`` times as often or more. With ``slip`` one in
    so many pairs of text and word loses a letter, as if it had been misspelt."""

    least_length: int = 7
    least_count: int = 2
    ratio: int = 10
    slip: int | None = 31


# Words


def _runs(text: str, least: int) -> Iterator[list[bytes]]:
    """Runs of ``least`` letters or more, a byte to a letter."""
    found = re.compile(rb"[^ ]{%d,}" % least).findall
    data = text.encode("latin-1", "replace").translate(_PLAIN)
    start = 0
    while start < len(data):
        gap = data.find(b" ", start + SLICE) if len(data) - start > SLICE else -1
        end = gap if gap >= 0 else len(data)
        yield found(data, start, end)
        start = end


def word_counts(docs: DataFrame, method: Spelling = Spelling()) -> DataFrame:
    """word (Latin-1 bytes) and n of all words of ``docs`` (doc_id, text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                if not text:
                    continue
                begun = zlib.crc32(f"{key}:".encode())
                for runs in _runs(text, method.least_length):
                    for word, n in Counter(runs).items():
                        if method.slip:
                            h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), begun)
                            if h % method.slip == 0:
                                at = h % len(word)
                                word = word[:at] + word[at + 1 :]
                                if len(word) < method.least_length:
                                    continue
                        counts[word] += n
                if len(counts) > HELD:
                    yield _table([list(counts), list(counts.values())], COUNTS)
                    counts = Counter()
        if counts:
            yield _table([list(counts), list(counts.values())], COUNTS)

    keyed = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("key"), "text")
    counted = keyed.mapInArrow(count, "word binary, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= method.least_count)


COUNTS = pa.schema([("word", pa.binary()), ("n", pa.int64())])
DEALT = pa.schema([("part", pa.int32()), ("size", pa.int32()), ("asks", pa.bool_()), ("word", pa.binary()), ("n", pa.int64())])
NEAR = pa.schema([("word", pa.binary()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.binary())])


def _table(columns: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, schema)], schema=schema)


def letters(words: list[bytes]) -> np.ndarray:
    """Words of one length, a row each."""
    return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)


def vectors(rows: np.ndarray) -> np.ndarray:
    """The letter counts of words of one length."""
    out = np.zeros((len(rows), LETTERS), np.int32 if rows.shape[1] > 30_000 else np.int16)
    at = np.arange(len(rows))
    for column in range(rows.shape[1]):
        out[at, _DIMENSION[rows[:, column]]] += 1
    return out


def parities(counts: np.ndarray) -> np.ndarray:
    """Which counts are odd, in 64 bits: words differ in no more bits than their
    L1 distance says."""
    odd = (counts & 1).astype(np.uint64)
    return np.bitwise_xor.reduce(odd << (np.arange(LETTERS, dtype=np.uint64) % np.uint64(64)), axis=1)


# Trees


@dataclass(frozen=True)
class KdTree:
    """Nodes by number: the entry that is cut (-1 in a box), where, what the box
    spanned there before, and the children; ``box`` is the number of a box."""

    entry: np.ndarray
    cut: np.ndarray
    low: np.ndarray
    high: np.ndarray
    children: np.ndarray
    box: np.ndarray

    @classmethod
    def grow(cls, counts: np.ndarray, leaf: int) -> tuple[KdTree, np.ndarray]:
        """The tree over ``counts`` with boxes of ``leaf`` vectors or of equal
        ones, and the box of each vector."""
        nodes: list[list] = []
        owner = np.zeros(len(counts), np.int64)
        n_boxes = 0
        start = np.zeros(LETTERS, np.int64) - (1 << 40)
        waiting = [(np.arange(len(counts)), start, -start, None, 0)]
        while waiting:
            rows, low, high, parent, side = waiting.pop()
            here = len(nodes)
            if parent is not None:
                nodes[parent][4][side] = here
            split = _split(counts[rows]) if len(rows) > leaf else None
            if split is None:
                nodes.append([-1, 0, 0, 0, [-1, -1], n_boxes])
                owner[rows] = n_boxes
                n_boxes += 1
                continue
            entry, cut = split
            nodes.append([entry, cut, low[entry], high[entry], [-1, -1], -1])
            below = counts[rows, entry] <= cut
            first, second = high.copy(), low.copy()
            first[entry], second[entry] = cut, cut + 1
            waiting += [(rows[below], low, first, here, 0), (rows[~below], second, high, here, 1)]
        columns = [np.array(x, np.int64) for x in zip(*nodes)]
        return cls(*columns), owner

    def boxes(self, counts: np.ndarray) -> np.ndarray:
        """The box that each vector lies in."""
        node = np.zeros(len(counts), np.int64)
        inner = np.flatnonzero(self.entry[node] >= 0)
        while len(inner):
            at = node[inner]
            node[inner] = self.children[at, (counts[inner, self.entry[at]] > self.cut[at]).astype(np.int64)]
            inner = inner[self.entry[node[inner]] >= 0]
        return self.box[node]

    def reach(self, counts: np.ndarray, over: int, under: int) -> Iterator[tuple[int, np.ndarray]]:
        """(box, rows of ``counts``) where a box may hold a vector that lacks
        ``over`` letters of the row at most and has ``under`` more at most."""
        nothing = np.zeros(len(counts), np.int64)
        waiting = [(0, np.arange(len(counts)), nothing, nothing)]
        while waiting:
            node, rows, lacks, more = waiting.pop()
            entry = self.entry[node]
            if entry < 0:
                yield int(self.box[node]), rows
                continue
            x, cut = counts[rows, entry].astype(np.int64), self.cut[node]
            below = lacks - np.maximum(x - self.high[node], 0) + np.maximum(x - cut, 0)
            above = more - np.maximum(self.low[node] - x, 0) + np.maximum(cut + 1 - x, 0)
            for child, keep in zip(self.children[node], (below <= over, above <= under)):
                if keep.any():
                    first = child == self.children[node][0]
                    waiting.append((child, rows[keep], (below if first else lacks)[keep], (more if first else above)[keep]))


def _split(counts: np.ndarray) -> tuple[int, int] | None:
    """The entry and cut that halve the vectors best; None if all are equal."""
    low, high = counts.min(axis=0), counts.max(axis=0)
    varied = np.flatnonzero(low < high)
    if not len(varied):
        return None
    best = (-1, 0, 0)
    held = counts[:, varied]
    for cut in range(int(low[varied].min()), min(int(high[varied].max()), int(low[varied].min()) + 8)):
        share = (held <= cut).sum(axis=0)
        even = np.minimum(share, len(counts) - share)
        at = int(even.argmax())
        if even[at] > best[0]:
            best = (int(even[at]), int(varied[at]), cut)
    if best[0] < 1:  # counts far apart: halve the widest entry
        entry = int(varied[(high - low)[varied].argmax()])
        return entry, int((int(low[entry]) + int(high[entry])) // 2)
    return best[1], best[2]


# Dealing out


@dataclass(frozen=True)
class Plan:
    """For each common length its tree, and for each box its first part and how
    many it has; other lengths share ``rest`` parts from ``first_rest`` on."""

    trees: dict[int, tuple[KdTree, np.ndarray, np.ndarray]]
    first_rest: int
    rest: int

    @property
    def parts(self) -> int:
        return self.first_rest + self.rest

    def held(self, size: int, words: list[bytes], counts: np.ndarray) -> np.ndarray:
        if size not in self.trees:
            return np.full(len(words), self.first_rest + size % self.rest)
        tree, first, n = self.trees[size]
        box = tree.boxes(counts)
        salt = np.fromiter(map(zlib.crc32, words), np.int64, len(words))
        return first[box] + salt % n[box]

    def asked(self, size: int, counts: np.ndarray, over: int) -> Iterator[tuple[int, np.ndarray]]:
        """(part, rows) for words that look for words of length ``size``."""
        if size not in self.trees:
            yield self.first_rest + size % self.rest, np.arange(len(counts))
            return
        tree, first, n = self.trees[size]
        for box, rows in tree.reach(counts, over, 1):
            for part in range(first[box], first[box] + n[box]):
                yield int(part), rows


def plan(words: DataFrame, box_words: int = BOX_WORDS) -> Plan:
    """Boxes for the stored ``words``, from some ``SAMPLE`` of them, chosen by hash.
    They decide where words meet, not what is found."""
    sized = words.withColumn("size", F.length("word"))
    totals = {r["size"]: r["n"] for r in sized.groupBy("size").agg(F.count("*").alias("n")).filter(F.col("n") > box_words).collect()}
    n_words = words.count()
    sample = defaultdict(list)
    chosen = F.pmod(F.xxhash64("word"), F.lit(1 << 40)) <= int((1 << 40) * min(1, SAMPLE / max(n_words, 1)))
    for (word,) in words.filter(chosen).select("word").collect() if totals else []:
        if len(word) in totals:
            sample[len(word)].append(bytes(word))
    scale = max(1.0, sum(totals.values()) / box_words / MOST_BOXES)
    trees, parts = {}, 0
    for size, held in sorted(sample.items()):
        counts = vectors(letters(held))
        tree, owner = KdTree.grow(counts, max(1, int(len(held) * box_words * scale / totals[size])))
        expected = np.bincount(owner) * (totals[size] / len(held))
        n = np.maximum(1, np.ceil(expected / (2 * box_words * scale))).astype(np.int64)
        trees[size] = (tree, parts + np.cumsum(n) - n, n)
        parts += int(n.sum())
    return Plan(trees, parts, max(1, -(-(n_words - sum(totals[x] for x in trees)) // box_words)))


def _by_length(words: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    for size in np.unique(sizes):
        yield int(size), np.flatnonzero(sizes == size)


def near(words: DataFrame, dealt_by: Plan) -> DataFrame:
    """word, n_near, best_n and best: how many of ``words`` (word, n) are one edit
    away, and the most frequent of them (ties: the smallest); a row for each word
    that has any."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_words, all_n = batch.column("word").to_pylist(), batch.column("n").to_numpy()
            for size, at in _by_length(all_words):
                held = [all_words[i] for i in at]
                counts, n = vectors(letters(held)), all_n[at]
                yield _table([dealt_by.held(size, held, counts), [size] * len(held), [False] * len(held), held, n], DEALT)
                for target, over in ((size, 1), (size + 1, 0)):
                    for part, rows in dealt_by.asked(target, counts, over):
                        k = len(rows)
                        yield _table([[part] * k, [target] * k, [True] * k, [held[i] for i in rows], n[rows]], DEALT)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        box, key, held = None, None, []
        for batch in batches:
            parts, sizes = batch.column("part").to_numpy(), batch.column("size").to_numpy()
            asks = batch.column("asks").to_numpy(zero_copy_only=False)
            names, n = batch.column("word").to_pylist(), batch.column("n").to_numpy()
            edges = np.flatnonzero((np.diff(parts) != 0) | (np.diff(sizes) != 0) | (np.diff(asks.astype(np.int8)) != 0)) + 1
            for a, b in zip([0, *edges], [*edges, batch.num_rows]):
                if a == b:
                    continue
                if key != (parts[a], sizes[a]):
                    if box is not None:
                        yield from box.rest()
                    box, key, held = None, (parts[a], sizes[a]), []
                if not asks[a]:
                    held.append((names[a:b], n[a:b]))
                elif held or box is not None:
                    if box is None:
                        box, held = Box([x for part, _ in held for x in part], np.concatenate([x for _, x in held])), []
                    yield from box.answers(names[a:b], n[a:b])
        if box is not None:
            yield from box.rest()

    dealt = words.mapInArrow(deal, "part int, size int, asks boolean, word binary, n bigint")
    met = dealt.repartitionById(dealt_by.parts, F.col("part")).sortWithinPartitions("part", "size", "asks")
    found = met.mapInArrow(answer, "word binary, n_near bigint, best_n bigint, best binary")
    best = F.min(F.struct((-F.col("best_n")).alias("minus"), "best"))
    return (
        found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
        .select("word", "n_near", (-F.col("b.minus")).alias("best_n"), "b.best")
    )


class Box:
    """The words of one box and length, the lower levels of the tree over them,
    and what words that asked have added to them."""

    def __init__(self, words: list[bytes], n: np.ndarray):
        self.words, self.n, self.rows = words, n, letters(words)
        counts = vectors(self.rows)
        self.tree, owner = KdTree.grow(counts, LOWEST)
        self.members = np.argsort(owner, kind="stable")
        self.ends = np.searchsorted(owner[self.members], np.arange(owner.max() + 2))
        self.odd = parities(counts)
        self.n_near = np.zeros(len(words), np.int64)
        self.best: dict[int, tuple[int, bytes]] = {}

    def pairs(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the words that ask, of one length, and of words here that are
        one edit away from them."""
        counts, same = vectors(rows), rows.shape[1] == self.rows.shape[1]
        odd, ours, theirs = parities(counts), [], []
        check = _one_replaced if same else _one_inserted
        for box, at in self.tree.reach(counts, int(same), 1):
            members = self.members[self.ends[box] : self.ends[box + 1]]
            for some in np.array_split(at, -(-len(at) * len(members) // (1 << 20)) or 1):
                close = np.bitwise_count(odd[some][:, None] ^ self.odd[members][None, :]) <= 1 + same
                i, j = np.nonzero(close)
                i, j = some[i], members[j]
                keep = check(rows[i], self.rows[j])
                ours.append(i[keep])
                theirs.append(j[keep])
        none = np.zeros(0, np.int64)
        return np.concatenate([none, *ours]), np.concatenate([none, *theirs])

    def answers(self, names: list[bytes], n: np.ndarray) -> Iterator[pa.RecordBatch]:
        for size, at in _by_length(names):
            asking = [names[i] for i in at]
            i, j = self.pairs(letters(asking))
            best: dict[int, tuple[int, bytes]] = {}
            for a, b in zip(i.tolist(), j.tolist()):
                _better(best, a, (-int(self.n[b]), self.words[b]))
            n_near = np.bincount(i, minlength=len(asking))
            if best:
                yield _near_rows(asking, n_near, best)
            if size != self.rows.shape[1]:
                counts = n[at]
                self.n_near += np.bincount(j, minlength=len(self.words))
                for a, b in zip(i.tolist(), j.tolist()):
                    _better(self.best, b, (-int(counts[a]), asking[a]))

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.best:
            yield _near_rows(self.words, self.n_near, self.best)


def _better(best: dict, at: int, found: tuple[int, bytes]) -> None:
    if at not in best or found < best[at]:
        best[at] = found


def _near_rows(words: list[bytes], n_near: np.ndarray, best: dict) -> pa.RecordBatch:
    found = [(words[i], n_near[i], -minus, word) for i, (minus, word) in best.items()]
    return _table([list(x) for x in zip(*found)], NEAR)


def _one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(axis=1) == 1


def _one_inserted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether ``b`` is ``a`` with one letter more: what they share in front and
    what they share behind cover ``a``."""
    front = np.logical_and.accumulate(a == b[:, :-1], axis=1).sum(axis=1)
    behind = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return front + behind >= a.shape[1]


# Forms and roots


def roots(forms: DataFrame) -> DataFrame:
    """word and root, the last word that the stored ``forms`` (word, form, neither
    null) lead to. Each round doubles the steps taken; a form is ``ratio`` times
    as frequent as its word, so no chain has more than 63 steps (62 bits)."""
    now = stored(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(6):
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = now.join(onward, "root", "left")
        then = stored(joined.select("word", F.coalesce("next", "root").alias("root"), F.isnotnull("next").alias("moved")), "roots")
        now = then.select("word", "root")
        if then.filter("moved").isEmpty():
            break
    return now


def variants(docs: DataFrame, method: Spelling = Spelling(), box_words: int = BOX_WORDS) -> DataFrame:
    """word, form, root (strings), n, n_near and form_n of each word of ``docs``.

    Null and empty texts have no words; a null doc_id counts as an empty one.
    Repeated rows count each time. Only doc_id and text are read. Very long runs
    of letters are words like others. No words: no rows.
    """
    words = stored(word_counts(docs, method), "words")
    found = words.join(near(words, plan(words, box_words)), "word", "left")
    formed = F.col("best_n") >= method.ratio * F.col("n")
    judged = stored(
        found.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(formed, F.col("best")).alias("form"), F.when(formed, F.col("best_n")).alias("form_n"),
        ),
        "forms",
    )
    ends = roots(judged.filter("form IS NOT NULL").select("word", "form"))
    plain = lambda name: F.decode(name, "ISO-8859-1").alias(name)
    return judged.join(ends, "word", "left").select(
        plain("word"), plain("form"), F.decode(F.coalesce("root", "word"), "ISO-8859-1").alias("root"), "n", "n_near", "form_n"
    )
