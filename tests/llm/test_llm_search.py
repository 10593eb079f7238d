"""Spelling variants, phrases and neighbours against plain versions of them."""

import collections
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from oracle_check import compare, sql_session
from siltlake.llm import neighbours, phrases, spelling, transducer
from siltlake.llm.common import ship
from siltlake.llm.sql import SQL

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def with_clashes(df):
    for name in ("word", "n", "part", "size", "asks", "phrase", "range", "blob", "key", "v", "ids", "bucket", "rank"):
        df = df.withColumn(name, F.lit("extra"))
    return df


# 11


def plain_variants(rows, method=spelling.Spelling()):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", (text or "").translate(lower)):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if method.slip and h % method.slip == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= method.least_length:
                counts[run] += 1
    words = {w: n for w, n in counts.items() if n >= method.least_count}
    near = collections.defaultdict(set)
    for a, b in itertools.combinations(words, 2):
        short, long = sorted((a, b), key=len)
        if len(a) == len(b):
            one = sum(x != y for x, y in zip(a, b)) == 1
        else:
            one = len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))
        if one:
            near[a].add(b)
            near[b].add(a)
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= method.ratio * words[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {(w, form[w], root(w), n, len(near[w]), words[form[w]] if form[w] else None) for w, n in words.items()}


def spelled(df):
    return {tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()}


def odd_rows():
    rng = random.Random(4)
    words = ["".join(rng.choices("abcé", k=rng.randint(6, 9))) for _ in range(60)] + ["Straßen", "ÀÉÎõüÿx", "×÷×÷×÷×", "z" * 4000]
    text = lambda n: rng.choice([" ", ", ", "\n", "漢"]).join(rng.choices(words, weights=[1 + (i % 9) ** 3 for i in range(len(words))], k=n))
    rows = [(i, text(rng.randint(0, 120))) for i in range(60)]
    rows += [(None, text(30)), (None, None), (7, ""), (8, text(10)), (8, "1 2 3"), (2**62, text(3000)), (-5, "q" * 3000)]
    return rows + [(99, text(40))] * 5


@pytest.mark.parametrize("box_words", [16, 8192])
def test_variants_against_all_pairs(spark, box_words):
    rows = odd_rows()
    docs = with_clashes(spark.createDataFrame([(i, t, None, None, 0) for i, t in rows], SCHEMA))
    got = spelling.variants(docs, box_words=box_words)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert spelled(got) == plain_variants(rows)
    chain = spelling.Spelling(least_length=5, slip=None)
    rows = [(1, " ".join(["aaaaaaa"] * 1200 + ["aaaaaab"] * 110 + ["aaaaabb"] * 10 + ["aaaabbb"] * 2 + ["caaabbb"] * 2))]
    found = {r[0]: r for r in spelled(spelling.variants(spark.createDataFrame([(1, rows[0][1], None, None, 0)], SCHEMA), chain, box_words))}
    assert found["aaaabbb"][2] == "aaaabbb" and found["aaaaabb"][1:3] == ("aaaaaab", "aaaaaaa") and set(found.values()) == plain_variants(rows, chain)


def test_many_words_with_the_same_letters(spark):
    """Anagrams share a vector, so no plane parts them: the box is split by a hash."""
    rng = random.Random(9)
    words = {"".join(rng.sample("abcdefgh", 8)) for _ in range(600)} | {"".join(rng.sample("abcdefgi", 8)) for _ in range(200)}
    rows = [(1, " ".join(sorted(words) * 2))]
    method = spelling.Spelling(slip=None)
    docs = spark.createDataFrame([(1, rows[0][1], None, None, 0)], SCHEMA)
    held = spelling.plan(spelling.word_counts(docs, method), 50)
    assert held.trees[8][2].max() > 1
    assert spelled(spelling.variants(docs, method, 50)) == plain_variants(rows, method)


def test_variants_of_nothing(spark):
    assert spelling.variants(spark.createDataFrame([], SCHEMA)).count() == 0
    assert spelling.variants(spark.createDataFrame([(1, "short words only here", None, None, 0)], SCHEMA)).count() == 0


def test_long_texts_are_read_in_parts(monkeypatch):
    monkeypatch.setattr(spelling, "SLICE", 10)
    text = "alphabets and  betagamma, " * 40
    assert [w for part in spelling._runs(text, 7) for w in part] == [b"alphabets", b"betagamma"] * 40


def test_boxes_that_are_pruned_hold_nothing_near():
    rng = np.random.default_rng(3)
    counts = rng.integers(0, 3, (400, spelling.LETTERS)).astype(np.int16)
    counts[:, 6:] = 0
    tree, owner = spelling.KdTree.grow(counts, 8)
    assert (tree.boxes(counts) == owner).all()
    for over, under in ((1, 1), (0, 1)):
        reached = collections.defaultdict(set)
        for box, rows in tree.reach(counts, over, under):
            for row in rows:
                reached[int(row)].add(box)
        for i in range(400):
            diff = counts[i].astype(int) - counts
            near = (np.maximum(diff, 0).sum(1) <= over) & (np.maximum(-diff, 0).sum(1) <= under)
            assert set(owner[near]) <= reached[i]
    assert sum(map(len, reached.values())) < 0.5 * 400 * (owner.max() + 1)


# 12


def grams(rng, words):
    return collections.Counter(tuple(rng.choices(words, k=rng.randint(1, 4))) for _ in range(rng.randint(1, 80)))


def automaton(counts):
    words = sorted({w for g in counts for w in g})
    rows = [[words.index(w) + 1 for w in g] + [0] * (max(map(len, counts)) - len(g)) for g in sorted(counts)]
    return transducer.CountTransducer.build(words, np.array(rows, np.int64), np.array([counts[g] for g in sorted(counts)]))


def spelt(words, found):
    return {tuple(words[i - 1] for i in row if i): n for rows, counts in found for row, n in zip(rows.tolist(), counts.tolist())}


def test_automata_hold_add_and_meet():
    rng = random.Random(1)
    for _ in range(100):
        words = sorted({bytes(rng.choices(b"ab", k=rng.randint(1, 3))) for _ in range(rng.randint(1, 8))})
        a, b = grams(rng, words), grams(rng, words)
        one, two = automaton(a), transducer.CountTransducer.load(automaton(b).dump())
        assert spelt(one.words, one.phrases()) == dict(a) and spelt(two.words, two.phrases()) == dict(b)
        names, rows, counts = transducer.union([one, two])
        assert spelt(names, [(rows, counts)]) == dict(a + b)
        assert spelt(two.words, one.compose(two)) == {g: a[g] for g in a if g in b}


def test_equal_states_are_one():
    counts = {(bytes([a]), bytes([b]), b"z"): 7 for a in b"abcdef" for b in b"ghijkl"}
    assert len(automaton(counts).first) - 1 == 4  # the end, before "z", before the second word, the root


def plain_phrases(rows, method=phrases.Mining()):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(lower)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, method.longest + 1):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = set()
    for lang, own in f.items():
        found = {w: a for w, a in own.items() if len(w) > 1 and a >= method.least}
        ranked = []
        for w, a in found.items():
            inside = lambda x: any(x[i : i + len(w)] == w for i in range(len(x) - len(w) + 1))  # noqa: E731, B023
            if any(len(x) > len(w) and 100 * b >= method.covered * a and inside(x) for x, b in found.items()):
                continue
            score, k = min((1_000_000 * a * a // (own[w[:k]] * own[w[k:]]), k) for k in range(1, len(w)))
            ranked.append((-score, -a, " ".join(w).encode(), own[w[:k]], own[w[k:]]))
        for place, (score, a, phrase, left, right) in enumerate(sorted(ranked)[: method.top], 1):
            out.add((lang, place, phrase.decode(), -a, left, right, n[lang], -score))
    return out


@pytest.mark.parametrize("small", [False, True])
def test_phrases_against_counting(spark, monkeypatch, small):
    if small:  # many shards, ranges and slices
        for name, value in (("SLICE", 50), ("BLOCK", 300), ("DIFFERENT", 20), ("RANGE", 400), ("WINDOW", 64)):
            monkeypatch.setattr(phrases, name, value)
    rng = random.Random(6)
    words = ["a", "B", "c", "dé", "漢字", "e\x00f", "it's", "zz"] + [f"w{i}" for i in range(30)]
    text = lambda n: "".join(x + rng.choice([" ", " ", "  ", "\t", ", ", "\n", "\r\n", "!? "]) for x in rng.choices(words, [9] * 8 + [1] * 30, k=n))
    rows = [(text(rng.randint(0, 90)), rng.choice(["en", "de", None, "und", ""])) for _ in range(60)]
    rows += [(None, "en"), ("", None), ("...", "en"), (text(6000), "en"), ("hot line of words\n" * 500, "de")] + [("same row a b c", "fr")] * 12
    docs = with_clashes(spark.createDataFrame([(i, t, lang, None, 0) for i, (t, lang) in enumerate(rows)], SCHEMA)).repartition(5)
    for method in (phrases.Mining(), phrases.Mining(top=7, least=3)) if not small else (phrases.Mining(longest=3),):
        got = phrases.collocations(docs, method)
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert {tuple(r) for r in got.collect()} == plain_phrases(rows, method)
    if small:
        assert phrases.plan(docs, phrases.Mining()).n > 3


def test_phrases_of_nothing(spark):
    assert phrases.collocations(spark.createDataFrame([], SCHEMA)).count() == 0
    assert phrases.collocations(spark.createDataFrame([(1, "a b", None, None, 0)], SCHEMA)).count() == 0


def test_phrases_equal_their_sql(spark):
    assert compare(entry.queries()["op12_phrase_automata"](spark, SF), sql_session(SF), SQL["op12_phrase_automata"]) is None


# 13

VECTORS = "vec_id bigint, embedding array<float>, label int"


def plain_nearest(rows, k=20):
    held = {(i, tuple(v)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(v)}
    out = {}
    for i, v in held:
        if i % 20 == 0:
            scored = {}
            for j, w in held:
                if j != i:
                    s = float((np.float32(v).astype(float) * np.float32(w).astype(float)).sum())
                    scored[j] = max(s, scored.get(j, -np.inf))
            out[i] = sorted(((-s, j) for j, s in scored.items()))[:k]
    return out


def found_of(df):
    out = collections.defaultdict(dict)
    for r in df.collect():
        out[r.query_id][r["rank"]] = (-r.score, r.vec_id)
    for places in out.values():
        assert sorted(places) == list(range(1, len(places) + 1))
    return {q: [places[i] for i in sorted(places)] for q, places in out.items()}


def test_neighbours_with_odd_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(6).tolist()) for i in range(120)]
    rows += [(200 + i, rows[3][1]) for i in range(90)] + [rows[20], rows[20]]  # one vector very often, repeated rows
    rows += [(300, None), (301, [0.0] * 6), (302, [float("nan")] * 6), (303, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (320, [float("inf")] + [1.0] * 5)]
    rows += [(None, rows[0][1]), (340, rows[3][1]), (-40, (10 * np.array(rows[3][1])).tolist())]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows] + [(400, [1.0], 0)], VECTORS).repartition(3)
    for name in ("v", "ids", "part", "score", "rank"):
        df = df.withColumn(name, F.lit("extra"))
    search = neighbours.Search(success=1 - 1e-9, part_rows=16, bucket_rows=8)  # visits all that can be near
    got, want = found_of(neighbours.nearest(df, "vec_id % 20 = 0", search)), plain_nearest(rows)
    assert got.keys() == want.keys()
    for q in want:
        assert [j for _, j in got[q]] == [j for _, j in want[q]]
        assert np.allclose([s for s, _ in got[q]], [s for s, _ in want[q]], rtol=1e-12)


@pytest.mark.parametrize("scale", [False, True])
def test_recall_of_neighbours(spark, scale):
    rng = np.random.default_rng(2)
    data = rng.standard_normal((3000, 32))
    data /= np.linalg.norm(data, axis=1)[:, None]
    if scale:
        data *= rng.uniform(0.5, 2, (3000, 1))
    rows = [(i, v) for i, v in enumerate(data.astype(np.float32).tolist())]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS)
    got = found_of(neighbours.nearest(df, "vec_id % 20 = 0", neighbours.Search(part_rows=500, bucket_rows=64)))
    held = data.astype(np.float32).astype(float)
    hits = 0
    for q in range(0, 3000, 20):
        scores = held @ held[q]
        scores[q] = -np.inf
        best = np.lexsort((np.arange(3000), -scores))[:20]
        hits += len(set(best.tolist()) & {j for _, j in got[q]})
    assert hits / (150 * 20) >= 0.9


def test_buckets_are_visited_in_order_of_success():
    rng = np.random.default_rng(4)
    cells = rng.dirichlet(np.ones(4), (30, 5))
    for beam in (4, 64):
        for row, found in zip(cells, neighbours.visits(cells, 0.9, beam)):
            chance = {code: np.prod([row[j, c] for j, c in enumerate(places)]) for code, places in enumerate(itertools.product(range(4), repeat=5))}
            best = sorted(chance, key=lambda x: -chance[x])
            assert np.allclose([chance[x] for x in found], [chance[x] for x in best[: len(found)]])
            assert sum(chance[x] for x in found) >= 0.9 > sum(chance[x] for x in found[:-1])


def test_neighbours_of_nothing(spark):
    df = spark.createDataFrame([], VECTORS)
    assert neighbours.nearest(df, "vec_id % 20 = 0").count() == 0
    few = spark.createDataFrame([(0, [1.0, 2.0], 0), (1, [0.0, 0.0], 0), (2, None, 0)], VECTORS)
    assert neighbours.nearest(few, "vec_id % 20 = 0").count() == 0
    two = spark.createDataFrame([(0, [1.0, 2.0], 0), (1, [2.0, 1.0], 0)], VECTORS)
    assert [tuple(r) for r in neighbours.nearest(two, "vec_id % 20 = 0").collect()] == [(0, 1, 1, 4.0)]


def test_the_registered_search_reaches_its_recall(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got, want = found_of(entry.queries()["op13_multiprobe_neighbours"](spark, SF)), plain_nearest(rows)
    hits = sum(len({j for _, j in got[q]} & {j for _, j in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values())) and got.keys() == want.keys()
