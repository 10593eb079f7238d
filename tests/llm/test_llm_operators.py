"""Each operator against a plain version of itself, and on odd tables."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as entry
from oracle_check import compare, sql_session
from siltlake.llm import bitpack, byte_bpe, chunks, fingerprints, mixing, outliers, separators, sharding, simhash_dedup, url_filter
from siltlake.llm.common import components, ship, stored, word_blocks
from siltlake.llm.sql import SQL

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="module")
def rows():
    """Nulls, empty and very long texts, ties, repeated rows."""
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(400)]
    text = lambda n: " ".join(rng.choices(words, k=n))
    passage = text(70)
    found = [
        (0, text(300), "en", "a"), (1, "", "en", "a"), (2, None, "en", None), (None, text(40), None, "b"),
        (None, None, None, None), (5, "Ünï çødé 漢字 🙂 don't  stop\n\n it's  ", "de", "b"), (5, "other text, same id", "de", "b"),
        (6, text(30_000), "en", "c"), (7, "x" * 60_000, "en", "c"), (8, "a a a a a a a a a a " * 300, "en", "a"),
        (9, f"{text(30)} {passage} {text(25)}", "en", "a"), (10, f"{text(12)}\n{passage} {text(50)}", "en", "b"),
        (11, "line one here\nline one here\n \n#### $$$ %%%", "en", "a"), (2**62, text(60), "en", "ü"), (-4, text(60), "en", "A"),
    ]
    found += [(20, "the same row, more than once, with a few words to it", "en", "a")] * 3
    found += [(30 + i, found[0][1], "en", "a") for i in range(5)]
    found += [(40 + i, text(rng.randint(20, 200)), rng.choice(["en", "de"]), rng.choice("abc")) for i in range(60)]
    return [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in found]


@pytest.fixture(scope="module")
def docs(spark, rows):
    """With columns whose names the operators use themselves."""
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("fp", "row", "group", "size", "id", "key", "spans", "s", "keys", "cell", "copies"):
        df = df.withColumn(name, F.lit("extra"))
    return stored(df, "docs")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def dicts(df):
    return [row.asDict() for row in df.collect()]


def words_of(text):
    return WORDS.findall(text or "")


# Shared parts


def test_word_blocks_split_like_the_whole():
    rng = random.Random(1)
    data = "".join(rng.choices("ab \n\té", k=5000)).encode()
    for limit in (1, 7, 100, 10_000):
        assert list(itertools.chain(*word_blocks(data, limit))) == data.split()


def test_components_of_random_links(spark):
    rng = random.Random(5)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(40)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a int, b int")).collect()}
    assert found == {x: find(x) for x in parent}


# 1


def plain_fingerprint(text, size=3):
    words = [w.lower() for w in (text or "").encode().split()]
    shingles = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, ids, radius):
    label = list(range(len(prints)))
    for i, j in itertools.combinations(range(len(prints)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= radius and label[i] != label[j]:
            old, new = label[j], label[i]
            label = [new if x == old else x for x in label]
    least = {x: min((d for d, y in zip(ids, label) if y == x and d is not None), default=None) for x in label}
    return [least[x] for x in label]


def test_simhash_components(docs, rows):
    prints = [plain_fingerprint(r[1]) for r in rows]
    want = zip((r[0] for r in rows), (f"{p:016x}" for p in prints), plain_components(prints, [r[0] for r in rows], 2))
    found = [(r.doc_id, r.fingerprint, r.component_id) for r in simhash_dedup.component_ids(docs).collect()]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(found, key=key) == sorted(want, key=key)


def test_simhash_of_an_empty_table(empty):
    assert simhash_dedup.component_ids(empty).count() == 0
    assert simhash_dedup.keep_one(empty).columns == empty.columns


def test_pivot_tables_lose_no_link(spark, monkeypatch):
    """Fingerprints around few centres, so that cells are cut into blocks."""
    monkeypatch.setattr(simhash_dedup, "CELL", 8)
    rng = random.Random(9)
    centres = [rng.getrandbits(64) for _ in range(6)]
    prints = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for c in centres for _ in range(60)}
    prints = sorted(prints)
    df = spark.createDataFrame([(x.to_bytes(8, "big"),) for x in prints], "fp binary").repartition(3)
    links = simhash_dedup.near_links(df, simhash_dedup.SimHash().tables(len(prints)))
    pairs = [(int.from_bytes(a, "big"), int.from_bytes(b, "big")) for a, b in links.collect()]
    assert all((a ^ b).bit_count() <= 2 for a, b in pairs)
    root = {r.node: r.root for r in components(links).collect()}
    want = plain_components(prints, prints, 2)
    groups = collections.defaultdict(set)
    for x, w in zip(prints, want):
        groups[w].add(bytes(root.get(x.to_bytes(8, "big"), x.to_bytes(8, "big"))))
    assert all(len(roots) == 1 for roots in groups.values())
    assert len(set().union(*groups.values())) == len(groups)


def test_near_copies_of_five_word_shingles(spark):
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(3000)]
    texts = [rng.choices(words, k=200) for _ in range(60)]
    changed = [[rng.choice(words) if rng.random() < 0.015 else w for w in t] for t in texts]
    other = [t[:100] + rng.choices(words, k=100) for t in texts[:20]]
    rows = [(i, " ".join(t), None, None, None) for i, t in enumerate(texts + changed + other)]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = {r.doc_id for r in simhash_dedup.keep_one(docs, simhash_dedup.FIVE_WORDS).collect()}

    def jaccard(a, b):
        x, y = ({tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in (a, b))
        return len(x & y) / len(x | y)

    near = [i for i in range(60) if jaccard(texts[i], changed[i]) >= 0.8]
    assert len(near) > 30 and set(range(60)) <= kept and set(range(120, 140)) <= kept
    assert sum(60 + i in kept for i in near) <= 0.05 * len(near)


@pytest.mark.parametrize("hot", [4, 10**6])
def test_links_of_a_hot_cell(spark, monkeypatch, hot):
    """Fingerprints that agree in half of their bits, against all pairs."""
    monkeypatch.setattr(simhash_dedup, "HOT_CELL", hot)
    rng = random.Random(8)
    prints = {0x0123456700000000 | rng.getrandbits(12) for _ in range(150)} | {rng.getrandbits(64) for _ in range(50)}
    near = lambda a, b: (a ^ b).bit_count() <= 2
    parent = {x: x for x in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(prints), 2):
        if near(a, b):
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    df = spark.createDataFrame([(x.to_bytes(8, "big"),) for x in prints], "fp binary")
    rows = simhash_dedup.with_groups(stored(df, "fps")).collect()
    groups = collections.defaultdict(set)
    for r in rows:
        groups[bytes(r["group"])].add(int.from_bytes(r.fp, "big"))
    want = collections.defaultdict(set)
    for x in prints:
        want[find(x)].add(x)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_keep_one_keeps_the_first_of_each_component(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    components_of = {r.component_id for r in simhash_dedup.component_ids(docs).collect()}
    assert {r.doc_id for r in simhash_dedup.keep_one(docs).collect()} == components_of


def test_keep_one_keeps_whole_rows(docs, rows):
    kept = simhash_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    found = [r.doc_id for r in kept.collect()]
    assert found.count(20) == 1 and 0 in found and not set(range(30, 35)) & set(found)
    assert found.count(1) == 1 and 2 not in found  # texts without words are copies


# 2


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, rest, total = {}, set(order), share * sum(sizes.values())
    while rest:
        level = (total - sum(out.values())) / sum(weight[s] for s in rest)
        full = {s for s in rest if level * weight[s] > most * sizes[s]}
        if not full:
            return out | {s: level * weight[s] for s in rest}
        out |= {s: most * sizes[s] for s in full}
        rest -= full
    return out


def test_mix_meets_its_targets(docs, rows):
    found = dicts(mixing.taken(docs))
    assert sorted((str(r["doc_id"]), r["size"]) for r in found) == sorted((str(r[0]), len(words_of(r[1]))) for r in rows)
    sizes = collections.Counter()
    for r in rows:
        sizes[r[3]] += len(words_of(r[1]))
    want = plain_targets(sizes)
    by_size = {s: [r for r in found if r["source_size"] == n] for s, n in sizes.items()}
    for source, n in sizes.items():
        assert all(math.isclose(r["target"], want[source], rel_tol=1e-9) for r in by_size[source])
        largest = max((r["size"] for r in by_size[source]), default=0)
        assert abs(sum(r["taken"] for r in by_size[source]) - want[source]) <= 2 * largest
    assert all(r["taken"] in (0, r["size"], 2 * r["size"]) for r in found)
    assert sorted(map(str, found)) == sorted(map(str, dicts(mixing.taken(docs.repartition(5)))))


def test_mix_takes_random_documents_in_proportion(spark):
    """Sizes do not change a document's chances; the words come out exactly."""
    rows = [(i, "w " * (1 + i % 50), None, "b" if i < 3000 else "a", 0) for i in range(4000)]
    found = dicts(mixing.taken(spark.createDataFrame(rows, SCHEMA), mixing.Mix(weights=(1, 1), share=0.5)))
    b = [r for r in found if r["doc_id"] < 3000]
    assert abs(sum(r["taken"] for r in b) - b[0]["target"]) <= 1
    chance = b[0]["target"] / b[0]["source_size"]
    for low in range(0, 50, 10):
        part = [r["taken"] > 0 for r in b if low < r["size"] <= low + 10]
        # Longer documents are favoured, as the operator states.
        sizes = [r["size"] for r in b]
        mean = sum(mean_favour(n) * n for n in sizes) / sum(sizes)
        want = [chance * mean_favour(n) / mean for n in sizes if low < n <= low + 10]
        assert abs(sum(part) / len(part) - sum(want) / len(want)) < 0.09


def mean_favour(size):
    return 1000 * size // (size + 100)


@pytest.mark.parametrize("share", [0.75, 1.5])
def test_mix_with_a_third_of_equal_rows(spark, share):
    """Null ids, equal texts and sizes: the target is met, not passed by a group."""
    rows = [(None, "one two three", None, "a", 0)] * 2000 + [(i, "w " * 30, None, "b", 0) for i in range(700)] + [(7, "x y", None, None, 0)] * 300
    found = dicts(mixing.taken(spark.createDataFrame(rows, SCHEMA).repartition(7), mixing.Mix(share=share)))
    assert len(found) == 3000 and all(r["taken"] <= 2 * r["size"] for r in found)
    for size, largest in ((6000, 3), (21000, 30), (600, 2)):
        own = [r for r in found if r["source_size"] == size]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= largest
    docs = spark.createDataFrame(rows, SCHEMA)
    assert mixing.mixed(docs, mixing.Mix(share=share)).filter("source = 'a'").count() * 3 == sum(r["taken"] for r in found if r["source_size"] == 6000)


def test_mix_rows(docs, rows, empty):
    mix = mixing.Mix(least=1.0)
    found = collections.Counter(r.doc_id for r in mixing.mixed(docs, mix).collect())
    words = collections.Counter()
    for r in dicts(mixing.taken(docs, mix)):
        if r["size"]:
            words[r["doc_id"]] += r["taken"] // r["size"]
    assert all(found[i] == n for i, n in words.items() if i not in (None, 5))
    assert mixing.mixed(docs, mix).columns == docs.columns
    assert mixing.taken(empty).count() == 0 and mixing.mixed(empty).count() == 0


def test_no_source_passes_its_bounds(spark):
    sizes = {"a": 10, "b": 1000, "c": 5, "d": 0, None: 70, "é": 300}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    found = {r.source: r.target for r in mixing.targets(df, mixing.Mix()).collect()}
    assert found == pytest.approx(plain_targets(sizes))


# 3


def test_fingerprints_and_edits(docs, rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    want = []
    for i, (doc_id, text, *_) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        changed = fingerprints.edited(text, after)
        a, b, c = (fingerprints.simhash(x.encode()) for x in (text, changed, after))
        digest = hashlib.sha256(changed.encode()).hexdigest()
        want.append((doc_id, len(text), digest, f"{a:016x}", f"{b:016x}", fingerprints.likeness(a, b), fingerprints.likeness(a, c)))
    found = [tuple(r) for r in fingerprints.fingerprints(docs).collect()]
    assert sorted(map(str, found)) == sorted(map(str, want))


def test_fingerprints_in_many_ranges(spark, monkeypatch, empty):
    monkeypatch.setattr(fingerprints, "RANGE_DOCS", 3)
    monkeypatch.setattr(fingerprints, "GROUP", 4)
    ids = random.Random(4).sample(range(-1000, 1000), 100)
    rows = [(i, f"text of document {i} " * (i % 7), None, None, 0) for i in ids]
    order = sorted(rows)
    found = {r.doc_id: r.edited_sha256 for r in fingerprints.fingerprints(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found == {
        r[0]: hashlib.sha256(fingerprints.edited(r[1], order[(i + 1) % 100][1]).encode()).hexdigest() for i, r in enumerate(order)
    }
    assert fingerprints.fingerprints(empty).count() == 0


def test_terms_of_long_texts(monkeypatch):
    data = b" ".join(random.Random(6).choices([b"a", b"bb", b"c"], k=3000))
    whole = fingerprints.simhash(data)
    monkeypatch.setattr(fingerprints, "word_blocks", lambda d: word_blocks(d, 100))
    assert fingerprints.simhash(data) == whole


def test_search_finds_all_within_the_radius(spark):
    rng = random.Random(8)
    centres = [rng.getrandbits(64) for _ in range(20)]
    prints = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6))) for c in centres for _ in range(15)}
    signed = sorted(x - 2**64 if x >> 63 else x for x in prints)
    df = spark.createDataFrame([(x,) for x in signed], "fp bigint")
    found = {tuple(r) for r in fingerprints.search(df.filter("fp % 3 = 0"), df).collect()}
    apart = lambda a, b: ((a ^ b) % 2**64).bit_count()
    assert found == {(a, b, apart(a, b)) for a in signed if a % 3 == 0 for b in signed if apart(a, b) <= 3}


# 4


def test_shards(docs, rows, empty, tmp_path):
    path = str(tmp_path / "map")
    found = dicts(sharding.sharded(docs, 5, path))
    text = lambda r: (r[1] or "").encode()
    want = sorted((str(r[0]), len(text(r)) + 8, zlib.crc32(text(r))) for r in rows)
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in found) == want
    places = collections.defaultdict(list)
    for r in found:
        places[r["shard"]].append(r["slot"])
    assert all(sorted(x) == list(range(len(x))) for x in places.values())
    assert sharding.read_map(docs.sparkSession, path).count() == sharding.SLOTS
    assert sharding.sharded(empty).count() == 0


def test_a_third_of_all_rows_under_one_key_is_spread(spark, tmp_path):
    rng = random.Random(3)
    rows = [(5, "t" * rng.randint(0, 60), None, None, 0) for _ in range(1000)] + [(None, "same text", None, None, 0)] * 500
    rows += [(100 + i, "t" * rng.randint(0, 60), None, None, 0) for i in range(1500)]
    docs, path = spark.createDataFrame(rows, SCHEMA), str(tmp_path / "map")
    found = dicts(sharding.sharded(docs, 24, path, grow=True))
    loads, moved = collections.Counter(), 0
    for r in found:
        loads[r["shard"]] += r["size"]
        moved += r["shard"] != r["next_shard"]
    mean = sum(loads.values()) / 24
    assert len(found) == 3000 and max(loads.values()) < 1.1 * mean and min(loads.values()) > 0.9 * mean
    assert 0 < moved < 0.15 * 3000 and {r["next_shard"] for r in found} == set(range(25))
    for shard in range(24):
        places = sorted(r["slot"] for r in found if r["shard"] == shard)
        assert places == list(range(len(places)))


def test_a_stored_map_is_used_again(spark, tmp_path):
    docs = spark.createDataFrame([(i, "t" * (i % 40), None, None, 0) for i in range(3000)], SCHEMA)
    path = str(tmp_path / "map")
    first = {r["doc_id"]: r["shard"] for r in dicts(sharding.sharded(docs, 8, path))}
    more = docs.unionAll(spark.createDataFrame([(3000 + i, "new", None, None, 0) for i in range(300)], SCHEMA))
    again = {r["doc_id"]: r["shard"] for r in dicts(sharding.sharded(more, 8, path))}
    assert sum(again[i] != shard for i, shard in first.items()) < 300  # only edits
    versions = {r[0] for r in spark.read.parquet(path).select("version").distinct().collect()}
    assert versions == {0, 1}


def test_rebalancing_moves_few_slots():
    rng = random.Random(7)
    loads = {slot: rng.randint(50, 150) for slot in range(1000)}
    shards = lambda m, n: [sum(loads[s] for s in m if m[s] == k) for k in range(n)]
    first = sharding.assign(loads, 10, 1000)
    assert max(shards(first, 10)) / min(shards(first, 10)) < 1.01
    grown = sharding.rebalance(first, loads, 11)
    left = [grown[s] for s in first if grown[s] != first[s]]
    assert len(left) < 200 and left.count(10) > 0.9 * len(left)
    assert max(shards(grown, 11)) / min(shards(grown, 11)) < 1.05
    less = sharding.rebalance(grown, loads, 9)
    assert all(less[s] == grown[s] or grown[s] >= 9 or loads[s] for s in less) and set(less.values()) == set(range(9))
    moved = sum(less[s] != grown[s] for s in less if grown[s] < 9)
    assert moved < 50


def test_map_versions(spark, tmp_path):
    path = str(tmp_path / "map")
    sharding.write_map(spark, path, 0, {0: 0, 1: 0})
    sharding.write_map(spark, path, 1, {0: 0, 1: 1})
    assert {tuple(r) for r in sharding.read_map(spark, path).collect()} == {(0, 0), (1, 1)}
    assert {tuple(r) for r in sharding.read_map(spark, path, 0).collect()} == {(0, 0), (1, 0)}
    with pytest.raises(Exception, match="exists"):
        sharding.write_map(spark, path, 1, {0: 1})


# 5


def plain_verdict(url, rules=url_filter.RULES):
    found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (found[1], found[2]) if found else ("", "")
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = []
    for verdict, key in rules:
        rule_host, slash, rest = key.partition("/")
        if (host == rule_host or host.endswith(f".{rule_host}")) and path.startswith(slash + rest):
            fits.append((len(key), verdict == "block", key))
    best = max(fits, default=None)
    return host, path, best and best[2], "block" if best and best[1] else "allow"


def test_urls(spark):
    urls = [
        None, "", "no scheme.org/", "http://EXAMPLE.org/en/1", "https://a.b.example.org/es/?q", "x://org", "x://org/", "x://notorg/",
        "http://xexample.org/es/", "http://É.COM/fr/", "http://com/de/#x", "http://a..org/", "//org/", "http://org?/x", "http://a.com/fr/\nx",
    ]
    rng = random.Random(1)
    urls += [
        f"http://{rng.choice(['', 'www.', 'a.b.'])}{rng.choice(['example.org', 'example.com', 'x.net', 'org'])}/{rng.choice(['es', 'en', 'fr', 'de'])}/{rng.randint(1, 30)}"
        for _ in range(300)
    ]
    pages = spark.createDataFrame(list(enumerate(urls)) + [(0, None)], "page_id bigint, url string").withColumn("keys", F.lit(1))
    found = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in dicts(url_filter.judged(pages))}
    assert found == {i: plain_verdict(u) for i, u in enumerate(urls)}
    assert url_filter.judged(pages.limit(0)).count() == 0
    assert url_filter.judged(pages, []).filter("verdict = 'allow' AND rule IS NULL").count() == len(urls) + 1


@pytest.mark.parametrize("rate", [None, 0.5, 0.2])
def test_cascades_are_exact(spark, rate):
    universe = spark.range(6000).selectExpr("concat('key', id) AS key").unionAll(spark.sql("SELECT CAST(NULL AS STRING)"))
    listed = spark.range(0, 6000, 11).selectExpr("concat('key', id) AS key")
    cascade = url_filter.build(listed, universe, rate)
    assert len(cascade.levels) > 1
    kept = {r.key for r in universe.filter(cascade.holds(F.col("key"))).collect()}
    assert kept == {r.key for r in listed.collect()}


# 6


@pytest.mark.parametrize("bits", [1, 3, 8, 11, 16, 17, 31, 32])
def test_packing_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 2**bits, 1000, dtype=np.uint64).astype(np.uint32)
    for n in (0, 1, 7, 1000):
        packed = bitpack.pack(ids[:n], bits)
        assert len(packed) == (n * bits + 7) // 8
        assert (bitpack.unpack(packed, bits, n) == ids[:n]).all()


def test_random_access(tmp_path):
    import pyarrow.fs as pafs

    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 5000, n).astype(np.uint32) for n in (0, 1, 63, 64, 65, 1000, 3)]
    writer = bitpack.Writer(bitpack.bits_for(5000), block=64)
    for i, ids in enumerate(docs):
        writer.add(i - 3, ids)
    system = pafs.LocalFileSystem()
    with system.open_output_stream(str(tmp_path / "x")) as out:
        writer.write(out)
    flat = np.concatenate(docs)
    with system.open_input_file(str(tmp_path / "x")) as source:
        reader = bitpack.Reader(source)
        assert reader.bits == 13 and reader.doc_ids.tolist() == [i - 3 for i in range(7)]
        for a, b in ((0, len(flat)), (63, 65), (64, 128), (500, 501), (9, 9)):
            assert (reader.ids(a, b) == flat[a:b]).all()
        for most in (1, 50, 1 << 20):
            read = [(i, start, np.concatenate([*parts, np.zeros(0, np.uint32)])) for i, start, parts in reader.documents(most)]
            assert [i for i, *_ in read] == [i - 3 for i in range(7)]
            assert all((got == want).all() and len(got) == len(want) for (*_, got), want in zip(read, docs))


def test_packed_documents(docs, rows, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    signed = lambda text: (xxhash.xxh64_intdigest(text.encode(), 42) + 2**63) % 2**64 - 2**63
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, signed(r[1] or "")))
    start, want = 0, []
    for doc_id, text, *_ in order:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    found = [tuple(r) for r in bitpack.packed(docs, TOKENIZER, 50_257, 2).collect()]
    assert sorted(found, key=lambda r: r[1]) == want
    assert bitpack.packed(empty, TOKENIZER, 50_257, 2).count() == 0


def test_pieces_encode_like_whole_texts():
    from tokenizers import Tokenizer

    tokenizer, rng = Tokenizer.from_file(TOKENIZER), random.Random(11)
    alphabet = ["a", "B", "'s", "1", " ", " ", "  ", "\n", "\t", " ", "\x1c", "\x85", "\xa0", "\r\n", "é", "漢", "🙂", "…", "<|endoftext|>", "​"]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 30))) for _ in range(3000)]
    encoder = bitpack.PieceEncoder(TOKENIZER)
    found = [x.tolist() for i in range(0, 3000, 100) for x in encoder.encode(pa.array(texts[i : i + 100]))]
    assert found == [x.ids for x in tokenizer.encode_batch(texts, add_special_tokens=False)]


# 7


def test_token_counts(docs, rows, empty):
    encode = separators.encoding(RANKS, PATTERN).encode_ordinary
    found = [(r.doc_id, r.n_tokens) for r in separators.token_counts(docs, RANKS, PATTERN, 50_256).collect()]
    assert sorted(map(str, found)) == sorted(str((r[0], len(encode(r[1] or "")))) for r in rows)
    assert separators.token_counts(empty, RANKS, PATTERN, 50_256).count() == 0


def test_long_runs_of_white_space(spark):
    """Two million blanks and line ends, and a text of nine megabytes."""
    texts = [" " * 2_000_000, "\n" * 2_000_000, "a" + " \n" * 1_000_000 + "b", "words and more words " * 450_000, "<|endoftext|> x", ""]
    docs = spark.createDataFrame([(i, x, "en", "s", len(x)) for i, x in enumerate(texts)], SCHEMA).repartition(3)
    flat = {r.doc_id: r.n_tokens for r in separators.token_counts(docs, RANKS, PATTERN, 50_256).collect()}
    both = {r.doc_id: r.n_tokens for r in byte_bpe.round_trip(docs, RANKS, PATTERN).collect()}
    assert flat == both
    packed = {r.doc_id: r.n_tokens for r in bitpack.packed(docs, TOKENIZER, 50_257, 2).collect()}
    assert len(packed) == 6 and packed[5] == 1 and packed[4] == 3  # the added token, " x" and the end
    assert {r.doc_id: r.size for r in mixing.taken(docs).collect()}[3] == 1_800_000
    assert sharding.sharded(docs, 3).count() == fingerprints.fingerprints(docs).count() == 6
    assert simhash_dedup.component_ids(docs).count() == outliers.judged(docs).count() == 6
    assert chunks.shared_passages(docs).count() == 0


@pytest.mark.parametrize("block", [1, 2, 7, 64, 1000])
def test_scan_over_blocks(spark, tmp_path, block):
    rng, want = random.Random(12), []
    files = {"a": [9], "b": [], "c": [1, 2, 3], "d": [9, 9, 1, 9]}
    files["e"] = [9 if rng.random() < 0.1 else rng.randrange(9) for _ in range(500)]
    for name, ids in files.items():
        (tmp_path / name).write_bytes(np.array(ids, "<u2").tobytes())
        lengths = [len(x) for x in _split(ids, 9)]
        want += [(name, i, n) for i, n in enumerate(lengths)]
    named = spark.createDataFrame([(x,) for x in files], "file string")
    found = [tuple(r) for r in separators.scan(named, f"file://{tmp_path}", 9, block_ids=block).collect()]
    assert sorted(found) == sorted(want)


def _split(ids, end):
    out, open_ = [], []
    for x in ids:
        if x == end:
            out.append(open_)
            open_ = []
        else:
            open_.append(x)
    return out + [open_] * bool(open_)


# 8


def plain_statistics(text):
    text = text or ""
    words = words_of(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often, covered, seen, repeated = collections.Counter(windows), set(), set(), 0
    for i, window in enumerate(windows):
        if often[window] > 1:
            covered.update(range(i, i + 8))
    for line in text.split("\n"):
        if WORDS.search(line):
            repeated += line in seen
            seen.add(line)
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered), failed


def test_statistics_and_verdicts(docs, rows, empty):
    found = dicts(outliers.judged(docs))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert sorted(str((r["doc_id"], *(r[x] for x in names))) for r in found) == sorted(
        str((r[0], *plain_statistics(r[1]))) for r in rows
    )
    assert all(not r["kept"] for r in found if r["base_failed"])
    good = outliers.good(docs)
    assert good.columns == docs.columns and good.count() == sum(r["kept"] for r in found)
    assert outliers.judged(empty).count() == 0


def test_outliers_are_rejected_even_if_many(spark):
    """A fifth of a group is junk; the rest has to stay."""
    rng = random.Random(13)
    words = ["".join(rng.choices("abcdefghijklm", k=rng.randint(2, 8))) for _ in range(2000)]
    clean = [" ".join(rng.choices(words, k=rng.randint(40, 300))) for _ in range(400)]
    junk = [" | ".join(rng.choices(words, k=60)) + " ### $$$" for _ in range(100)]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(clean + junk)]
    kept = {r["doc_id"] for r in dicts(outliers.judged(spark.createDataFrame(rows, SCHEMA))) if r["kept"]}
    assert kept == set(range(400))


def test_each_statistic_alone_can_reject(spark):
    """Junk of one kind each, under the base rules' limits, among clean texts; a
    few of those have one line twice."""
    rng = random.Random(20)
    word = lambda low=2, high=8: "".join(rng.choices("abcdefghijklmnopqrst", k=rng.randint(low, high)))
    line = lambda n, *size: " ".join(word(*size) for _ in range(n))
    lines = lambda n: [line(rng.randint(10, 14)) for _ in range(n)]
    clean = ["\n".join(lines(rng.randint(8, 16))) for _ in range(400)]
    clean += ["\n".join([f"{(once := line(7))}", *lines(14), once]) for _ in range(20)]
    phrase = lambda: line(13)
    junk = {
        "lines": ["\n".join(f"{line(9)}\nok" for _ in range(12)) for _ in range(20)],
        "words": [f"{line(30)} {(p := phrase())} {line(30)} {p} {line(20)}" for _ in range(20)],
        "symbols": ["\n".join(" ".join(f"{w}|" if i % 4 == 0 else w for i, w in enumerate(x.split())) for x in lines(10)) for _ in range(20)],
        "length": ["\n".join(line(12, 6, 12) for _ in range(10)) for _ in range(20)],
    }
    texts = [("clean", x) for x in clean] + [(kind, x) for kind, found in junk.items() for x in found]
    rows = [(i, x, "en", "s", 0) for i, (_, x) in enumerate(texts)]
    found = dicts(outliers.judged(spark.createDataFrame(rows, SCHEMA)))
    assert not any(r["base_failed"] for r in found)
    rejected = collections.Counter(texts[r["doc_id"]][0] for r in found if not r["kept"])
    assert rejected == dict.fromkeys(junk, 20)


def test_estimate_ignores_what_is_far(spark):
    """The centre and spread of the estimate are those of the clean part."""
    rng = np.random.default_rng(3)
    points = rng.normal(0, 1, (3000, 4)) * [0.2, 1, 1, 1]
    rows = [(int(1000 * math.exp(1.5 + a)), 1000, 10) for a, *_ in points] + [(100_000, 1000, 10)] * 700
    s = F.struct(
        F.lit(1000).cast("bigint").alias("n_words"), F.col("w").alias("word_chars"), F.lit(0).alias("n_symbols"),
        F.lit(10).alias("n_lines"), F.lit(0).alias("n_dup_lines"), F.lit(0).alias("n_repeat_words"),
    )
    df = spark.createDataFrame(rows, "w bigint, a bigint, b bigint").select(F.lit("en").alias("lang"), F.lit("x").alias("source"), s.alias("s"))
    found = outliers.estimates(stored(df, "points")).first().e
    assert abs(found.m0 - 1.5) < 0.03 and 0.1 < found.l00 < 0.35


# 9


def test_model_encodes_like_the_ranks(docs, rows, empty):
    reference = separators.encoding(RANKS, PATTERN)
    found = [tuple(r) for r in byte_bpe.round_trip(docs, RANKS, PATTERN).collect()]
    want = []
    for doc_id, text, *_ in rows:
        ids = reference.encode_ordinary(text or "")
        digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        want.append((doc_id, len(ids), digest, hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(str, found)) == sorted(map(str, want))
    assert byte_bpe.round_trip(empty, RANKS, PATTERN).count() == 0
    encoded = byte_bpe.with_ids(docs, RANKS, PATTERN)
    assert encoded.columns == [*docs.columns, "token_ids", "n_tokens"]
    back = encoded.select("text", byte_bpe.decode_column(F.col("token_ids"), RANKS, PATTERN).alias("back"))
    assert all(bytes(r.back).decode() == (r.text or "") for r in back.collect())


def test_model_on_random_bytes():
    rng, codec = random.Random(14), byte_bpe.codec(RANKS, PATTERN)
    reference = separators.encoding(RANKS, PATTERN)
    alphabet = [" ", "  ", "\n", "the", "ing", "'ll", "é", "漢字", "🙂", "\x00", "\x7f", "123", "zz", "a" * 50, "▁", "Ġ"]
    for _ in range(2000):
        text = "".join(rng.choices(alphabet, k=rng.randint(0, 20)))
        ids = codec.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


def test_very_long_texts_are_encoded_in_parts():
    rng, codec = random.Random(17), byte_bpe.codec(RANKS, PATTERN)
    text = "".join(rng.choices(["word", " ", " ", "é", ".", "\n", "it's", "12"], k=4000))
    parts = list(codec._parts(text, 50))
    assert "".join(parts) == text and len(parts) > 20
    assert b"".join(map(codec._encode, parts)) == codec._encode(text)
    assert list(codec._parts("x" * 500, 50)) == ["x" * 500] and list(codec._parts("", 50)) == [""]


def test_byte_characters():
    characters = byte_bpe.byte_characters()
    assert len(set(characters)) == 256 and all(c.isprintable() and not c.isspace() for c in characters)
    assert byte_bpe.unmapped(byte_bpe.mapped(bytes(range(256)))) == bytes(range(256))


# 10


def test_chunks_resist_insertions():
    rng = random.Random(15)
    text = " ".join("".join(rng.choices("abcdefgh", k=rng.randint(1, 8))) for _ in range(500)).encode()
    cut = lambda data: {data[a:b].strip() for a, b in itertools.pairwise([0, *chunks.cuts(data, chunks.Chunking())])}
    whole, shifted = cut(text), cut(b"some words put in front " + text[:1500] + b" and more " + text[1500:])
    assert len(whole & shifted) > 0.9 * len(whole)
    for data in (b"", b"x", b" ", b"x" * 9000, b"a " * 9000):
        ends = chunks.cuts(data, chunks.Chunking()).tolist()
        assert ends == sorted(set(ends)) and (not data or ends[-1] == len(data))


def test_chunks_go_from_cut_to_cut():
    """A chunk is the same wherever its words stand, and both ends are cuts."""
    rng, chunking = random.Random(16), chunks.Chunking()
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(1, 8))) for _ in range(600)]
    text = " ".join(words).encode()
    spans = lambda data: list(zip(*(x.tolist() for x in chunks.anchors(data, chunking))))
    lengths = [len(text[a:b].split()) for a, b in spans(text)]
    assert min(lengths) >= chunking.run_words and len(set(lengths)) > 5
    cuts = {0, *chunks.cuts(text, chunking).tolist()}
    assert all(a in cuts and (b + 1 in cuts or b == len(text)) for a, b in spans(text))
    moved = b"in front " + text[:2000] + b" between " + text[2000:]
    whole, other = ({data[a:b] for a, b in spans(data)} for data in (text, moved))
    assert len(whole & other) > 0.85 * len(whole)


def test_texts_without_blanks_have_words():
    assert chunks.words_in("漢字kana、ไทย x;y{z} a;".encode()) == [x.encode() for x in "漢|字|kana|、|ไ|ท|ย|x;|y{|z}|a;".split("|")]
    rng = random.Random(17)
    for _ in range(300):  # a part of a text has the words of the whole
        data = "".join(rng.choices("a b;{漢字ไé🙂\n", k=30)).encode()
        starts, ends = chunks.words_at(data)
        i, j = sorted(rng.choices(range(len(starts)), k=2)) if len(starts) else (0, -1)
        assert chunks.words_in(data[starts[i] : ends[j]] if len(starts) else b"") == [data[a:b] for a, b in zip(starts[i : j + 1], ends[i : j + 1])]


@pytest.mark.parametrize("kind", ["han", "thai", "code"])
def test_passages_of_texts_without_blanks(spark, kind):
    rng = random.Random(18)
    letter = {"han": range(0x4E00, 0x9F00), "thai": range(0xE01, 0xE2F), "code": range(97, 123)}[kind]
    unit = lambda: "".join(chr(rng.choice(letter)) for _ in range(1 if kind != "code" else 9)) + (";" if kind == "code" else "")
    text = lambda n: "".join(unit() for _ in range(n))
    passage = text(80)
    rows = [(1, text(60) + passage + text(60), None, None, 0), (2, text(90) + passage + text(40), None, None, 0), (3, text(300), None, None, 0)]
    found = dicts(chunks.shared_passages(spark.createDataFrame(rows, SCHEMA)))
    assert [(r["doc_id"], r["first_doc_id"]) for r in found] == [(2, 1)] and abs(found[0]["n_words"] - 80) <= 2
    left = {r.doc_id: r.text for r in chunks.without_passages(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(left[2]) < len(rows[1][1]) - 0.9 * len(passage) and left[3] == rows[2][1]


def test_passages_are_found_and_removed(docs, rows, empty):
    found = dicts(chunks.shared_passages(docs))
    assert {(r["doc_id"], r["first_doc_id"]) for r in found} == {(10, 9), *((i, 0) for i in range(30, 35))}
    (ten,) = [r for r in found if r["doc_id"] == 10]
    left = chunks.without_passages(docs)
    assert left.columns == docs.columns and left.count() == len(rows)
    texts = {r.doc_id: r for r in left.collect()}
    assert all(len(texts[i].text) < 0.1 * len(rows[0][1]) for i in range(30, 35)) and texts[0].text == rows[0][1]
    (whole,) = [r[1] for r in rows if r[0] == 10]
    span = whole.encode()[ten["start"] : ten["stop"]].decode()
    assert len(span.split()) >= 45 and span.strip() in rows[10][1]
    assert texts[10].text == whole.replace(span, "") and texts[10].n_chars == len(texts[10].text)
    assert chunks.shared_passages(empty).count() == 0 and chunks.without_passages(empty).count() == 0


def test_every_planted_passage_is_caught(spark):
    """Words of a small vocabulary, so that short chunks are shared by chance."""
    rng = random.Random(16)
    common = ["the", "of", "and", "to", "in", "a", "is", "that"]
    words = ["".join(rng.choices("abcdefghijklmnopqrst", k=rng.randint(2, 9))) for _ in range(3000)]
    text = lambda n: " ".join(rng.choice(common if rng.random() < 0.45 else words) for _ in range(n))
    planted = [text(51 + i % 20) for i in range(300)]
    rows = [(i, f"{text(20)} {p} {text(20)}", None, None, 0) for i, p in enumerate(planted)]
    rows += [(1000 + i, f"{text(35)}\n{p} {text(9)}", None, None, 0) for i, p in enumerate(planted)]
    rows += [(5000 + i, text(500), None, None, 0) for i in range(400)]
    found = {(r["doc_id"], r["first_doc_id"]) for r in dicts(chunks.shared_passages(spark.createDataFrame(rows, SCHEMA)))}
    assert {i for i, _ in found} <= set(range(1000, 1300))
    assert len(found & {(1000 + i, i) for i in range(300)}) >= 295


def test_passages_of_several_documents_side_by_side(spark):
    """Each of three adjacent passages, and both halves of one that an earlier
    document holds half of, are reported and removed."""
    rng = random.Random(18)
    words = ["".join(rng.choices("abcdefghijklmnopqrst", k=rng.randint(3, 9))) for _ in range(5000)]
    text = lambda n: " ".join(rng.choices(words, k=n))
    rows, want, whole = [], set(), {}
    for i in range(0, 200, 10):
        a, b, c, halves = text(70), text(70), text(70), text(140)
        front, end = text(20), text(20)
        rows += [(i + k, f"{text(30)} {p} {text(30)}", None, None, 0) for k, p in enumerate((a, b, c))]
        rows += [(i + 3, f"{text(30)} {' '.join(halves.split()[:70])}", None, None, 0), (i + 4, f"{halves} {text(30)}", None, None, 0)]
        rows += [(1000 + i, f"{front} {a} {b} {c} {end}", None, None, 0), (1001 + i, f"{front[::-1]} {halves} {end[::-1]}", None, None, 0)]
        want |= {(1000 + i, i), (1000 + i, i + 1), (1000 + i, i + 2), (1001 + i, i + 3), (1001 + i, i + 4), (i + 4, i + 3)}
        whole |= {1000 + i: f"{front} {end}", 1001 + i: f"{front[::-1]} {end[::-1]}"}
    df = stored(spark.createDataFrame(rows, SCHEMA), "adjacent")
    assert {(r["doc_id"], r["first_doc_id"]) for r in dicts(chunks.shared_passages(df))} == want
    left = {r.doc_id: r.text.split() for r in chunks.without_passages(df).collect()}
    for i, clean in whole.items():
        assert left[i] == clean.split()


@pytest.mark.parametrize("letters, size", [("abcdefghijklmnopqrst", 5), ("абвгдежзиклмнопр", 6), ("абвгдежзиклмнопр", 8)])
def test_whole_passages_of_51_words_are_found(spark, letters, size):
    """Words of 6, 13 and 17 bytes; earlier documents hold phrases of them, and
    so the least id of many chunks is not that of the passage's first document."""
    rng = random.Random(19)
    words = ["".join(rng.choices(letters, k=size)) for _ in range(20_000)]
    text = lambda n: " ".join(rng.choices(words, k=n))
    planted = [text(51) for _ in range(1500)]
    rows, clean = [], {}
    for i, p in enumerate(planted):
        w, at = p.split(), 0
        while at < 51:  # two phrases of five have an earlier document
            n = rng.randint(5, 10)
            if rng.random() < 0.4:
                rows.append((-1 - len(rows), f"{text(9)} {' '.join(w[at : at + n])} {text(9)}", None, None, 0))
            at += n
        clean[10_000 + i] = f"{text(35)}\n{text(9)}"
        rows.append((i, f"{text(20)} {p} {text(20)}", None, None, 0))
        rows.append((10_000 + i, clean[10_000 + i].replace("\n", f"\n{p} "), None, None, 0))
    df = stored(spark.createDataFrame(rows, SCHEMA), "recall")
    found = dicts(chunks.shared_passages(df))
    got, want = {(r["doc_id"], r["first_doc_id"]) for r in found}, {(10_000 + i, i) for i in range(1500)}
    assert got <= want and len(want - got) <= 2  # 1 in 4,000 has no chunk, as the operator states
    assert sum(r["n_words"] == 51 for r in found) >= 1495
    left = {r.doc_id: r.text for r in chunks.without_passages(df).collect()}
    assert sum(left[i] == x for i, x in clean.items()) >= 1495


def test_a_passage_ends_where_the_texts_differ():
    data = b" one two  three four\nfive six seven eight "
    span = {"start": data.index(b"three"), "stop": data.index(b"\n"), "chunks": 1, "first_id": 3}
    cut = lambda before, behind, **x: [data[a:b] for a, b, *_ in chunks.widened(data, [{**span, "before": before, "behind": behind, **x}])]
    assert cut(b"", b"") == [b"three four\n"] and cut(b"x two", b"five x seven") == [b"two  three four\nfive "]
    assert cut(b"zero one two", b"five six seven eight nine") == [data[1:]]
    both = [{**span, "before": b"two", "behind": b"x"}, {**span, "first_id": 2, "before": b"x", "behind": b"five"}]
    assert [(n, first) for _, _, n, _, first in chunks.widened(data, both)] == [(3, 2), (3, 3)]


# Queries


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    assert compare(entry.queries()[name](spark, SF), sql_session(SF), SQL[name]) is None


def test_every_operator_is_registered():
    names = [name for name in entry.queries() if name.startswith("op")]
    assert {int(re.match(r"op(\d+)_", name)[1]) for name in names if re.match(r"op\d+_", name)} == set(range(1, 11))


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, docs, SF), "stage")
        assert after.columns[: len(docs.columns)] == docs.columns and after.count() > 0
        if name != "encoding":
            assert after.columns == docs.columns
        docs = after
    whole = entry.queries()["pipeline"](spark, SF)
    assert whole.count() == docs.count()
    codec = byte_bpe.codec(RANKS, PATTERN)
    assert all(codec.decode(bytes(r.token_ids)).decode() == r.text for r in whole.collect())
