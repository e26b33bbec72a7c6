from collections import defaultdict

import xxhash

from tests.llm.conftest import ODD_TEXTS
from tillwork.llm import simhash
from tillwork.llm.components import components


def brute_fingerprint(text):
    import re
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_classes(rows, radius=2):
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in rows:
        for j, b in rows:
            if i < j and (a ^ b).bit_count() <= radius:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: find(i) for i, _ in rows}


def check(docs, texts):
    prints = [(i, brute_fingerprint(t)) for i, t in texts]
    classes = brute_classes(prints)
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert found == {i: (f"{p:016x}", classes[i]) for i, p in prints}


def test_documents(documents):
    check(documents, [(r.doc_id, r.text) for r in documents.collect()])


def test_odd_texts(make):
    check(make(ODD_TEXTS), list(enumerate(ODD_TEXTS)))


def test_spark_hash_is_the_same(spark):
    row = spark.sql("select xxhash64('one two three') as h").first()
    assert row.h & (1 << 64) - 1 == xxhash.xxh64_intdigest(b"one two three", 42)


def test_pairs_within_radius(spark):
    base = 0x0F3C55AA00FF1234
    flips = [0, 1, 3, 1 << 63, 1 << 63 | 1, 0b101 << 20, 0b111 << 40, 0b1111 << 8]
    values = sorted({base ^ f for f in flips} | {0, 1, (1 << 64) - 1})
    rows = [(i, v - (1 << 64) if v >> 63 else v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "node long, bits long")
    for radius, segments in ((2, 16), (1, 8), (4, 32)):
        found = {tuple(sorted(r)) for r in simhash.near_pairs(df, radius, segments).collect()}
        assert found == {(i, j) for i, a in enumerate(values) for j, b in enumerate(values)
                         if i < j and (a ^ b).bit_count() <= radius}


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 50), (100, 60), (60, 70), (200, 200)]
    found = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, 50: 50, 60: 50, 70: 50, 100: 50}


def test_keep_one(make):
    texts = ["one two three four", "other words stand here", "one two three four", None, "", "x"]
    docs = make(texts, [5, 2, 1, 7, 9, None])
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [1, 2, 7, None]
    assert simhash.keep_one(docs.limit(0)).count() == 0
    assert simhash.keep_one(make(["a b c"] * 3, [4, 4, 4])).count() == 1


def test_many_copies(make):
    by_class = defaultdict(int)
    for r in simhash.near_duplicates(make(["a b c d"] * 500 + ["e f g h"])).collect():
        by_class[r.component_id] += 1
    assert by_class == {0: 500, 500: 1}


def test_exploded_points_are_not_broadcast(spark):
    # 33 points a fingerprint, which Spark sizes as the fingerprint alone
    pairs = simhash.near_pairs(spark.range(2).selectExpr("id as node", "id as bits"))
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "SortMergeJoin" in plan
