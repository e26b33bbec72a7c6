import math
import re
from collections import Counter

from tests.llm.conftest import ODD_TEXTS, SMALL
from tillwork.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute_terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, limit=20):
    counts = [(i, Counter(brute_terms(t))) for i, t in docs]
    held = [c for _, c in counts if c]
    total = sum(c.total() for c in held)
    out = []
    for item, text in items:
        scores = []
        for doc, c in counts:
            s = 0
            for term, times in Counter(brute_terms(text)).items():
                if c[term]:
                    df = sum(term in h for h in held)
                    w = math.floor(1000 * math.log((2 * len(held) + 2) / (2 * df + 1)))
                    m = 100 - 25 + (25 * c.total() * len(held)) // total
                    s += times * w * ((1000000000 * c[term]) // (1000 * c[term] + 12 * m))
            if s > 0:
                scores.append((-s, doc is not None, doc))
        out += [(item, k + 1, d, -s) for k, (s, _, d) in enumerate(sorted(scores)[:limit])]
    return sorted(out)


def found(docs, items, **args):
    return sorted(tuple(r) for r in lexical.rank(docs, items, **args).collect())


def test_documents(spark, documents):
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    few = items.filter("item_id < 6")
    assert found(documents, few) == brute(
        [(r.doc_id, r.text) for r in documents.collect()], [(r.item_id, r.text) for r in few.collect()])


def test_odd_texts(spark, make):
    items = [(1, "one TWO, one same"), (2, None), (3, ""), (4, "日本語 é w"), (5, "w w twice ퟿"), (6, "nowhere")]
    texts = [*ODD_TEXTS, "K Ä ä", "9one one_two one-two-ONE"]
    for block_bytes in (lexical.BLOCK_BYTES, 8):
        got = found(make(texts), spark.createDataFrame(items, "item_id long, text string"), block_bytes=block_bytes)
        assert got == brute(list(enumerate(texts)), items)


def test_ties_limits_and_repeated_rows(spark, make):
    texts = ["a b c"] * 30 + ["a", "x y"]
    items = [(7, "a a c"), (7, "a a c"), (8, "x")]
    ids = [*range(28, -2, -1)][:30] + [40, 41]
    docs = make(texts, ids)
    got = found(docs, spark.createDataFrame(items, "item_id long, text string"), limit=5)
    assert got == brute(list(zip(ids, texts)), items[1:], 5)
    twice = docs.unionByName(docs)
    assert found(twice, spark.createDataFrame(items, "item_id long, text string"), limit=5) == brute(
        list(zip(ids, texts)) * 2, items[1:], 5)


def test_null_ids_and_text_items(spark, make):
    docs = make(["red fish", "red fish", "blue"], [None, 3, 1])
    items = spark.createDataFrame([("q", "red fish"), (None, "blue")], "item_id string, text string")
    assert sorted(map(str, map(tuple, lexical.rank(docs, items).collect()))) == sorted(
        map(str, brute([(None, "red fish"), (3, "red fish"), (1, "blue")], [("q", "red fish")])
            + [(None, 1, 1, brute([(0, "red fish"), (3, "red fish"), (1, "blue")], [("x", "blue")])[0][3])]))


def test_best_is_cut_while_scores_arrive(monkeypatch):
    monkeypatch.setattr(lexical, "HELD", 10)
    import numpy as np
    best, rows = lexical.Best(3, 4), []
    rng = np.random.default_rng(5)
    for doc in rng.permutation(200):
        scores = rng.integers(0, 6, 3)
        best.add(int(doc), scores)
        rows += [(i, -int(s), int(doc)) for i, s in enumerate(scores) if s > 0]
    item, score, doc, _ = best.cut()
    expected = [r for i in range(3) for r in sorted(x for x in rows if x[0] == i)[:4]]
    assert list(zip(item.tolist(), (-score).tolist(), doc.tolist())) == expected


def test_empty(spark, make):
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.rank(make([]).limit(0), items).count() == 0
    assert lexical.rank(make(["a"]), items.limit(0)).count() == 0
    assert lexical.rank(make([None, "."]), items).count() == 0
