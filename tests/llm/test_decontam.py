import random
import re
from collections import Counter

from pyspark.sql import functions as F

from tests.llm.conftest import ODD_TEXTS
from tillwork.llm import decontam


def brute_shingles(text):
    w = [x for x in re.split(r"[\W_]+", (text or "").lower()) if x]
    return [tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))] if w else []


def brute(docs, items):
    """Best weighted similarity of every item-sized window."""
    out = {}
    for d, text in docs:
        s = brute_shingles(text)
        for i, item in items:
            t = Counter(brute_shingles(item))
            n = sum(t.values())
            for start in range(max(1, len(s) - n + 1)):
                w = Counter(s[start:start + n])
                shared = sum((t & w).values())
                if n and s and shared / (n + sum(w.values()) - shared) >= 0.8 - 1e-12:
                    best = shared / (n + sum(w.values()) - shared)
                    out[d, i] = max(out.get((d, i), 0), best)
    return out


def test_equals_brute_force(spark, make):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(3))
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate([60, 60, 45, 30, 30, 12, 4])] + [(7, "a b a b a b a b a b a b")]
    docs = []
    for _, item in items:
        w = item.split()
        docs += [item, f"{text(20)} {item} {text(15)}", f"{text(9)} {item.upper().replace(' ', ', ')}! {text(5)}",
                 " ".join(w[:-4]) + " " + text(30), text(7) + " " + " ".join(w[2:])]
        changed = [*w[:len(w) // 2], word(), *w[len(w) // 2 + 1:]]
        docs += [" ".join(changed), text(10) + " " + " ".join([*w[:3], word(), *w[3:]]), " ".join(w[: len(w) // 2])]
    docs += [text(50) for _ in range(10)] + ODD_TEXTS + [f"{items[0][1]} {text(3)} {items[2][1]}"]
    rows = list(enumerate(docs))
    benchmark = spark.createDataFrame([*items, (8, None), (9, ""), (None, items[0][1])], "item_id long, text string")
    found = {(r.doc_id, r.item_id): r.similarity for r in decontam.contaminated(make(docs), benchmark).collect()}
    expected = brute(rows, items)
    assert found.keys() == expected.keys()
    assert all(abs(found[k] - expected[k]) < 1e-9 for k in found)


def test_blocks_guarantee_the_radius(spark):
    rng = random.Random(5)
    pairs = []
    for _ in range(200):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), 19):
            b ^= 1 << bit
        pairs.append(tuple(x - (1 << 64) if x >> 63 else x for x in (a, b)))
    df = spark.createDataFrame(pairs, "a long, b long").select(
        F.arrays_overlap(decontam.blocks(F.col("a")), decontam.blocks(F.col("b"))).alias("meet"))
    assert all(r.meet for r in df.collect())


def test_simhash(spark):
    h = [1, -1, 5 << 40, 1 << 62, -(1 << 63), 12345678901234, 7]
    got = spark.createDataFrame([(h,)], "h array<bigint>").select(decontam.simhash(F.col("h")).alias("x")).first().x
    unsigned = [x % (1 << 64) for x in h]
    assert got % (1 << 64) == sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in unsigned) > len(h))


def test_clean_keeps_rows_and_columns(spark, make):
    leak = "one two three four five six seven eight nine ten"
    docs = make([leak, "nothing to see here at all my friend", None, leak], [1, 2, 3, None])
    benchmark = spark.createDataFrame([(0, leak)], "item_id long, text string")
    kept = decontam.clean(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [2, 3, None]
    assert decontam.clean(docs, benchmark.limit(0)).count() == 4
    assert decontam.contaminated(docs.limit(0), benchmark).count() == 0


def test_no_python_in_the_plan(spark, make):
    benchmark = spark.createDataFrame([(0, "a b c d e f")], "item_id long, text string")
    plan = decontam.contaminated(make(["a b c d e f"]), benchmark)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_wide_blocks_guarantee_the_radius_and_prune(spark):
    rng = random.Random(6)
    near, far = [], []
    for _ in range(200):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), 19):
            b ^= 1 << bit
        near.append((signed(a), signed(b)))
        far.append((signed(a), signed(rng.getrandbits(64))))
    meet = F.arrays_overlap(decontam.blocks(F.col("a"), decontam.BLOCKS), decontam.near_blocks(F.col("b")))
    met = [sum(r.meet for r in spark.createDataFrame(x, "a long, b long").select(meet.alias("meet")).collect())
           for x in (near, far)]
    assert met[0] == 200 and met[1] <= 70


def test_repeats_are_numbered_in_linear_time(spark):
    rng = random.Random(8)
    rows = [([rng.randrange(5) for _ in range(n)],) for n in (0, 1, 2, 30)] + [([7] * 100_000,)]
    got = spark.createDataFrame(rows, "h array<bigint>").select(decontam._as_set("h").alias("s"), "h").collect()
    for r in got:
        assert len(r.s) == len(set(r.s)) == len(r.h) and set(r.h) <= set(r.s)


def test_long_repetitive_items(spark, make):
    words = "same " * 70_003
    benchmark = spark.createDataFrame([(0, words)], "item_id long, text string")
    found = decontam.contaminated(make([words, "same " * 60_000, "same " * 50_000]), benchmark).collect()
    assert {(r.doc_id, round(r.similarity, 6), r.differing_bits) for r in found} == {
        (0, 1.0, 0), (1, round(59_996 / 69_999, 6), 0)}
