import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import ODD_TEXTS
from tillwork.llm import sharding


def check(docs, shards=16, law="rows"):
    given = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    found = sharding.shard(docs, shards, law).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in found) == Counter(
        (i, len(t) + 1, zlib.crc32(t)) for i, t in given)
    slots = defaultdict(list)
    for r in found:
        assert r.law == law and 0 <= r.shard < shards and r.grown_shard is None
        slots[r.shard].append((r.slot, r.doc_id))
    for members in slots.values():
        assert sorted(s for s, _ in members) == list(range(len(members)))
        ids = [i for _, i in sorted(members)]
        assert ids == sorted(ids, key=lambda i: (i is not None, i))
    return found


def even(found, shards=16):
    counts = Counter(r.shard for r in found)
    return max(counts.values()) - min(counts[s] for s in range(shards)) <= 1


def groups(found):
    """Shards of each text that several documents have."""
    by = defaultdict(Counter)
    for r in found:
        by[r["size"], r.text_crc32][r.shard] += 1
    return [c for c in by.values() if c.total() > 1]


def test_documents(documents):
    found = check(documents)
    assert even(found) and all(len(c) == 1 for c in groups(found))


def test_groups_stay_together_where_they_fit(make):
    texts = [f"alone {i}" for i in range(150)]
    for g in range(40):
        texts += [f"group {g}"] * (2 + g % 4)
    found = check(make(texts), 8)
    assert even(found, 8)
    assert sum(len(c) == 1 for c in groups(found)) >= 38


def test_a_group_larger_than_a_shard_fills_whole_shards(make):
    found = check(make(["hot"] * 100 + [f"t {i}" for i in range(200)]), 10)
    assert even(found, 10)
    assert len(groups(found)[0]) <= 5


def test_all_linked_in_pairs(make):
    found = check(make([f"pair {i // 2}" for i in range(400)]), 4)
    assert even(found, 4)
    assert sum(len(c) == 1 for c in groups(found)) >= 180


def test_bytes_are_near_equal(make):
    texts = ["word " * (1 + i % 50) for i in range(500)] + ["same text"] * 90
    sizes = Counter()
    for r in check(make(texts), 8, "bytes"):
        sizes[r.shard] += r["size"]
    assert max(sizes.values()) - min(sizes.values()) <= 2 * 256


def test_odd_texts(make):
    docs = make(ODD_TEXTS + ["again"] * 3, [None, None, *range(len(ODD_TEXTS) - 1), 5][:len(ODD_TEXTS) + 3])
    assert even(check(docs))
    assert even(check(docs, 2), 2)


def test_empty(make):
    assert sharding.shard(make([]).limit(0)).count() == 0
    assert sharding.shard(make(["one"])).first().slot == 0


def test_unknown_law(make):
    with pytest.raises(ValueError):
        sharding.shard(make(["x"]), law="some")


def test_links_by_several_keys(spark):
    """Rings of ten whose neighbours share a key each: propagation cuts few of their links."""
    rings = 60
    nodes = spark.range(rings * 10).select(F.col("id").alias("node"), F.lit(1).cast("long").alias("weight"))
    links = spark.createDataFrame(
        [(r * 10 + (i + d) % 10, r * 10 + i) for r in range(rings) for i in range(10) for d in (0, 1)],
        "node long, key long")
    start = nodes.select("node", F.pmod(F.xxhash64("node"), F.lit(4)).alias("shard"))
    placed = sharding.balanced(nodes, links, 4).cache()
    counts = [r["count"] for r in placed.groupBy("shard").count().collect()]
    assert len(counts) == 4 and max(counts) - min(counts) <= 1 and sum(counts) == 600
    first, then = sharding.cut_links(start, links).first(), sharding.cut_links(placed, links).first()
    assert first.pairs == then.pairs == 600 and then.cut < 0.5 * first.cut
