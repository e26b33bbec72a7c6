"""Benchmark decontamination by SimHash of item-sized windows, DataFrame functions only.

Texts are lower-case words (runs of letters and digits) and their shingles of five words; a shorter
text is one shingle. A document's windows have as many shingles as a benchmark item; each
window gets a SimHash. Fingerprints are cut into a few wide blocks. Two within the radius differ
by at most the radius over the number of blocks in one of them (else the blocks' differences would add up to more), so
items are indexed with every block value that near, and windows meet items of their size by a join
on size, block and its bits; the bits decide. Candidates are verified by exact weighted
similarity: the sum of smaller over the sum of larger shingle counts, at least ``SIMILARITY``.
Two unrelated fingerprints meet with a chance of a quarter; more blocks would be agreed in by nearly all, fewer take
many more values for each item (1,811 now).

Only windows that can reach that similarity are fingerprinted. They hold shingles of the
benchmark at so many places at least, and moving one on to the first such place loses none, so
windows begin there (or end with the document). Equal windows of different documents are
fingerprinted and verified once.

Null and empty texts have no shingles and match nothing, neither do rows without doc_id
or item_id; repeated rows give one result per id; an empty table on either side gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillwork import session

SHINGLE_WORDS = 5
SIMILARITY = 0.8
#: Bits that fingerprints of a window and an item may differ in.
RADIUS = 19
#: Blocks of a fingerprint in the index.
BLOCKS = 5


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def shingles(word: Column) -> Column:
    """64-bit hashes of all shingles in order."""
    last = F.greatest(F.size(word) - SHINGLE_WORDS, F.lit(0))
    one = lambda i: F.xxhash64(*[F.get(word, i + k) for k in range(SHINGLE_WORDS)])
    return F.when(F.size(word) > 0, F.transform(F.sequence(F.lit(0), last), one)) \
        .otherwise(F.array().cast("array<bigint>"))


def _once(value: Column, then) -> Column:
    """``then(value)`` with ``value`` computed once however often it is used."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _shingled(df: DataFrame, key: str) -> DataFrame:
    known = df.filter(F.col(key).isNotNull() & F.col("text").isNotNull())
    return known.select(F.col(key).cast("long").alias(key),
                        _once(words(F.col("text").cast("string")), shingles).alias("h"))


def _majority(h: Column, lanes: int) -> Column:
    """Bits set in over half of the hashes, from ``lanes`` sums that hold ``64 / lanes`` counts each."""
    width = lanes  # bits of a count
    ones = sum(1 << at for at in range(0, 64, width))
    mask, zero = F.lit(ones), F.lit(0).cast("bigint")
    right = lambda x, n: F.call_function("shiftrightunsigned", x, n)
    numbers = F.sequence(F.lit(0), F.lit(lanes - 1))

    def add(sums: Column, x: Column) -> Column:
        return F.zip_with(sums, numbers, lambda s, k: s + right(x, k).bitwiseAND(mask))

    def bits(sums: Column) -> Column:
        def one(out: Column, bit: Column) -> Column:
            lane = F.get(sums, bit % lanes)
            count = right(lane, F.floor(bit / lanes).cast("int") * width) \
                .bitwiseAND(F.lit((1 << width) - 1).cast("bigint"))
            value = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)
            return out.bitwiseOR(F.when(2 * count > F.size(h), value).otherwise(zero))
        return F.aggregate(F.sequence(F.lit(0), F.lit(63)), zero, one)

    return F.aggregate(h, F.array_repeat(zero, lanes), add, bits)


def simhash(h: Column) -> Column:
    """64 bits, each set if it is set in over half of the hashes."""
    # sums are signed, so the uppermost count has a bit less
    return F.when(F.size(h) < 1 << 15, _majority(h, 16)).otherwise(_majority(h, 32))


def _edges(pieces: int) -> list[tuple[int, int]]:
    edges = [64 * i // pieces for i in range(pieces + 1)]
    return list(zip(edges, edges[1:]))


def _value(bits: Column, low: int, high: int) -> Column:
    return F.shiftrightunsigned(bits, low).bitwiseAND(F.lit((1 << high - low) - 1).cast("bigint"))


def blocks(bits: Column, pieces: int = RADIUS + 1) -> Column:
    """The fingerprint's blocks; two within a radius below ``pieces`` agree in one of them."""
    return F.array(*[F.struct(F.lit(i).alias("block"), _value(bits, *edge).alias("value"))
                     for i, edge in enumerate(_edges(pieces))])


def near_blocks(bits: Column, pieces: int = BLOCKS, radius: int = RADIUS) -> Column:
    """All block values so near that a fingerprint within the radius has one of them among its ``blocks``."""
    flips = radius // pieces

    def values(block: int, low: int, high: int) -> Column:
        masks = F.filter(F.sequence(F.lit(0).cast("bigint"), F.lit((1 << high - low) - 1).cast("bigint")),
                         lambda x: F.bit_count(x) <= flips)
        own = _value(bits, low, high)
        return F.transform(masks, lambda x: F.struct(F.lit(block).alias("block"), own.bitwiseXOR(x).alias("value")))

    return F.flatten(F.array(*[values(i, *edge) for i, edge in enumerate(_edges(pieces))]))


def _numbered(sorted_h: Column) -> Column:
    """Each hash once as it is, and its n-th repetition as a hash of both; in time linear in the array."""
    n = F.size(sorted_h)
    starts = F.filter(F.sequence(F.lit(0), n - 1),
                      lambda i: (i == 0) | (F.get(sorted_h, i) != F.get(sorted_h, i - 1)))

    def runs(start: Column) -> Column:
        ends = F.concat(F.slice(start, F.lit(2), F.size(start)), F.array(n))
        return F.flatten(F.zip_with(start, ends, lambda a, b: F.transform(
            F.sequence(F.lit(1), b - a), lambda nth: F.when(nth == 1, F.get(sorted_h, a))
            .otherwise(F.xxhash64(F.get(sorted_h, a), nth)))))

    return _once(starts, runs)


def _as_set(h: str) -> Column:
    """Hashes of (shingle, how often it has occurred so far), so that sets compare as counts do."""
    col = F.col(h)
    return F.when(F.size(F.array_distinct(col)) == F.size(col), col) \
        .otherwise(_once(F.array_sort(col), _numbered))


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY,
                 radius: int = RADIUS) -> DataFrame:
    """``doc_id``, ``item_id``, ``similarity``, ``start`` (first shingle) and ``differing_bits`` of the best window each."""
    items = _shingled(benchmark, "item_id").filter(F.size("h") > 0).distinct()
    items = session.materialise(items.select(
        "item_id", "h", F.size("h").alias("size"), simhash(F.col("h")).alias("bits")))
    need = F.greatest(F.lit(1), F.ceil(F.col("size") * similarity - 1e-9)).cast("int")
    known = session.materialise(items.select("size", F.explode("h").alias("shingle")).distinct())
    shingled = _shingled(docs, "doc_id")
    # places of a document that could belong to an item of each size; outer, or the filter that
    # Spark infers for an inner explode would hash every text twice
    places = shingled.select("doc_id", F.posexplode_outer("h").alias("at", "shingle")) \
        .join(known, "shingle") \
        .groupBy("doc_id", "size").agg(F.collect_set("at").alias("at")) \
        .filter(F.size("at") >= need) \
        .groupBy("doc_id").agg(F.collect_list(F.struct("size", F.sort_array("at").alias("at"))).alias("marks"))
    places = session.materialise(places)
    texts = docs.select("doc_id", "text").join(places.select("doc_id"), "doc_id", "left_semi")
    suspects = session.materialise(_shingled(texts, "doc_id").join(places, "doc_id"))

    full = lambda r: F.get("at", r + need - 1) < F.get("at", r) + F.col("size")
    clamp = lambda r: F.greatest(F.lit(0), F.least(F.get("at", r), F.col("n") - F.col("size")))
    starts = F.array_distinct(F.transform(F.filter(
        F.sequence(F.lit(0), F.size("at") - need), full), clamp))
    windows = suspects.select("doc_id", "h", F.size("h").alias("n"), F.explode("marks").alias("m")) \
        .select("doc_id", "h", "n", "m.size", "m.at") \
        .select("doc_id", "h", "size", F.explode(starts).alias("start")) \
        .select("doc_id", "size", "start", F.slice("h", F.col("start") + 1, F.col("size")).alias("h")) \
        .withColumn("window", F.xxhash64("h"))
    windows = session.materialise(windows)
    distinct = session.materialise(
        windows.groupBy("size", "window").agg(F.any_value("h").alias("h"))
        .withColumn("bits", simhash(F.col("h"))))
    probes = distinct.select("size", "window", "bits", F.explode(blocks(F.col("bits"), BLOCKS)).alias("b"))
    index = session.materialise(items.select(
        "item_id", "size", F.col("bits").alias("item_bits"),
        F.explode(near_blocks(F.col("bits"), BLOCKS, radius)).alias("b")))
    differing = F.bit_count(F.col("bits").bitwiseXOR(F.col("item_bits")))
    near = probes.join(index, ["size", "b"]) \
        .withColumn("differing_bits", differing).filter(F.col("differing_bits") <= radius) \
        .groupBy("size", "window", "item_id").agg(F.min("differing_bits").alias("differing_bits"))
    item_h = items.select("item_id", "size", F.col("h").alias("item_h"))
    pairs = near.join(distinct.select("size", "window", "h"), ["size", "window"]) \
        .join(item_h, ["item_id", "size"])
    total = F.size("h") + F.size("item_h")
    verified = pairs.withColumn("similarity", _once(
        F.size(F.array_intersect(_as_set("h"), _as_set("item_h"))), lambda x: x / (total - x))) \
        .filter(F.col("similarity") >= similarity) \
        .select("size", "window", "item_id", "similarity", "differing_bits")
    best = F.max(F.struct("similarity", (-F.col("start")).alias("back"), (-F.col("differing_bits")).alias("same")))
    return windows.select("doc_id", "size", "window", "start").join(verified, ["size", "window"]) \
        .groupBy("doc_id", "item_id").agg(best.alias("best")).select(
            "doc_id", "item_id", F.col("best.similarity").alias("similarity"),
            (-F.col("best.back")).cast("long").alias("start"),
            (-F.col("best.same")).cast("long").alias("differing_bits"))


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose document holds no benchmark item."""
    found = contaminated(docs, benchmark, **options).select("doc_id").distinct()
    return docs.join(session.materialise(found), "doc_id", "left_anti").select(*docs.columns)
