"""SimHash near-duplicates by a grid join over segment bit counts.

A fingerprint is cut into equal segments and mapped to the number of set bits in each. Two
fingerprints that differ in *d* bits have count vectors at most *d* apart in Manhattan
distance, so vectors further apart need no look at the bits. Vectors within
distance *r* have a grid point at most ``ceil(r / 2)`` from both: each distinct fingerprint is
placed at all such points, fingerprints that share a point are candidates, and their
bits decide. No vector is compared outside its points, and every pair within the radius is found.

Copies count once: only distinct fingerprints are placed, each can link to no more others than
lie within the radius, and documents get their class by a join on the fingerprint.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tillwork import session
from tillwork.llm.common import slices
from tillwork.llm.components import components

SHINGLE_WORDS = 3
MAX_BITS = 2
#: Segments of a fingerprint. More of them leave fewer candidates and place more points.
SEGMENTS = 16
_CHUNK = 1 << 16


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """64 bits, each set if it is set in over half of the shingles' hashes; no words give zero."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return 0
    line = b" ".join(w)
    ends = (np.cumsum([len(x) + 1 for x in w]) - 1).tolist()
    starts = [0, *[e + 1 for e in ends[:-1]]]
    n = max(1, len(w) - words + 1)
    ends = ends[words - 1:] or [len(line)]
    digest = xxhash.xxh64_intdigest
    bits = np.zeros(64, np.int64)
    for at in range(0, n, _CHUNK):
        h = np.array([digest(line[s:e], 42) for s, e in zip(starts[at:at + _CHUNK], ends[at:at + _CHUNK])],
                     "<u8")
        bits += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id`` and ``bits``, the fingerprint as a signed long, of each row."""
    def of(batches):
        for batch, texts in slices(batches):
            bits = np.array([fingerprint(t, words) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits)], ["doc_id", "bits"])

    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return narrow.mapInArrow(of, "doc_id long, bits long")


def count_vector(bits: Column, segments: int = SEGMENTS) -> Column:
    """The segments' bit counts side by side in one long."""
    wide = 64 // segments
    field = wide.bit_length()
    out = F.lit(0).cast("long")
    for i in range(segments):
        part = F.shiftrightunsigned(bits, wide * i).bitwiseAND(F.lit((1 << wide) - 1).cast("long"))
        out = out.bitwiseOR(F.shiftleft(F.bit_count(part).cast("long"), field * i))
    return out


def _neighbours(point: Column, segments: int) -> Column:
    """The grid points one step away and the point itself; null where a step would leave the grid."""
    wide = 64 // segments
    field = wide.bit_length()
    found = [point]
    for i in range(segments):
        mask = (1 << field) - 1
        value = F.shiftrightunsigned(point, field * i).bitwiseAND(F.lit(mask).cast("long"))
        rest = point.bitwiseAND(F.bitwise_not(F.shiftleft(F.lit(mask).cast("long"), field * i)))
        up = rest.bitwiseOR(F.shiftleft(value + 1, field * i))
        down = rest.bitwiseOR(F.shiftleft(value - 1, field * i))
        found += [F.when(value < wide, up), F.when(value > 0, down)]
    return F.array(*found)


def near_pairs(distinct: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS) -> DataFrame:
    """Links ``a``, ``b`` between the ``node`` of distinct ``bits`` that differ in 1 to ``max_bits`` bits."""
    points = distinct.select("node", "bits", count_vector(F.col("bits"), segments).alias("point"))
    for step in range((max_bits + 1) // 2):
        points = points.select("node", "bits", F.explode(
            _neighbours(F.col("point"), segments)).alias("point")).filter("point is not null")
        if step:
            points = points.distinct()
    left = points.select(F.col("node").alias("a"), F.col("bits").alias("a_bits"), "point")
    right = points.select(F.col("node").alias("b"), F.col("bits").alias("b_bits"), "point")
    differing = F.bit_count(F.col("a_bits").bitwiseXOR(F.col("b_bits")))
    same_point = left.point == right.point
    # Spark takes the points for as small as the fingerprints, so it would broadcast many times what it allows
    return (left.join(right.hint("merge"), same_point & (F.col("a_bits") < F.col("b_bits")) & (differing <= max_bits))
            .select("a", "b").distinct())


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                    segments: int = SEGMENTS) -> DataFrame:
    """``doc_id``, ``fingerprint`` and ``component_id`` (the smallest doc_id it is linked to) per row.

    Null and empty texts have fingerprint zero and are linked as any other. A row
    without doc_id gets its fingerprint's class but links nothing by itself. Repeated rows come
    back as often as they occur; an empty table gives none.
    """
    rows = session.materialise(fingerprints(docs, words))
    distinct = session.materialise(
        rows.groupBy("bits").agg(F.min("doc_id").alias("node")).filter("node is not null"))
    roots = components(near_pairs(distinct, max_bits, segments))
    classes = distinct.join(roots, "node", "left").select(
        "bits", F.coalesce("root", "node").alias("component_id"))
    return rows.join(classes, "bits", "left").select(
        "doc_id", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` but for near-duplicates of a row with a smaller doc_id.

    Of rows with the same doc_id one stays; rows without doc_id all stay.
    """
    found = near_duplicates(docs, **options)
    first = found.filter("doc_id = component_id").select("doc_id").distinct()
    kept = docs.join(first, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return kept.unionByName(docs.filter(F.col("doc_id").isNull())).select(*docs.columns)
