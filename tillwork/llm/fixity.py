"""Fixity audit of WARC replicas by Merkle trees over offset ranges.

Records have a file, an offset in it, and bytes. A leaf covers the records that begin in one range
of ``leaf_bytes`` of a file; its hash is over their offsets, lengths and record hashes in order. A node
covers ``fanout`` neighbouring children; levels go on over a file's ranges up to the
file's root, and over files in name order to the root of the collection. Replicas with the same root
are the same. Otherwise only children of differing nodes are compared, level by level, and records are
read again only in differing leaves.

Every group is bounded: a leaf by its bytes, a node by its fanout, so a file or replica of any
size is spread over all tasks. Trees are Parquet tables by level and can be kept from
audit to audit.

A null payload is an empty record, a null file name is a file of its own. Records at the same
offset count in the order of their hashes; repeated records are records. An empty replica has the root of
nothing, and every record of the other one is then missing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillwork import session
from tillwork.llm.common import running_total

LEAF_BYTES = 1 << 18
FANOUT = 16


def warc_record(url: Column, payload: Column, record_id: Column) -> Column:
    """The bytes of a WARC/1.1 resource record, the two line breaks behind it included."""
    body = F.coalesce(payload, F.lit("")).cast("binary")
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:sha1:"),
        F.sha1(F.concat_ws("|", record_id.cast("string"), url)), F.lit(">\r\nWARC-Target-URI: "),
        F.coalesce(url, F.lit("")), F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(head.cast("binary"), body, F.lit("\r\n\r\n").cast("binary"))


def laid_out(pages: DataFrame, record: Column, file: Column, order: list[str]) -> DataFrame:
    """``pages`` as records ``file``, ``offset``, ``length``, ``digest``: one behind the other in each file."""
    rows = pages.select(*order, file.alias("file"), record.alias("record")).select(
        *order, "file", F.octet_length("record").cast("long").alias("length"),
        F.sha2("record", 256).alias("digest"))
    placed = running_total(rows, ["file", *order, "digest"], "length", "at")
    begin = placed.groupBy("file").agg(F.min("at").alias("begin")).withColumnRenamed("file", "of")
    return placed.join(begin, F.col("file").eqNullSafe(F.col("of"))) \
        .select(*order, "file", (F.col("at") - F.col("begin")).alias("offset"), "length", "digest")


def _combined(rows: DataFrame, keys: list[str], place: list[str], digest: Column) -> DataFrame:
    parts = F.array_sort(F.collect_list(F.struct(*place, digest.alias("d"))))
    text = F.array_join(F.transform(parts, lambda p: F.concat_ws(
        ":", *[p[c].cast("string") for c in place], p["d"])), "\n")
    return rows.groupBy(*keys).agg(F.sha2(text, 256).alias("digest"))


class Tree:
    """The levels of a replica's tree, leaves first; each has ``file``, ``node`` and ``digest``.

    Levels within files come first, then levels over files, in which ``file`` is null.
    """

    def __init__(self, inside: list[DataFrame], over: list[DataFrame]) -> None:
        self.inside, self.over = inside, over

    def root(self) -> str | None:
        row = self.over[-1].first()
        return row.digest if row else None


def shape(records: list[DataFrame], leaf_bytes: int = LEAF_BYTES, fanout: int = FANOUT) -> tuple[int, int]:
    """Levels needed within a file and over files, for all replicas alike."""
    ends = [r.agg(F.max("offset").alias("o")).first().o or 0 for r in records]
    leaves, inside = max(ends) // leaf_bytes + 1, 1
    while fanout ** (inside - 1) < leaves:
        inside += 1
    names = records[0].select("file")
    for r in records[1:]:
        names = names.unionByName(r.select("file"))
    files, over = names.distinct().count(), 1
    while fanout ** over < files:
        over += 1
    return inside, over


def file_numbers(records: list[DataFrame]) -> DataFrame:
    """Every file of any replica with its number in name order."""
    names = records[0].select("file")
    for r in records[1:]:
        names = names.unionByName(r.select("file"))
    counted = running_total(names.distinct().withColumn("one", F.lit(1).cast("long")),
                            ["file"], "one", "number")
    return session.materialise(counted.select("file", "number"))


def build(records: DataFrame, numbers: DataFrame, levels: tuple[int, int],
          leaf_bytes: int = LEAF_BYTES, fanout: int = FANOUT) -> Tree:
    """The tree of one replica; ``numbers`` and ``levels`` are shared by the replicas compared."""
    leaf = F.floor(F.col("offset") / leaf_bytes).cast("long")
    level = session.materialise(_combined(
        records.withColumn("node", leaf), ["file", "node"], ["offset", "length"], F.col("digest")))
    inside = [level]
    for _ in range(levels[0] - 1):
        up = level.withColumnRenamed("node", "child") \
            .withColumn("node", F.floor(F.col("child") / fanout).cast("long"))
        level = session.materialise(_combined(up, ["file", "node"], ["child"], F.col("digest")))
        inside.append(level)
    of = numbers.select(F.col("file").alias("of"), F.col("number").alias("child"))
    level = level.join(of, F.col("file").eqNullSafe(F.col("of"))).select("child", "digest")
    over = []
    for _ in range(levels[1]):
        up = level.withColumn("node", F.floor(F.col("child") / fanout).cast("long"))
        level = session.materialise(_combined(up, ["node"], ["child"], F.col("digest")))
        over.append(level)
        level = level.withColumnRenamed("node", "child")
    return Tree(inside, over)


def _differing(one: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    a = one.select(*keys, F.col("digest").alias("a"), F.lit(None).cast("string").alias("b"))
    b = other.select(*keys, F.lit(None).cast("string").alias("a"), F.col("digest").alias("b"))
    return a.unionByName(b).groupBy(*keys).agg(F.max("a").alias("a"), F.max("b").alias("b")) \
        .filter(~F.col("a").eqNullSafe(F.col("b"))).select(*keys)


def _children(level: DataFrame, nodes: DataFrame, keys: list[str], fanout: int) -> DataFrame:
    """The rows of a level below the given nodes."""
    up = nodes.select(*[F.col(k).alias(f"up_{k}") for k in keys])
    joined = F.floor(F.col("node") / fanout).cast("long") == F.col("up_node")
    if "file" in keys:
        joined &= F.col("file").eqNullSafe(F.col("up_file"))
    return level.join(up, joined, "left_semi")


def differing_leaves(one: Tree, other: Tree, numbers: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """``file`` and ``node`` of the leaves that differ, found from the roots down."""
    nodes = _differing(one.over[-1], other.over[-1], ["node"])
    for a, b in zip(one.over[-2::-1], other.over[-2::-1]):
        nodes = session.materialise(nodes)
        nodes = _differing(_children(a, nodes, ["node"], fanout), _children(b, nodes, ["node"], fanout), ["node"])
    nodes = session.materialise(nodes)
    files = numbers.join(nodes.withColumnRenamed("node", "up_node"),
                         F.floor(F.col("number") / fanout).cast("long") == F.col("up_node"), "left_semi") \
        .select(F.col("file").alias("of"))
    same_file = F.col("file").eqNullSafe(F.col("of"))
    nodes = _differing(*[t.inside[-1].join(files, same_file, "left_semi") for t in (one, other)],
                       ["file", "node"])
    for a, b in zip(one.inside[-2::-1], other.inside[-2::-1]):
        nodes = session.materialise(nodes)
        keys = ["file", "node"]
        nodes = _differing(_children(a, nodes, keys, fanout), _children(b, nodes, keys, fanout), keys)
    return nodes


def _beside(rows: DataFrame, by: list[str]) -> DataFrame:
    """The k-th record of each ``by`` on one side in a row with the k-th on the other."""
    nth = Window.partitionBy(*by, "side").orderBy("offset", "length", "digest", "copy")
    place = F.struct("offset", "length", "digest", "copy")
    return rows.withColumn("nth", F.row_number().over(nth)).groupBy(*by, "nth").agg(
        F.max(F.when(F.col("side") == "a", place)).alias("a"), F.max(F.when(F.col("side") == "b", place)).alias("b"))


def _damaged(rows: DataFrame, record: list[str]) -> DataFrame:
    """What is wrong among the records of differing leaves, with records told by ``record`` where lengths moved them."""
    at = ["file", *record, "offset", "length", "digest"]
    n = F.sum(F.when(F.col("side") == "a", 1).otherwise(-1))
    moved = rows.groupBy(*at).agg(n.alias("n")).filter("n <> 0").select(
        *at, F.when(F.col("n") > 0, "a").otherwise("b").alias("side"),
        F.explode(F.sequence(F.lit(1), F.abs("n").cast("int"))).alias("copy"))
    content = ["file", *record, "length", "digest"]
    # a record that is on both sides with all its bytes is intact, wherever it begins
    alone = _beside(session.materialise(moved), content).filter(F.col("a").isNull() | F.col("b").isNull()) \
        .select("file", *record, F.inline(F.array(F.struct(
            F.when(F.col("a").isNotNull(), "a").otherwise("b").alias("side"),
            *[F.coalesce(F.col("a")[c], F.col("b")[c]).alias(c) for c in ("offset", "length", "digest", "copy")]))))
    state = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "extra").otherwise("altered")
    return _beside(alone, ["file", *record]).select(
        "file", F.coalesce("a.offset", "b.offset").alias("offset"), state.alias("state"))


def audit(original: DataFrame, replica: DataFrame, leaf_bytes: int = LEAF_BYTES, fanout: int = FANOUT,
          record: list[str] | None = None) -> DataFrame:
    """``file``, ``offset`` and ``state`` (altered, missing, extra) of every record the replica has wrong.

    Records are told by their offsets, so one of another length makes those behind it missing and extra.
    With ``record``, the columns of a record's id, only the damaged ones are named, by their offsets in the original
    (extra ones by those in the replica): intact records that others have shifted are left out.
    """
    both = [original, replica]
    numbers, levels = file_numbers(both), shape(both, leaf_bytes, fanout)
    one, other = (build(r, numbers, levels, leaf_bytes, fanout) for r in both)
    leaves = session.materialise(differing_leaves(one, other, numbers, fanout)) \
        .select(F.col("file").alias("of"), F.col("node").alias("leaf"))
    inside = F.col("file").eqNullSafe(F.col("of")) & (
        F.floor(F.col("offset") / leaf_bytes).cast("long") == F.col("leaf"))
    if record is not None:
        rows = [r.join(leaves, inside, "left_semi").select(
            "file", *record, "offset", "length", "digest", F.lit(s).alias("side")) for s, r in zip("ab", both)]
        return _damaged(rows[0].unionByName(rows[1]), record)
    nth = Window.partitionBy("file", "offset").orderBy("digest")
    sides = [r.join(leaves, inside, "left_semi").select("file", "offset", "length", "digest")
             .withColumn("copy", F.row_number().over(nth)).withColumn("side", F.lit(s))
             for s, r in zip("ab", both)]
    state = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "extra").otherwise("altered")
    content = F.concat_ws(":", "length", "digest")
    return sides[0].unionByName(sides[1]).groupBy("file", "offset", "copy").agg(
        F.max(F.when(F.col("side") == "a", content)).alias("a"),
        F.max(F.when(F.col("side") == "b", content)).alias("b")) \
        .filter(~F.col("a").eqNullSafe(F.col("b"))) \
        .select("file", "offset", state.alias("state"))
