"""Shards of documents by balanced label propagation.

Documents that share a key are linked, each with each. A label is a shard. In every round a join brings to each
document how much weight of its neighbours lies in which shard; it asks to move to the shard that
holds most of it, and a quota per shard (its free capacity, and what leaves it in exchange) decides how many may. The
neighbours of a key are counted before they are joined, so a key costs one row of ``shards`` sums
however many documents have it, and pairs are never made. Documents without links fill the shards up
in the end, which makes the sizes even.

Laws: ``rows`` gives shards whose counts are at most one apart, ``bytes`` shards whose sizes are about
a document apart. A group larger than a shard is split over several; a smaller one is split only
where a quota cuts through it.

Defined results: a null text has size 1 and counts as empty; empty texts are equal texts. Repeated rows are documents of
their own, linked by their text. Null doc_ids are allowed. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F

from tillwork import session
from tillwork.llm.common import running_total

LAWS = ("rows", "bytes")
#: Rounds of propagation at most; it ends earlier once no move is allowed.
ROUNDS = 12


def _sums(df: DataFrame, by: str, value: str, shards: int) -> list[int]:
    found = {r[0]: r[1] for r in df.groupBy(by).agg(F.sum(value)).collect()}
    return [found.get(s, 0) for s in range(shards)]


def _flat(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def _linked(nodes: DataFrame, links: DataFrame, shards: int) -> DataFrame:
    """A row for each document and key that others have too; ``mark``, the smallest key, names the main row."""
    links = links.filter("node is not null and key is not null").select("node", "key").distinct()
    # written out, here and below, so that the join has a plain table on either side and Spark can split a hot key
    shared = session.materialise(
        links.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key"))
    kept = links.join(shared, "key")
    marks = kept.groupBy("node").agg(F.min("key").alias("mark"))
    start = F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int")
    return session.materialise(
        kept.join(marks, "node").join(nodes, "node")
        .select("node", "key", "mark", "weight", start.alias("shard")))


def _wishes(state: DataFrame, shards: int, open_to: list[bool]) -> DataFrame:
    """Per document its shard and the shard it would be in, which is its own or an open one."""
    every = range(shards)
    inside = [F.sum(F.when(F.col("shard") == s, F.col("weight")).otherwise(0)).alias(f"in{s}") for s in every]
    counts = session.materialise(state.groupBy("key").agg(*inside))
    around = state.join(counts, "key").groupBy("node", "mark", "weight", "shard").agg(
        *[F.sum(f"in{s}").alias(f"in{s}") for s in every], F.count("*").alias("keys"))
    # the document itself is counted with each of its keys, but stands for one only
    held = [F.when(F.col("shard") == s, F.col(f"in{s}") - (F.col("keys") - 1) * F.col("weight"))
            .otherwise(F.col(f"in{s}")) for s in every]
    # the members of a group agree on the shard among equals, groups differ in it
    choices = [
        F.when(F.lit(open_to[s]) | (F.col("shard") == s),
               F.struct(held[s].alias("n"), F.xxhash64("mark", F.lit(s)).alias("tie"), F.lit(s).alias("s")))
        for s in every]
    return around.select("node", "mark", "weight", "shard", F.greatest(*choices)["s"].alias("wish"))


def _within_quotas(movers: DataFrame, asked: list[int], quotas: list[int]) -> DataFrame:
    """Movers in the order of their groups, to each shard as many as its quota allows."""
    if all(a <= q for a, q in zip(asked, quotas)):
        return movers.select("node", "wish")
    before = [0, *accumulate(asked)][:-1]
    ends = _flat([b + q for b, q in zip(before, quotas)])
    lined = running_total(movers, ["wish", "mark", "node"], "weight", "at")
    return lined.filter(F.col("at") + F.col("weight") <= ends[F.col("wish")]).select("node", "wish")


def propagate(nodes: DataFrame, links: DataFrame, shards: int, rounds: int = ROUNDS) -> DataFrame:
    """``node, mark, weight, shard`` of the linked documents of ``nodes(node, weight)`` and ``links(node, key)``.

    Loads and quotas are tables of a row per shard or pair of shards; documents never leave the executors.
    """
    capacity = -(-(nodes.agg(F.sum("weight")).first()[0] or 0) // shards)
    state, idle = _linked(nodes, links, shards), 0
    for number in range(rounds):
        loads = _sums(state.filter("key = mark"), "shard", "weight", shards)
        room = [max(0, capacity - n) for n in loads]
        # by turns all shards are open, for exchanges between full ones, or those with free capacity
        open_to = [number % 2 == 0 or r > 0 for r in room]
        wishes = session.materialise(_wishes(state, shards, open_to).filter("wish <> shard"))
        flows = {(r[0], r[1]): r[2] for r in
                 wishes.groupBy("shard", "wish").agg(F.sum("weight")).collect()}
        asked = [sum(n for (_, to), n in flows.items() if to == t) for t in range(shards)]
        swaps = [sum(min(n, flows.get((t, s), 0)) for (s, to), n in flows.items() if to == t)
                 for t in range(shards)]
        quotas = [r + x for r, x in zip(room, swaps)]
        idle = 0 if any(map(min, asked, quotas)) else idle + 1
        if idle == 2:
            break
        if idle == 0:
            moved = _within_quotas(wishes, asked, quotas)
            state = session.materialise(state.join(moved, "node", "left").select(
                "node", "key", "mark", "weight", F.coalesce("wish", "shard").alias("shard")))
    return state.filter("key = mark").drop("key")


def balanced(nodes: DataFrame, links: DataFrame, shards: int = 16, rounds: int = ROUNDS) -> DataFrame:
    """``node, shard`` for every row of ``nodes(node, weight)``, node being unique; weights of 1 give counts at most one apart.

    ``links(node, key)`` may name any number of keys for a document. After the propagation each shard
    keeps linked documents up to its even share, and what is over fills the other shards together with
    the documents without links, whole groups first.
    """
    labels = propagate(nodes, links, shards, rounds)
    total = nodes.agg(F.sum("weight")).first()[0] or 0
    loads = _sums(labels, "shard", "weight", shards)
    fullest = sorted(range(shards), key=lambda s: (-loads[s], s))
    share = [total // shards] * shards
    for s in fullest[:total % shards]:
        share[s] += 1
    before = [0, *accumulate(loads)][:-1]
    middle = F.col("at") + F.floor((F.col("weight") - 1) / 2)
    if any(n > m for n, m in zip(loads, share)):
        lined = running_total(labels, ["shard", "mark", "node"], "weight", "at")
        fits = middle - _flat(before)[F.col("shard")] < _flat(share)[F.col("shard")]
        lined = session.materialise(lined.select("node", "mark", "weight", "shard", fits.alias("fits")))
        settled, over = lined.filter("fits"), lined.filter("not fits").select("node", "mark", "weight")
        loads = _sums(settled, "shard", "weight", shards)
    else:
        settled, over = labels, labels.limit(0).select("node", "mark", "weight")
    free = nodes.join(labels.select("node"), "node", "left_anti").select(
        "node", F.lit(None).cast("long").alias("mark"), "weight")
    pool = over.unionByName(free).withColumn("alone", F.col("mark").isNull())
    ends = list(accumulate(max(0, m - n) for m, n in zip(share, loads)))[:-1]
    shard = sum((F.when(middle >= e, 1).otherwise(0) for e in ends), F.lit(0))
    filled = running_total(pool, ["alone", "mark", "node"], "weight", "at").select(
        "node", shard.cast("int").alias("shard"))
    return settled.select("node", "shard").unionByName(filled)


def shard(docs: DataFrame, shards: int = 16, law: str = "rows", rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row; equal texts are linked.

    ``slot`` counts the documents of a shard by doc_id. ``grown_shard`` is null: neither law places a document by its id alone.
    """
    if law not in LAWS or shards < 2:
        raise ValueError(f"law must be one of {LAWS} and shards 2 or more, got {law!r} and {shards}")
    text = F.coalesce("text", F.lit(""))
    rows = session.materialise(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("key"),
    ).withColumn("node", F.monotonically_increasing_id()))
    weight = F.col("size") if law == "bytes" else F.lit(1).cast("long")
    placed = balanced(rows.select("node", weight.alias("weight")), rows.select("node", "key"), shards, rounds)
    placed = session.materialise(rows.drop("key").join(placed, "node").withColumn("one", F.lit(1).cast("long")))
    starts = [0, *accumulate(_sums(placed, "shard", "one", shards))][:-1]
    numbered = running_total(placed, ["shard", "doc_id", "node"], "one", "at")
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit(law).alias("law"), "shard",
        (F.col("at") - _flat(starts)[F.col("shard")]).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


def cut_links(placed: DataFrame, links: DataFrame) -> DataFrame:
    """``pairs`` of linked documents and how many of them are ``cut``, from counts by key and shard.

    A pair that shares several keys counts once for each.
    """
    inside = links.filter("key is not null").distinct().join(placed, "node") \
        .groupBy("key", "shard").agg(F.count("*").cast("decimal(38,0)").alias("n"))
    keys = inside.groupBy("key").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("own"))
    return keys.agg(
        F.coalesce(F.sum(F.col("n") * (F.col("n") - 1) / 2), F.lit(0)).cast("long").alias("pairs"),
        F.coalesce(F.sum((F.col("n") * F.col("n") - F.col("own")) / 2), F.lit(0)).cast("long").alias("cut"))
