"""Ranked lexical search by scanning the documents with one Aho-Corasick automaton of all item terms.

No index of the documents is made. Every term of the items stands in the automaton between two guards, and a
text is scanned with all characters outside terms turned into that guard, so only whole terms match; neighbours share
a guard. The matches of a text are its term frequencies. A first scan sums document frequencies, the second
scores: each term leads to the items that hold it, and a task keeps the best documents per item.

The items are the query set. They are worked off in blocks of at most ``BLOCK_BYTES`` of text (a longer item is a block of
its own), so what is sent to the executors is bounded; each further block is two more scans. A task gives out at
most ``limit`` documents an item.

Defined results: a null text has no terms. Rows with one item_id are one item with the terms of all their different texts. Items without
terms, and items none of whose terms occur, have no rows. Repeated document rows are ranked each by itself; equal scores go by
doc_id, null first. An empty table of either kind gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tillwork.llm.common import running_total, slices

GUARD = b" "
#: UTF-8 bytes to themselves, capitals A-Z to small letters, other ASCII than letters and digits to the guard.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else GUARD[0] for b in range(256))
BLOCK_BYTES = 8_000_000
#: Scores a task holds before it drops those that cannot be among the best.
HELD = 200_000
RANKED = "item_id {kind}, doc_id long, score long"


def folded(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass").translate(FOLD)


def terms(text: str) -> list[bytes]:
    return [t for t in folded(text).split(GUARD) if t]


@dataclass(frozen=True)
class Block:
    """Terms in a fixed order, and for each the items it leads to with its number of times there.

    The items of term t are ``items[starts[t]:starts[t + 1]]``, as places in ``item_ids``.
    """

    item_ids: list
    terms: list[bytes]
    starts: np.ndarray
    items: np.ndarray
    times: np.ndarray

    @classmethod
    def of(cls, rows: Iterable) -> Block:
        counts: dict = {}
        for item_id, text in rows:
            counts.setdefault(item_id, Counter()).update(terms(text or ""))
        places: dict[bytes, list[tuple[int, int]]] = {}
        for place, found in enumerate(counts.values()):
            for term, n in found.items():
                places.setdefault(term, []).append((place, n))
        lengths = [len(p) for p in places.values()]
        flat = [x for p in places.values() for x in p]
        return cls(list(counts), list(places), np.cumsum([0, *lengths]),
                   np.array([i for i, _ in flat], np.int64), np.array([n for _, n in flat], np.int64))

    def automaton(self) -> ahocorasick.Automaton:
        made = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for number, term in enumerate(self.terms):
            made.add_word((GUARD + term + GUARD).decode("latin-1"), number)
        made.make_automaton()
        return made


def scan(machine: ahocorasick.Automaton, text: str | None) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of terms in the text, the numbers of the item terms in it, and how often each occurs."""
    guarded = GUARD + folded(text or "") + GUARD
    solid = np.frombuffer(guarded, np.uint8) != GUARD[0]
    n = int(np.count_nonzero(solid[1:] & ~solid[:-1]))
    hits = np.fromiter((number for _, number in machine.iter(guarded.decode("latin-1"))), np.int64)
    found, tf = np.unique(hits, return_counts=True)
    return n, found, tf


def _frequencies(docs: DataFrame, block) -> tuple[int, int, np.ndarray]:
    """Documents with terms, their terms, and per item term the documents that hold it."""

    def count(batches):
        words, machine = block.value.terms, block.value.automaton()
        df, with_terms, length = np.zeros(len(words), np.int64), 0, 0
        for _, texts in slices(batches):
            for text in texts:
                n, found, _ = scan(machine, text)
                df[found] += 1
                with_terms += n > 0
                length += n
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([[-2, -1], seen])), pa.array(np.concatenate([[with_terms, length], df[seen]]))],
            names=["term", "n"])

    sums = docs.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    # a row per term of the block, which is on the driver already
    found = {r.term: r.n for r in sums.collect()}
    df = np.array([found.get(t, 0) for t in range(len(block.value.terms))], np.int64)
    return found.get(-2, 0), found.get(-1, 0), df


def weights(df: np.ndarray, documents: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(d) + 1))) for d in df], np.int64)


class Best:
    """The best ``limit`` documents per item of what was added, by score and then doc_id."""

    def __init__(self, items: int, limit: int) -> None:
        self.limit, self.held, self.rows = limit, 0, []
        self.least = np.ones(items, np.int64)  # scores below cannot be among the best any more

    def add(self, doc: int | None, scores: np.ndarray) -> None:
        items = np.flatnonzero(scores >= self.least)
        if len(items):
            self.rows.append((items, scores[items], np.full(len(items), 0 if doc is None else doc),
                              np.full(len(items), doc is not None)))
            self.held += len(items)
            if self.held > max(HELD, 2 * self.limit * len(self.least)):
                self.cut()

    def cut(self) -> tuple[np.ndarray, ...]:
        if not self.rows:
            return tuple(np.zeros(0, np.int64) for _ in range(4))
        item, score, doc, known = (np.concatenate(c) for c in zip(*self.rows))
        order = np.lexsort((doc, known, -score, item))
        item = item[order]
        first = np.searchsorted(item, item)
        place = np.arange(len(item)) - first
        kept = order[place < self.limit]
        full = place == self.limit - 1
        self.least[item[full]] = score[order][full]
        self.rows = [(item[place < self.limit], score[kept], doc[kept], known[kept])]
        self.held = len(kept)
        return self.rows[0]


def _best(docs: DataFrame, block, weight: np.ndarray, documents: int, length: int, limit: int, kind: str) -> DataFrame:
    """Per task the best documents of each item."""
    weight = docs.sparkSession.sparkContext.broadcast(weight)

    def score(batches):
        b, w = block.value, weight.value
        machine, best = b.automaton(), Best(len(b.item_ids), limit)
        sizes = np.diff(b.starts)
        for batch, texts in slices(batches):
            for doc, text in zip(batch.column(0).to_pylist(), texts):
                n, found, tf = scan(machine, text)
                if not len(found):
                    continue
                m = 75 + (25 * n * documents) // length
                part = w[found] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))
                counts = sizes[found]
                # the places of all items that the found terms lead to
                skip = np.repeat(b.starts[found] - (np.cumsum(counts) - counts), counts)
                places = skip + np.arange(len(skip))
                scores = np.zeros(len(b.item_ids), np.int64)
                np.add.at(scores, b.items[places], np.repeat(part, counts) * b.times[places])
                best.add(doc, scores)
        item, value, doc, known = best.cut()
        ids = pa.array(b.item_ids, pa.int64() if kind == "bigint" else pa.string())
        yield pa.RecordBatch.from_arrays(
            [ids.take(pa.array(item)), pa.array(doc, mask=~known.astype(bool)), pa.array(value)],
            names=["item_id", "doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        score, RANKED.format(kind=kind))


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[list]:
    """The items in lists of bounded size; all texts of an item are in one list."""
    total = items.agg(F.sum("bytes")).first()[0] or 0
    if total <= block_bytes:
        yield [(r.item_id, r.text) for r in items.select("item_id", "text").collect()]
        return
    sizes = items.groupBy("item_id").agg(F.sum("bytes").alias("bytes"))
    lined = running_total(sizes, ["item_id"], "bytes", "at").select(
        "item_id", F.floor((F.col("at") + F.col("bytes")) / block_bytes).alias("block"))
    numbers = [r.block for r in lined.select("block").distinct().sort("block").collect()]
    for number in numbers:
        chosen = lined.filter(F.col("block") == number).select(F.col("item_id").alias("id"))
        yield [(r.item_id, r.text) for r in
               items.join(chosen, F.col("item_id").eqNullSafe(F.col("id")), "left_semi").select("item_id", "text").collect()]


def rank(docs: DataFrame, items: DataFrame, limit: int = 20, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``item_id, rank, doc_id, score``: for each item the ``limit`` documents that score highest above 0.

    ``docs(doc_id, text)`` and ``items(item_id, text)``; item ids are integers or strings.
    """
    spark = docs.sparkSession
    kind = dict(items.dtypes)["item_id"]
    kind = kind if kind == "string" else "bigint"
    queries = items.select(F.col("item_id").cast(kind).alias("item_id"), F.coalesce("text", F.lit("")).alias("text")) \
        .distinct().withColumn("bytes", F.octet_length("text").cast("long"))
    found = spark.createDataFrame([], RANKED.format(kind=kind))
    for rows in _blocks(queries, block_bytes):
        block = Block.of(rows)
        if not block.terms:
            continue
        shared = spark.sparkContext.broadcast(block)
        documents, length, df = _frequencies(docs, shared)
        if documents:
            found = found.unionByName(
                _best(docs, shared, weights(df, documents), documents, length, limit, kind))
    place = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc("doc_id"))
    return found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= limit).select(
        "item_id", "rank", "doc_id", "score")
