"""Mixture-controlled packing by deficit round-robin over source queues.

Every source is a queue of packets: documents in the order they are read, long
ones cut into packets. In each round a source's deficit grows by its target share of one
window, and it sends the packets its deficit covers; what is left carries over to the next
round. A queue that always has packets sends packet *j* in round
``ceil(tokens up to and with j / quantum)``, because the quanta of so many rounds
must cover all it has sent. So rounds follow from running totals per source, which
tasks pass on to each other as one number per source, and deficits carry across windows and
partitions without any task playing through the rounds. The rounds laid end to end and cut
every ``window`` tokens are the sequences: only the last one can have padding.

Null text counts as empty, a null source is a queue of its own, repeated rows are packed
as often as they occur, and an empty table gives no pieces.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tillwork import session
from tillwork.llm import tokens
from tillwork.llm.common import cut_batches, running_total

WINDOW = 2048
#: Tokens of a packet: how far a source may run ahead of its share within a window.
PACKET = 512
#: Bytes of text that are tokenised at once, of which each distinct word is looked up once.
SLICE_BYTES = 4_000_000

PACKETS = ("doc_id long, source string, part int, row long, before long, start long, "
           "length long, doc_tokens long, ids binary")
PIECES = ("doc_id long, source string, start long, length long, doc_tokens long, "
          "sequence_id long, offset long, ids binary")


def packets(docs: DataFrame, vocabulary: str = tokens.BYTE_BPE, packet: int = PACKET) -> DataFrame:
    """Tokenised packets with the tokens their source has sent before them in the same task."""
    def cut(batches):
        encoder = tokens.encoder(vocabulary)
        part, row, sent = TaskContext.get().partitionId(), 0, {}
        for batch in cut_batches(batches, limit=SLICE_BYTES):
            doc_id, text, source = batch.columns
            ids, total = encoder.column(text)
            n_packets = -(-total // packet)
            doc = np.repeat(np.arange(len(total)), n_packets)
            start = packet * (np.arange(len(doc)) - (np.cumsum(n_packets) - n_packets)[doc])
            length = np.minimum(total[doc] - start, packet)
            # a source's packets follow each other, behind those of the slices before
            queue = source.dictionary_encode(null_encoding="encode")
            names, of = queue.dictionary.to_pylist(), np.asarray(queue.indices)[doc]
            order = np.argsort(of, kind="stable")
            firsts = np.searchsorted(of[order], np.arange(len(names)))
            within = np.cumsum(length[order]) - length[order]
            gone = np.array([sent.get(name, 0) for name in names], np.int64)
            before = np.empty(len(doc), np.int64)
            before[order] = within + (gone - within[firsts])[of[order]]
            sent.update(zip(names, (gone + np.add.reduceat(length[order], firsts)).tolist()))
            # packets follow each other as their ids do
            ends = (encoder.width * np.concatenate([[0], np.cumsum(length)])).astype(np.int32)
            cut_ids = pa.Array.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer(ends), pa.py_buffer(ids)])
            of_doc = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [doc_id.take(of_doc), source.take(of_doc), pa.array(np.full(len(doc), part, np.int32)),
                 pa.array(np.arange(row, row + len(doc))), pa.array(before), pa.array(start),
                 pa.array(length), pa.array(total[doc]), cut_ids],
                names=["doc_id", "source", "part", "row", "before", "start", "length",
                       "doc_tokens", "ids"])
            row += len(doc)

    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"),
                         F.col("source").cast("string"))
    return narrow.mapInArrow(cut, PACKETS)


def rounds(sent: DataFrame, targets: dict[str, float] | None = None, window: int = WINDOW
           ) -> DataFrame:
    """``sent`` with the round each packet is dealt in and its place in its source's queue.

    ``targets`` gives token shares by source, which add up to 1 at most; sources it doesn't name share what is
    left in proportion to their tokens (those come last if nothing is left). Without targets every source has the
    share of tokens it has in the data. Targets of sources without tokens go to nobody.
    """
    if targets and (min(targets.values()) <= 0 or sum(targets.values()) > 1 + 1e-9):
        raise ValueError(f"shares must be above 0 and add up to 1 at most: {targets}")
    totals = sent.groupBy("source", "part").agg(F.sum("length").alias("n"))
    queue = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = totals.groupBy("source").agg(F.sum("n").alias("of_source"))
    given = F.create_map(*[F.lit(x) for pair in (targets or {}).items() for x in pair]) \
        .cast("map<string,double>")[F.col("source")]
    left = max(0.0, 1 - sum((targets or {}).values()))
    whole = whole.withColumn("given", given)
    everything = whole.agg(F.sum(F.when(F.col("given").isNull(), F.col("of_source"))).alias("of_all"))
    # a source without a share is dealt after all others
    share = F.greatest(F.coalesce("given", F.col("of_source") / F.col("of_all") * left), F.lit(1e-9))
    quanta = whole.join(F.broadcast(everything)).select(
        F.col("source").alias("of"), (share * window).alias("quantum"))  # one row of totals
    bases = (totals.withColumn("base", F.coalesce(F.sum("n").over(queue), F.lit(0)))
             .join(quanta, F.col("source").eqNullSafe(F.col("of")))
             .select(F.col("source").alias("of"), F.col("part").alias("in_part"), "base", "quantum"))
    placed = sent.join(
        bases, F.col("source").eqNullSafe(F.col("of")) & (F.col("part") == F.col("in_part")))
    end = F.col("base") + F.col("before") + F.col("length")
    return placed.select(*sent.columns, F.ceil(end / F.col("quantum")).alias("round"),
                         (F.col("base") + F.col("before")).alias("place"))


def pack(docs: DataFrame, targets: dict[str, float] | None = None, window: int = WINDOW,
         packet: int = PACKET, vocabulary: str = tokens.BYTE_BPE) -> DataFrame:
    """Pieces of documents with their sequence, their offset in it, and their ids (unsigned 32 bit)."""
    stored = session.materialise(packets(docs, vocabulary, packet))
    narrow = stored.select("part", "row", "source", "before", "length")
    placed = running_total(rounds(narrow, targets, window).select(
        "part", "row", "round", "source", "place", "length"),
        ["round", "source", "place"], "length", "at")
    joined = stored.join(placed.select("part", "row", "at"), ["part", "row"]).select(
        "doc_id", "source", "start", "length", "doc_tokens", "at", "ids")

    def cut(batches):
        kind = tokens.encoder(vocabulary).kind
        for batch in batches:
            if not len(batch):
                continue
            doc, source, start, length, total, at, ids = batch.columns
            start, length, at = (np.asarray(c, dtype=np.int64) for c in (start, length, at))
            n_windows = (at + length - 1) // window - at // window + 1  # that a packet touches
            row = np.repeat(np.arange(len(at)), n_windows)
            sequence = at[row] // window + np.arange(len(row)) - (np.cumsum(n_windows) - n_windows)[row]
            begin = np.maximum(at[row], sequence * window)
            n = np.minimum((at + length)[row], (sequence + 1) * window) - begin
            # pieces follow each other as their packets do, so their ids are those of the batch cut elsewhere
            wide = np.frombuffer(b"".join(ids.to_pylist()), kind).astype("<u4")
            ends = np.concatenate([[0], np.cumsum(4 * n)]).astype(np.int32)
            pieces = pa.Array.from_buffers(
                pa.binary(), len(n), [None, pa.py_buffer(ends), pa.py_buffer(wide)])
            yield pa.RecordBatch.from_arrays(
                [doc.take(pa.array(row)), source.take(pa.array(row)), pa.array(start[row] + begin - at[row]),
                 pa.array(n), total.take(pa.array(row)), pa.array(sequence),
                 pa.array(begin - sequence * window), pieces],
                names=["doc_id", "source", "start", "length", "doc_tokens", "sequence_id",
                       "offset", "ids"])

    return joined.mapInArrow(cut, PIECES)


def sequences(pieces: DataFrame) -> DataFrame:
    """One row per sequence with its pieces in order; a sequence has at most ``window`` of them."""
    return pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct(
        "offset", "doc_id", "start", "length", "ids"))).alias("pieces"))
