"""Token-id files of independent zstandard frames with a trailing seek table.

A file is a series of zstandard frames with the ids of whole documents (long ones
run over several frames), a skippable frame with the document index, and the seek table of the
seekable zstandard format: sizes and a checksum (low 32 bits of XXH64) per frame. Any
zstandard reader can decompress the file; ``read_documents`` decompresses
only the frames of the documents asked for.

Spark writes and reads the files, so they can lie in any store and a lost task leaves
nothing behind. Each file is one row of Spark's text writer, whose line separator is set to the
four bytes that end a seek table.

Null text counts as empty and a null doc_id sorts first; repeated rows are written as often
as they occur; an empty table gives no documents.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tillwork import session
from tillwork.llm import tokens
from tillwork.llm.common import slices

# Fixed values of the seekable zstandard format.
SKIPPABLE_INDEX = 0x184D2A50
SKIPPABLE_SEEK_TABLE = 0x184D2A5E
SEEKABLE_MAGIC = b"\xb1\xea\x92\x8f"

#: Ids of a frame, the least that a reader decompresses for a document.
FRAME_IDS = 1 << 16
#: Ids of a file, which is what a task holds in memory.
FILE_IDS = 1 << 22


def _skippable(magic: int, content: bytes) -> bytes:
    return struct.pack("<II", magic, len(content)) + content


class FileWriter:
    """Collects documents and gives out the bytes of a file, but for its last four."""

    def __init__(self, width: int, frame_ids: int = FRAME_IDS, level: int = 3):
        self.width, self.frame_bytes = width, frame_ids * width
        self.compressor = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.buffer, self.frames, self.entries = bytearray(), [], []
        self.docs: list[tuple[int | None, int]] = []
        self.n_ids = 0

    def _close_frame(self, n: int) -> None:
        raw = bytes(self.buffer[:n])
        del self.buffer[:n]
        packed = self.compressor.compress(raw)
        self.frames.append(packed)
        self.entries.append((len(packed), n, xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append((doc_id, len(ids) // self.width))
        self.n_ids += len(ids) // self.width
        self.buffer += ids
        while len(self.buffer) >= self.frame_bytes:
            self._close_frame(self.frame_bytes)

    def close(self) -> bytes:
        if self.buffer:
            self._close_frame(len(self.buffer))
        table = np.zeros(len(self.docs), [("known", "u1"), ("doc_id", "<i8"), ("n", "<u8")])
        for i, (doc_id, n) in enumerate(self.docs):
            table[i] = (doc_id is not None, doc_id or 0, n)
        index = self.compressor.compress(bytes([self.width]) + table.tobytes())
        index = _skippable(SKIPPABLE_INDEX, index)
        entries = [*self.entries, (len(index), 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF)]
        rows = b"".join(struct.pack("<III", *e) for e in entries)
        footer = struct.pack("<IB", len(entries), 0x80) + SEEKABLE_MAGIC
        seek = _skippable(SKIPPABLE_SEEK_TABLE, rows + footer)
        return (b"".join(self.frames) + index + seek)[:-len(SEEKABLE_MAGIC)]


class FileReader:
    """Reads a file's index at once and its frames when a document needs them."""

    def __init__(self, content: bytes):
        if content[-4:] != SEEKABLE_MAGIC:
            raise ValueError("no seek table at the end")
        n, flags = struct.unpack("<IB", content[-9:-4])
        if flags != 0x80:
            raise ValueError("seek table without checksums")
        at = len(content) - 9 - 12 * n
        entries = np.frombuffer(content, "<u4", 3 * n, at).reshape(n, 3).astype(np.int64)
        if struct.unpack("<II", content[at - 8:at]) != (SKIPPABLE_SEEK_TABLE, 12 * n + 9):
            raise ValueError("seek table of another size")
        self.content, self.entries = content, entries
        self.frame_at = np.concatenate([[0], np.cumsum(entries[:, 0])])
        self.raw_at = np.concatenate([[0], np.cumsum(entries[:, 1])])
        index = content[self.frame_at[n - 1] + 8:self.frame_at[n]]
        index = zstandard.ZstdDecompressor().decompress(index)
        self.width = index[0]
        self.docs = np.frombuffer(index, [("known", "u1"), ("doc_id", "<i8"), ("n", "<u8")], -1, 1)
        self.starts = np.concatenate([[0], np.cumsum(self.docs["n"].astype(np.int64))])
        self._last: tuple[int, bytes] = (-1, b"")

    def _frame(self, k: int) -> bytes:
        if self._last[0] != k:
            packed = self.content[self.frame_at[k]:self.frame_at[k + 1]]
            raw = zstandard.ZstdDecompressor().decompress(packed)
            if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.entries[k, 2]:
                raise ValueError(f"frame {k} does not match its checksum")
            self._last = (k, raw)
        return self._last[1]

    def ids(self, row: int) -> np.ndarray:
        """The ids of the document in this row of the index."""
        begin, end = (int(x) * self.width for x in self.starts[row:row + 2])
        first = int(np.searchsorted(self.raw_at, begin, side="right")) - 1
        parts, k = [], first
        while begin < end:
            raw = self._frame(k)
            low = begin - int(self.raw_at[k])
            part = raw[low:low + end - begin]
            parts.append(part)
            begin, k = begin + len(part), k + 1
        return np.frombuffer(b"".join(parts), f"<u{self.width}")


def write(docs: DataFrame, path: str, vocabulary: str = tokens.WORD_BPE,
          frame_ids: int = FRAME_IDS, file_ids: int = FILE_IDS) -> None:
    """Write the ids of all documents in ascending doc_id order; file names keep that order."""
    n = session.shuffle_partitions(docs.sparkSession)
    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    ordered = narrow.repartitionByRange(n, "doc_id", F.xxhash64("text")) \
        .sortWithinPartitions("doc_id", F.xxhash64("text"))

    def files(batches):
        encoder = tokens.encoder(vocabulary)
        writer = FileWriter(encoder.width, frame_ids)
        row = lambda w: pa.RecordBatch.from_arrays([pa.array([w.close()], pa.binary())], ["value"])
        for batch, texts in slices(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), texts):
                writer.add(doc_id, encoder.ids(text))
                if writer.n_ids >= file_ids:
                    yield row(writer)
                    writer = FileWriter(encoder.width, frame_ids)
        if writer.docs:
            yield row(writer)

    (ordered.mapInArrow(files, "value binary").select(F.col("value").cast("string"))
     .write.option("lineSep", SEEKABLE_MAGIC.decode("latin-1")).option("encoding", "ISO-8859-1")
     .option("maxRecordsPerFile", 1).option("compression", "none").text(path))


FILE_NAME = r"part-(\d+)-.*?c(\d+)\.txt$"


def read(spark: SparkSession, path: str) -> DataFrame:
    """Every document of the files at ``path``: its file, its row there, ids before it in the file."""
    def documents(batches):
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                reader = FileReader(content.as_py())
                for begin in range(0, len(reader.docs), 1024):
                    rows = range(begin, min(begin + 1024, len(reader.docs)))
                    ids = [reader.ids(r).astype("<u4").tobytes() for r in rows]
                    known = reader.docs["known"][begin:begin + 1024].astype(bool)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([name] * len(rows)), pa.array(list(rows), pa.int64()),
                        pa.array(reader.docs["doc_id"][begin:begin + 1024], pa.int64(), mask=~known),
                        pa.array(reader.starts[rows.start:rows.stop], pa.int64()),
                        pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()),
                    ], ["file", "row", "doc_id", "before", "n_tokens", "ids"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(documents, "file string, row long, doc_id long, before long, "
                                       "n_tokens long, ids binary")


def read_documents(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """The ids of the documents in ``wanted`` (a ``doc_id`` column); other frames stay compressed."""
    index = _index(spark, path).join(wanted.select("doc_id").distinct(), "doc_id")
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    asked = index.groupBy("file").agg(F.sort_array(F.collect_list("row")).alias("rows"))

    def pick(batches):
        for batch in batches:
            for content, rows in zip(batch.column(0), batch.column(1).to_pylist()):
                reader = FileReader(content.as_py())
                ids = [reader.ids(r).astype("<u4").tobytes() for r in rows]
                yield pa.RecordBatch.from_arrays([
                    pa.array([int(reader.docs["doc_id"][r]) for r in rows], pa.int64()),
                    pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return files.join(asked, F.col("path") == F.col("file")).select("content", "rows") \
        .mapInArrow(pick, "doc_id long, ids binary")


def _index(spark: SparkSession, path: str) -> DataFrame:
    def rows(batches):
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                reader = FileReader(content.as_py())
                known = reader.docs["known"].astype(bool)
                n = len(reader.docs)
                yield pa.RecordBatch.from_arrays([
                    pa.array([name] * n), pa.array(np.arange(n)),
                    pa.array(reader.docs["doc_id"], pa.int64(), mask=~known)],
                    ["file", "row", "doc_id"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(rows, "file string, row long, doc_id long")


def with_starts(docs: DataFrame) -> DataFrame:
    """Add ``start``: the ids of all documents before this one, over all files in name order."""
    number = [F.regexp_extract("file", FILE_NAME, k).cast("long") for k in (1, 2)]
    files = docs.groupBy("file").agg(F.sum("n_tokens").alias("n")) \
        .withColumns({"task": number[0], "piece": number[1]})
    tasks = files.groupBy("task").agg(F.sum("n").alias("n"))
    earlier = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)  # one row per task
    tasks = tasks.select("task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("of_tasks"))
    inside = Window.partitionBy("task").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    bases = files.withColumn("of_files", F.coalesce(F.sum("n").over(inside), F.lit(0))) \
        .join(tasks, "task").select("file", (F.col("of_tasks") + F.col("of_files")).alias("base"))
    return docs.join(bases, "file").withColumn("start", F.col("base") + F.col("before")).drop("base")
