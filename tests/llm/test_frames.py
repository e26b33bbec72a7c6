import zlib

import numpy as np
import pytest
import zstandard

from tests.llm.conftest import ODD_TEXTS
from tests.llm.test_packing import ids_of
from tillwork import session
from tillwork.llm import frames, tokens


def check(spark, docs, texts, **options):
    path = session.scratch_path(spark, "frames")
    frames.write(docs, path, **options)
    rows = sorted(frames.with_starts(frames.read(spark, path)).collect(), key=lambda r: r.start)
    ordered = sorted(texts, key=lambda x: (x[0] is not None, x[0] or 0))
    assert [r.doc_id for r in rows] == [i for i, _ in ordered]
    start = 0
    for row, (_, text) in zip(rows, ordered):
        ids = np.frombuffer(row.ids, "<u4").tolist()
        if len([1 for i, _ in texts if i == row.doc_id]) == 1:
            assert ids == ids_of(tokens.WORD_BPE, text)
        assert (row.start, row.n_tokens) == (start, len(ids))
        start += len(ids)
    return path


def test_documents(spark, documents):
    check(spark, documents, [(r.doc_id, r.text) for r in documents.collect()])


def test_odd_texts_small_frames(spark, make):
    ids = list(range(len(ODD_TEXTS)))
    ids[3] = None
    path = check(spark, make(ODD_TEXTS, ids), list(zip(ids, ODD_TEXTS)), frame_ids=50, file_ids=4000)
    names = [r.path for r in spark.read.format("binaryFile").load(path).select("path").collect()]
    assert len(names) > 5
    wanted = spark.createDataFrame([(4,), (12,), (99,)], "doc_id long")
    found = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist()
             for r in frames.read_documents(spark, path, wanted).collect()}
    assert found == {i: ids_of(tokens.WORD_BPE, ODD_TEXTS[i]) for i in (4, 12)}


def test_repeated_rows(spark, make):
    check(spark, make(["a b", "a b", "c"], [3, 3, 1]), [(3, "a b"), (3, "a b"), (1, "c")])


def test_empty(spark, make):
    path = session.scratch_path(spark, "frames")
    frames.write(make([]).limit(0), path)
    assert frames.read(spark, path).count() == 0


def file_of(n=10, frame_ids=8):
    writer = frames.FileWriter(2, frame_ids)
    for i in range(n):
        writer.add(i, np.arange(i, i + 5, dtype="<u2").tobytes())
    return writer.close() + frames.SEEKABLE_MAGIC


def test_file_is_plain_zstandard():
    content = file_of()
    raw = b"".join(np.arange(i, i + 5, dtype="<u2").tobytes() for i in range(10))
    out, rest = b"", content
    while rest:
        d = zstandard.ZstdDecompressor().decompressobj()
        out += d.decompress(rest)
        rest = d.unused_data
    assert out.startswith(raw[:16]) and zlib.crc32(out) == zlib.crc32(raw)


def test_reads_only_the_frames_of_a_document():
    content = bytearray(file_of())
    reader = frames.FileReader(bytes(content))
    content[reader.frame_at[0] + 7] ^= 0xFF  # spoils the first frame only
    spoilt = frames.FileReader(bytes(content))
    assert spoilt.ids(9).tolist() == list(range(9, 14))
    with pytest.raises((ValueError, zstandard.ZstdError)):
        spoilt.ids(0)


def test_checksum_is_checked():
    content = file_of()
    reader = frames.FileReader(content)
    at = len(content) - 9 - 12 * len(reader.entries) + 8
    spoilt = content[:at] + bytes([content[at] ^ 1]) + content[at + 1:]
    with pytest.raises(ValueError, match="checksum"):
        frames.FileReader(spoilt).ids(0)
