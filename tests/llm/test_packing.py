import random
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.conftest import ODD_TEXTS
from tillwork.llm import packing, tokens


@lru_cache
def library(name):
    return Tokenizer.from_file(public_tokenizers.path(name))


def ids_of(name, text):
    return library(name).encode(text or "", add_special_tokens=False).ids + [1]


@pytest.mark.parametrize("name", [tokens.BYTE_BPE, tokens.WORD_BPE])
def test_ids_equal_the_library(name, documents):
    odd = ["a  b", "a \n b", "\n\na", "a b 　c", "it's  we'll\t\tx", "a ́b", " ", "  x  ", "\r\n x y",
           "x<|endoftext|>y z", "Σ ΟΔΟΣ. ΟΔΟΣ", "a\u0085b", "12 345,6", "​ ﻿z"]
    texts = odd + [t for t in ODD_TEXTS if t] + [r.text for r in documents.limit(60).collect()]
    encoder = tokens.Encoder(name, keep=500)
    for text in texts + texts:
        assert np.frombuffer(encoder.ids(text), encoder.kind).tolist() == ids_of(name, text), text[:50]


@pytest.mark.parametrize("name", [tokens.BYTE_BPE, tokens.WORD_BPE])
def test_a_mark_of_lower_case_takes_the_punctuation(name):
    encoder = tokens.Encoder(name)
    for text in ("İ İ,", "İ, x", "a.\n\t\nb", "\t\nb", "a\n\tb", "a \xa0b", "\xa0", "a,\x1cb,"):
        assert np.frombuffer(encoder.ids(text), encoder.kind).tolist() == ids_of(name, text), text


@pytest.mark.parametrize("name", [tokens.BYTE_BPE, tokens.WORD_BPE])
def test_what_a_worker_remembers(name):
    """A word seen with punctuation only once is remembered without it only; unknown words are found together."""
    encoder = tokens.Encoder(name, keep=1000)
    calls = []
    words = encoder._words
    encoder._words = lambda found, *more: calls.append(len(found)) or words(found, *more)
    text = "start " + " ".join(f"{'abcdefghij'[i // 10]}q{'abcdefghij'[i % 10]}," for i in range(100))
    for seen in (101, 201, 201):
        assert np.frombuffer(encoder.ids(text), encoder.kind).tolist() == ids_of(name, text)
        assert len(encoder.known) + len(encoder.spaced) == seen
    assert calls == [1, 100]


@pytest.mark.parametrize("name", [tokens.BYTE_BPE, tokens.WORD_BPE])
def test_columns_equal_the_library(name, documents):
    parts = ["a", "The", "İ", "é", "Σ", "ΟΔΟΣ", "н", "中", "12", " ", " ", "  ", "\n", "\n\n", "\t", "\r\n", "\xa0",
             "\u3000", "\x1c", "\x85", "\u0301", "\u0338", ".", ",", "<", "(", "'", "'s", "_", "<|endoftext|>", "\x00"]
    chosen = random.Random(5)
    odd = ["".join(chosen.choices(parts[:20] + parts[20:] * (i % 2), k=i % 30)) for i in range(600)]
    texts = ODD_TEXTS + odd + [r.text for r in documents.limit(60).collect()]
    encoder = tokens.Encoder(name, keep=500)
    for some in (texts, texts[7:90], texts[:1], [None, ""], []):
        ids, n = encoder.column(pa.array(["left out", *some], pa.string()).slice(1))
        assert [part.tolist() for part in np.split(ids, np.cumsum(n))[:-1]] == [ids_of(name, t) for t in some]


@pytest.mark.parametrize("name", [tokens.BYTE_BPE, tokens.WORD_BPE])
def test_a_column_asks_for_its_words_once(name):
    """However many texts have a word, with or without punctuation: it is cut off, and all words are found together."""
    words = [f"{a}q{b}" for a in "abcdefghij" for b in "abcdefghij"]
    texts = [" ".join(words[i:i + 50]) + end for i in range(50) for end in (".", " (x), y!", "\n" + words[i])]
    encoder, calls = tokens.Encoder(name), []
    found = encoder._words
    encoder._words = lambda asked, *more: calls.append(len(asked)) or found(asked, *more)
    ids, n = encoder.column(pa.array(texts))
    assert [part.tolist() for part in np.split(ids, np.cumsum(n))[:-1]] == [ids_of(name, t) for t in texts]
    assert calls == [99, 50]  # behind a space, "y" too; first in texts and lines
    assert len(encoder.spaced) == 100 and set(encoder.known) == {*words[:50], ".", "),", "!"}  # "(x" was spaced too


def check(pieces, texts, window=2048):
    expected = {i: ids_of(tokens.BYTE_BPE, t) for i, t in texts}
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in pieces.collect():
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length > 0 and r.doc_tokens == len(expected[r.doc_id])
        docs[r.doc_id].append((r.start, ids))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert {i: [x for _, part in sorted(p) for x in part] for i, p in docs.items()} == expected
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= window
    total = sum(map(len, expected.values()))
    assert sorted(sequences) == list(range(-(-total // window)))


def test_documents(documents):
    check(packing.pack(documents), [(r.doc_id, r.text) for r in documents.collect()])


def test_odd_texts(make):
    check(packing.pack(make(ODD_TEXTS)), list(enumerate(ODD_TEXTS)))
    check(packing.pack(make(ODD_TEXTS), window=64, packet=16), list(enumerate(ODD_TEXTS)), 64)


def test_packets_follow_those_of_earlier_batches(spark, make):
    docs = make([f"{'word ' * (i % 7)}{i}" for i in range(40)], source=[None, "a", "b", "a", "c"]).coalesce(1)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "3")
    try:
        rows = packing.packets(docs, packet=4).collect()
    finally:
        spark.conf.set(name, before)
    sent = Counter()
    for row, r in enumerate(rows):
        assert (r.row, r.before, len(r.ids)) == (row, sent[r.source], 2 * r.length)
        sent[r.source] += r.length
    assert sum(sent.values()) == sum(len(ids_of(tokens.BYTE_BPE, r.text)) for r in docs.collect())
    assert [r.doc_id for r in rows] == sorted(r.doc_id for r in rows)


def test_packets_longer_than_windows(make):
    check(packing.pack(make(ODD_TEXTS), window=50, packet=333), list(enumerate(ODD_TEXTS)), 50)


def test_empty(make):
    assert packing.pack(make([]).limit(0)).count() == 0


def test_every_window_has_the_mixture(documents):
    """Each source's tokens up to the end of any window differ from its share by about a packet."""
    pieces = packing.pack(documents, window=2048, packet=128)
    used = Counter()
    rows = pieces.groupBy("sequence_id", "source").agg(F.sum("length").alias("n")).collect()
    whole = Counter()
    for r in rows:
        whole[r.source] += r.n
    total = sum(whole.values())
    for sequence in range(max(r.sequence_id for r in rows) + 1):
        for r in rows:
            if r.sequence_id == sequence:
                used[r.source] += r.n
        for source, n in used.items():
            share = whole[source] / total
            assert abs(n - share * min(total, 2048 * (sequence + 1))) <= 2 * 128 + 2048 * share + 128


def test_targets(documents):
    pieces = packing.pack(documents, targets={"src0": 0.5})
    early = pieces.filter("sequence_id < 10").groupBy("source").agg(F.sum("length").alias("n"))
    n = {r.source: r.n for r in early.collect()}
    assert n["src0"] > 0.2 * sum(n.values())


def test_pieces_carry_what_the_digest_needs(documents):
    one = packing.pack(documents).select("ids", F.crc32("ids").alias("c")).first()
    assert zlib.crc32(bytes(one.ids)) == one.c


def test_sequences(documents):
    row = packing.sequences(packing.pack(documents)).filter("sequence_id = 0").first()
    assert sum(p.length for p in row.pieces) == 2048


def test_unnamed_sources_share_what_is_left(spark):
    rows = [(s, p, r, 100) for s, parts in (("a", 3), ("b", 9), ("c", 18), (None, 3)) for p in range(parts) for r in range(10)]
    sent = spark.createDataFrame([(s, p, r, r * n, n) for s, p, r, n in rows],
                                 "source string, part int, row long, before long, length long")

    def early(targets, rounds):
        dealt = packing.rounds(sent, targets, 1000).filter(f"round <= {rounds}").groupBy("source")
        return {r.source: r.n for r in dealt.agg(F.sum("length").alias("n")).collect()}

    n = early({"a": 0.5}, 5)
    # 2,500 of a; the others have 9, 18 and 3 parts of 2,500
    assert n == {"a": 2500, "b": 700, "c": 1500, None: 200}
    assert early({"a": 0.25, "b": 0.75}, 12) == {"a": 3000, "b": 9000}
    assert set(early({"a": 0.25, "b": 0.75}, 10**18)) == {"a", "b", "c", None}
    for wrong in ({"a": 0.7, "b": 0.4}, {"a": 0}, {"a": -0.1}):
        with pytest.raises(ValueError):
            packing.rounds(sent, wrong)
