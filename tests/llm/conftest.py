import os

import pytest

from tillwork.llm.common import ship

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, words long, Bits string"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    return ship(spark)


@pytest.fixture(scope="session")
def documents(spark):
    if not os.path.isdir(SMALL):
        pytest.skip("no tables")
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture
def make(spark):
    """Documents with the given texts; doc_ids count from 0 unless given, with further clashing columns."""
    def build(texts, ids=None, lang="en", source=None):
        ids = list(range(len(texts))) if ids is None else ids
        rows = [(i, t, lang, (source or [None, "a", "b"][k % 3]), None if t is None else len(t), 1, "x")
                for k, (i, t) in enumerate(zip(ids, texts))]
        return spark.createDataFrame(rows, SCHEMA)
    return build


#: Texts no operator may trip over.
ODD_TEXTS = [None, "", " \n\t", "...", "a", "one two", "Same text here, twice over.",
             "Same text here, twice over.", "ß ﬁ İ İx", "퟿\u0000 nul", "日本語 テキスト です",
             "\x1c\x1d <|endoftext|> x", "w " * 30000, "longword" * 20000, "é" * 10, "é" * 10]
