import os

import pytest

import corpus_pipeline
from tests.llm.conftest import ODD_TEXTS, SMALL
from tests.llm.test_decontam import brute
from tests.llm.test_packing import check
from tests.llm.test_simhash import brute_classes, brute_fingerprint
from tillwork import session
from tillwork.llm import pii
from tillwork.llm.queries import PII_KEY


@pytest.fixture(scope="module")
def stages(spark, documents):
    """What each stage got and gave."""
    docs, out = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        given, docs = docs, session.materialise(stage(spark, docs, SMALL))
        out[name] = (given, docs)
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_columns(stages, documents):
    for name, (_, given) in stages.items():
        if name != "packing":
            assert given.columns == documents.columns


def test_toxic_documents_go(spark, stages):
    given, kept = stages["toxicity"]
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    gone = set(ids(given)) - set(ids(kept))
    assert sum(labels.get(i) == 0 for i in gone) <= 1
    toxic = [i for i, t in labels.items() if t and i in ids(given)]
    assert sum(i in gone for i in toxic) >= 0.8 * len(toxic)


def test_one_of_each_group_stays(stages):
    given, kept = stages["near-duplicates"]
    classes = brute_classes([(r.doc_id, brute_fingerprint(r.text)) for r in given.collect()])
    assert ids(kept) == sorted(set(classes.values()))


def test_documents_with_benchmark_items_go(spark, stages):
    given, kept = stages["decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    words = {w for _, t in items for w in zip(t.lower().split(), t.lower().split()[1:], t.lower().split()[2:])}
    near = [(r.doc_id, r.text) for r in given.collect()
            if words & set(zip(r.text.lower().split(), r.text.lower().split()[1:], r.text.lower().split()[2:]))]
    assert set(ids(given)) - set(ids(kept)) == {d for d, _ in brute(near, items)}


def test_texts_are_rewritten(stages):
    given, done = stages["surrogates"]
    assert {r.doc_id: r.text for r in done.collect()} == {
        r.doc_id: pii.rewrite(PII_KEY, r.text)[0] for r in given.collect()}


def test_packed(spark, stages):
    given, pieces = stages["packing"]
    length = {}
    for r in pieces.collect():
        length[r.doc_id] = length.get(r.doc_id, 0) + r.length
        assert r.offset + r.length <= 2048
    assert sorted(length) == ids(given)
    from tillwork.llm import packing
    check(packing.pack(given), [(r.doc_id, r.text) for r in given.collect()])


def test_odd_texts(spark, make):
    docs = make(ODD_TEXTS)
    if not os.path.isdir(SMALL):
        pytest.skip("no tables")
    for name, stage in corpus_pipeline.STAGES:
        docs = session.materialise(stage(spark, docs, SMALL))
    assert docs.count() > 0


def test_empty(spark, make):
    docs = make([]).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = session.materialise(stage(spark, docs, SMALL))
    assert docs.count() == 0


def test_key_of_surrogates_is_a_setting(spark, make):
    docs = make(["write to anna.petrova@example.org"])
    rows = []
    for secret in ("one", "two", "one"):
        spark.conf.set(corpus_pipeline.KEY_SETTING, secret)
        rows.append(corpus_pipeline.with_surrogates(spark, docs, SMALL).first().text)
    spark.conf.unset(corpus_pipeline.KEY_SETTING)
    with pytest.warns(UserWarning, match="reverse"):
        rows.append(corpus_pipeline.with_surrogates(spark, docs, SMALL).first().text)
    assert rows[0] == rows[2] and len(set(rows)) == 3
