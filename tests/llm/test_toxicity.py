import random

import numpy as np

from tests.llm.conftest import ODD_TEXTS
from tillwork.llm import toxicity


def corpus(n=400, seed=4):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    texts, toxic = [], []
    for i in range(n):
        w = [rng.choice(words) for _ in range(rng.randint(20, 120))]
        bad = i % 4 == 0
        for _ in range(rng.randint(2, 12) if bad else 0):
            w.insert(rng.randrange(len(w)), rng.choice(["zonk", "Zwerk!", "quoxy" + rng.choice(words)]))
        texts.append(" ".join(w))
        toxic.append(int(bad))
    return texts, toxic


def test_held_out_accuracy_and_order(spark, make):
    texts, toxic = corpus()
    docs = make(texts)
    labels = spark.createDataFrame([(i, y) for i, y in enumerate(toxic) if i % 2 == 0] + [(9999, 1), (7, None)],
                                   "doc_id long, toxic int")
    labels = labels.unionByName(spark.createDataFrame([(i, y) for i, y in enumerate(toxic) if i % 8 == 1],
                                                      "doc_id long, toxic int"))
    model = toxicity.learn(docs, labels)
    assert len(model.thresholds) == 2 and model.thresholds[0] < model.thresholds[1]
    rows = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    right = [rows[i].toxic == bool(y) for i, y in enumerate(toxic) if i % 2]
    assert sum(right) >= 0.97 * len(right)
    amount = lambda i: sum(x in texts[i].lower() for x in [])
    count = lambda i: texts[i].lower().count("zonk") + texts[i].lower().count("zwerk") + texts[i].count("quoxy")
    severe = [rows[i].expected_severity for i in range(400) if count(i) >= 10]
    mild = [rows[i].expected_severity for i in range(400) if 1 <= count(i) <= 3]
    assert amount(0) == 0 and np.mean(severe) > np.mean(mild) + 0.3
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in rows.items() if not r.toxic}


def test_gradient_finds_ordered_thresholds():
    rng = np.random.default_rng(1)
    x = rng.normal(size=600) ** 2
    grades = np.digitize(x + 0.1 * rng.normal(size=600), [0.5, 2.0])
    model = toxicity.fit(np.arange(600), np.zeros(600, np.int64), x, grades, np.array([1], np.uint64))
    severity = model.exceeds(x * model.weights[0]).sum(axis=1)
    assert np.corrcoef(severity, grades)[0, 1] > 0.85


def test_odd_texts_and_labels(spark, make):
    docs = make(ODD_TEXTS)
    for labels in ([], [(0, 1)], [(i, 1) for i in range(len(ODD_TEXTS))], [(i, i % 2) for i in range(len(ODD_TEXTS))]):
        model = toxicity.learn(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        rows = toxicity.score(docs, model).collect()
        assert len(rows) == len(ODD_TEXTS) and all(r.expected_severity >= 0 for r in rows)
        if len({y for _, y in labels}) < 2:
            assert not any(r.toxic for r in rows)
    assert toxicity.score(docs.limit(0), model).count() == 0
