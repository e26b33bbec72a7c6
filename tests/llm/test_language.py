import itertools
import zlib

import numpy as np

from tests.llm.conftest import ODD_TEXTS
from tillwork.llm import language


def toy_model(k=3, seed=1):
    rng = np.random.default_rng(seed)
    return language.Model(list("abc")[:k], np.empty(0, np.uint64), np.zeros((4, k), np.float32),
                          rng.normal(size=(k, k)).astype(np.float32), rng.normal(size=k).astype(np.float32))


def test_forward_backward_equals_enumeration():
    model, rng = toy_model(), np.random.default_rng(2)
    e = rng.normal(size=(7, 3)).astype(np.float32)
    got = language.marginals(e, np.zeros(7, np.int64), model)
    total = np.zeros((7, 3))
    for path in itertools.product(range(3), repeat=7):
        s = model.start[path[0]] + sum(e[t, y] for t, y in enumerate(path))
        s += sum(model.transitions[a, b] for a, b in zip(path, path[1:]))
        for t, y in enumerate(path):
            total[t, y] += np.exp(s)
    assert np.allclose(got, total / total.sum(axis=1, keepdims=True), atol=1e-4)


def test_blocks_are_exact_and_texts_apart():
    model, rng = toy_model(), np.random.default_rng(3)
    sizes = [1, 200, 32, 33, 64, 5]
    e = rng.normal(size=(sum(sizes), 3)).astype(np.float32)
    of = np.repeat(np.arange(len(sizes)), sizes)
    got = language.marginals(e, of, model)
    a, start = np.exp(model.transitions), np.exp(model.start)
    for i in range(len(sizes)):
        x = np.exp(e[of == i].astype(float))
        f, b = [start * x[0]], [np.ones(3)]
        for t in range(1, len(x)):
            f.append((f[-1] / f[-1].sum()) @ a * x[t])
        for t in range(len(x) - 1, 0, -1):
            b.append(a @ (x[t] * b[-1] / b[-1].sum()))
        p = np.array(f) * np.array(b[::-1])
        assert np.allclose(got[of == i], p / p.sum(axis=1, keepdims=True), atol=1e-3)


def test_accuracy_on_held_out_documents(documents):
    truth = {r.doc_id: r.lang for r in documents.collect()}
    rows = language.identify(documents).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    apart = [r.lang_pred == truth[r.doc_id] for r in rows if r.held_out]
    assert sum(apart) >= 0.93 * len(apart)
    assert all(0 <= r.score <= 1 for r in rows)


def test_held_out_labels_are_not_learned(make):
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2]
    docs = make(["some words in here"] * len(ids), ids, lang="xx")
    assert {r.lang_pred for r in language.identify(docs).collect()} == {"und"}


def test_odd_texts(make):
    rows = {r.doc_id: r for r in language.identify(make(ODD_TEXTS)).collect()}
    assert len(rows) == len(ODD_TEXTS)
    for i, t in enumerate(ODD_TEXTS):
        assert (rows[i].lang_pred == "und") == (not any(c.isalpha() for c in t or "")), t
    assert language.identify(make([]).limit(0)).count() == 0


def test_words_of_mixed_text_get_their_own_language():
    rng = np.random.default_rng(0)
    a, b = ["".join(rng.choice(list(s), 5)) for s in ["abcd"] * 60], ["".join(rng.choice(list("wxyz"), 5)) for _ in range(60)]
    stretches = [("one", " ".join(rng.choice(a, 12))) for _ in range(60)] + [("two", " ".join(rng.choice(b, 12))) for _ in range(60)]
    model = language.fit(stretches, rounds=30)
    text = " ".join([*a[:40], *b[:10]])
    words = language.Words([text])
    p = language.marginals(language._emissions(words, model), words.of, model)
    assert [model.languages[i] for i in p.argmax(axis=1)] == ["one"] * 40 + ["two"] * 10
    assert language.predict_texts([text], model)[0] == ["one"]


def test_training_sample_is_bounded(make, monkeypatch):
    monkeypatch.setattr(language, "SEGMENTS", 40)
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 4 != 2][:5]
    docs = make(["今日天気、" * 40_000, "x" * 300_000, "ab cd " * 50_000, "ef." * 9_000, "short one"], ids)
    found = [s for _, s in language.training_segments(docs)]
    assert len(found) == 40 and "short one" in found
    assert max(map(len, found)) < language.SEGMENT_WORDS * (language.RUN_CHARS + 1)
    assert max(len(language.Words([s])) for s in found) <= language.SEGMENT_WORDS
    of = [sum(c in s for s in found) for c in ("今", "xx", "ab", "ef")]
    assert sum(of) == 39 and max(of) - min(of) <= 1


def test_every_language_is_learned():
    rng = np.random.default_rng(4)
    stretches = []
    for i in range(100):
        letters = rng.choice(list("abcdefghijklmnopqrstuvwxyzáéíóúñçß"), 12, replace=False)
        vocabulary = ["".join(rng.choice(letters, rng.integers(3, 8))) for _ in range(60)]
        stretches += [(f"l{i:03d}", " ".join(rng.choice(vocabulary, 24))) for _ in range(12)]
    model = language.fit([s for k, s in enumerate(stretches) if k % 12], rounds=6)
    assert len(model.languages) == 100 and model.weights.size <= language.WEIGHTS
    apart = stretches[::12]
    got = language.predict_texts([t for _, t in apart], model)[0]
    assert sum(a == b for a, (b, _) in zip(got, apart)) >= 95


def test_weights_are_bounded():
    assert language.buckets(4) == language.BUCKETS
    for k in (1, 129, 1000, 70_000):
        assert language.buckets(k) * k <= language.WEIGHTS


def test_more_languages_than_the_sample_shares_out(make, monkeypatch):
    monkeypatch.setattr(language, "ALL_DOCS", 5)
    monkeypatch.setattr(language, "ALL_SEGMENTS", 5)
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 4 != 2][:18]
    docs = make(["some words"] * 9, ids[:9], lang="l0")
    for k in range(1, 10):
        docs = docs.unionByName(make([f"word{'x' * k} of {'y' * k}"], [ids[8 + k]], lang=f"l{k}"))
    assert sorted({lang for lang, _ in language.training_segments(docs)}) == [f"l{k}" for k in range(10)]


def test_copies_count_once_in_training(make, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE_DOCS", 30)
    monkeypatch.setattr(language, "SEGMENTS", 60)
    ids = [i for i in range(3000) if zlib.crc32(str(i).encode()) % 4 != 2]
    copied = " ".join(f"cop{'abcdefgh'[i % 8]}" for i in range(90))
    others = [f"only {'qrstuvwxyz'[i % 10] * (i + 1)}" for i in range(20)]
    docs = make([copied] * 500 + others + [others[0]] * 5, ids[:520] + [ids[500]] * 5)
    found = [s for _, s in language.training_segments(docs)]
    assert sum("cop" in s for s in found) == 4 and len(found) == 24
