"""Toxicity severity by cumulative-link ordinal regression on sparse text features.

Severity grades 0 < 1 < ... < K share one weight vector: ``P(grade <= k) = s(t_k - w.x)`` with
ordered thresholds ``t_k``. The answer is the expected severity, the sum over k of
``P(grade > k)``, and the most probable grade.

Features are words, prefixes and suffixes, hashed to 64 bits. From a bounded sample of
labelled documents (``SAMPLE`` per label by hash) Spark counts in how many toxic
and clean ones each feature occurs, and the ``FEATURES`` that tell most are kept; a
feature's value is ``log(1 + occurrences)``, so texts are sparse vectors. The driver fits on
these vectors, which the parameters bound.

Labels that say only toxic or not become grades by amount: toxic documents with no more
occurrences of telling features than the middle one of them are grade 1, the others grade 2.

Null and empty texts have no features and the severity of such a text. Labels of unknown
documents and null labels count for nothing. With labels of one kind only, or none,
severity is 0. Repeated rows get the same answer each.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tillwork.llm.common import slices
from tillwork.llm.words import Words

#: Labelled documents sampled per label, and features kept.
SAMPLE = 3000
FEATURES = 8192
MIN_DOCUMENTS = 3
#: A feature must be this many standard errors more frequent in one kind of document.
MIN_TELLING = 4.0
PREFIXES = (3, 4, 5, 6)
SUFFIXES = (3, 4, 5)
#: Expected severity from which on a document counts as toxic.
REJECT_FROM = 0.2
_SIEVE_BITS = 20


@dataclass
class Model:
    features: np.ndarray  # sorted hashes
    weights: np.ndarray
    thresholds: np.ndarray

    def exceeds(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for each threshold k."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -60, 60)))


def _keys(words: Words):
    yield words.whole(), np.arange(len(words))
    for n in PREFIXES:
        yield words.prefix(n)
    for n in SUFFIXES:
        yield words.suffix(n)


def occurrences(texts: list[str | None], features: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature number, count) of the given features."""
    words = Words(texts)
    sieve = np.zeros(1 << _SIEVE_BITS, bool)
    shift = np.uint64(64 - _SIEVE_BITS)
    sieve[features >> shift] = True
    text, number = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    if len(features):
        for keys, of in _keys(words):
            maybe = np.flatnonzero(sieve[keys >> shift])
            at = np.minimum(np.searchsorted(features, keys[maybe]), len(features) - 1)
            hit = features[at] == keys[maybe]
            text.append(words.of[of[maybe[hit]]])
            number.append(at[hit])
    both = np.concatenate(text) * max(1, len(features)) + np.concatenate(number)
    cells, counts = np.unique(both, return_counts=True)
    return cells // max(1, len(features)), cells % max(1, len(features)), counts


def _scores(texts: list[str | None], model: Model) -> np.ndarray:
    text, number, count = occurrences(texts, model.features)
    return np.bincount(text, np.log1p(count) * model.weights[number], len(texts))


def telling_features(sample: DataFrame, limit: int = FEATURES) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (sorted) of the features that tell toxic from clean documents most, and how much."""
    def present(batches):
        for batch, texts in slices(batches):
            toxic = np.asarray(batch.column(1))
            words = Words(texts)
            for keys, of in _keys(words):
                pairs = np.unique(np.stack([words.of[of].astype(np.uint64), keys]), axis=1)
                label = toxic[pairs[0].astype(np.int64)]
                feature, at = np.unique(pairs[1], return_inverse=True)
                yield pa.RecordBatch.from_arrays([
                    pa.array(feature.view(np.int64)),
                    pa.array(np.bincount(at, label, len(feature)).astype(np.int64)),
                    pa.array(np.bincount(at, 1 - label, len(feature)).astype(np.int64)),
                ], ["feature", "toxic", "clean"])

    counts = sample.select("text", "toxic").mapInArrow(present, "feature long, toxic long, clean long") \
        .groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")) \
        .filter(F.col("toxic") + F.col("clean") >= MIN_DOCUMENTS)
    size = sample.groupBy().agg(F.sum("toxic").alias("t"), F.count("*").alias("n")).first()
    if not size.n or size.t in (0, size.n):
        return np.empty(0, np.uint64), np.empty(0)
    in_toxic, in_clean = F.col("toxic") / size.t, F.col("clean") / (size.n - size.t)
    pooled = (F.col("toxic") + F.col("clean") + 1) / (size.n + 2)
    error = F.sqrt(pooled * (1 - pooled) * (1 / size.t + 1 / (size.n - size.t)))
    best = counts.withColumn("z", (in_toxic - in_clean) / error) \
        .filter(F.abs("z") >= MIN_TELLING).orderBy(F.abs("z").desc(), "feature").limit(limit)
    rows = sorted((r.feature % (1 << 64), r.z) for r in best.select("feature", "z").collect())
    return np.array([f for f, _ in rows], np.uint64), np.array([z for _, z in rows])


def fit(text: np.ndarray, number: np.ndarray, value: np.ndarray, grades: np.ndarray,
        features: np.ndarray, importance: np.ndarray | None = None, rounds: int = 400,
        rate: float = 0.05, decay: float = 1e-3) -> Model:
    """Fit weights and thresholds by gradient steps on the weighted log-likelihood."""
    n, top = len(grades), int(grades.max(initial=0))
    weights = np.zeros(max(1, len(features)))
    if top == 0:
        return Model(features, weights, np.empty(0))
    importance = np.ones(n) if importance is None else importance / importance.mean()
    below = np.cumsum(np.bincount(grades, importance, top + 1))[:-1] / n
    start = np.log(np.clip(below, 1e-3, 1 - 1e-3) / np.clip(1 - below, 1e-3, 1))
    # thresholds are a first one and positive steps, so their order cannot be lost
    free = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 0.05))])
    params = [weights, free]
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in params]
    sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -60, 60)))
    for turn in range(1, rounds + 1):
        steps = np.exp(free[1:])
        thresholds = free[0] + np.concatenate([[0], np.cumsum(steps)])
        score = np.bincount(text, value * weights[number], n)
        upper = np.where(grades < top, sigmoid(thresholds[np.minimum(grades, top - 1)] - score), 1.0)
        lower = np.where(grades > 0, sigmoid(thresholds[np.maximum(grades - 1, 0)] - score), 0.0)
        p = np.maximum(upper - lower, 1e-9)
        up, low = upper * (1 - upper) / p * importance, lower * (1 - lower) / p * importance
        g_weights = np.bincount(number, value * (low - up)[text], len(weights)) / n - decay * weights
        g_threshold = np.bincount(np.minimum(grades, top - 1), np.where(grades < top, up, 0), top)
        g_threshold -= np.bincount(np.maximum(grades - 1, 0), np.where(grades > 0, low, 0), top)
        g_free = np.concatenate([[g_threshold.sum()], np.cumsum(g_threshold[::-1])[::-1][1:] * steps]) / n
        for param, g, (m, v) in zip(params, (g_weights, g_free), state):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            param += rate * (m / (1 - 0.9 ** turn)) / (np.sqrt(v / (1 - 0.99 ** turn)) + 1e-8)
    thresholds = free[0] + np.concatenate([[0], np.cumsum(np.exp(free[1:]))])
    return Model(features, weights, thresholds)


def sample_of(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and ``toxic`` of at most ``SAMPLE`` labelled documents per label."""
    known = labels.select(F.col("doc_id").cast("long"), (F.col("toxic") > 0).cast("int").alias("toxic")) \
        .filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.withColumn("no", F.xxhash64("doc_id"))
    # twice as many as needed: some labels may have no document here
    drawn, clean = (known.filter(F.col("toxic") == y).orderBy("no", "doc_id").limit(2 * SAMPLE) for y in (1, 0))
    drawn = drawn.unionByName(clean)
    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    found = narrow.join(F.broadcast(drawn), "doc_id").dropDuplicates(["doc_id"])
    again = Window.partitionBy("toxic").orderBy("no", "doc_id")  # at most 2 * SAMPLE rows
    ids = found.select("doc_id", "toxic", "no").withColumn("rank", F.row_number().over(again)) \
        .filter(F.col("rank") <= SAMPLE).select("doc_id", "toxic")
    return narrow.join(F.broadcast(ids), "doc_id").dropDuplicates(["doc_id"])


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from the labels of some documents."""
    sample = sample_of(docs, labels).select("doc_id", "text", "toxic").persist()
    features, telling = telling_features(sample)
    shared = sample.sparkSession.sparkContext.broadcast(features)  # at most FEATURES numbers

    def vectors(batches):
        for batch, texts in slices(batches):
            text, number, count = occurrences(texts, shared.value)
            each = np.searchsorted(text, np.arange(len(texts) + 1))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(2),
                pa.array([number[a:b].tolist() for a, b in zip(each, each[1:])], pa.list_(pa.int64())),
                pa.array([count[a:b].tolist() for a, b in zip(each, each[1:])], pa.list_(pa.int64())),
            ], ["doc_id", "toxic", "number", "times"])

    rows = sorted(sample.mapInArrow(
        vectors, "doc_id long, toxic int, number array<long>, times array<long>").collect())
    sample.unpersist()
    toxic = np.array([r.toxic for r in rows], np.int64)
    if not len(features):
        return Model(features, np.zeros(1), np.empty(0))
    text = np.repeat(np.arange(len(rows)), [len(r.number) for r in rows])
    number = np.array([x for r in rows for x in r.number], np.int64)
    count = np.array([x for r in rows for x in r["times"]], np.float64)
    amount = np.bincount(text, np.where(telling[number] > 0, count, 0), len(rows))
    middle = np.median(amount[toxic == 1])
    grades = np.where(toxic == 1, 1 + (amount > middle), 0)
    # documents stand for as many labelled ones as were left out of the sample
    seen = {bool(r.t): r.n for r in labels.groupBy((F.col("toxic") > 0).alias("t")).agg(
        F.count_distinct("doc_id").alias("n")).filter("t is not null").collect()}
    importance = np.where(toxic == 1, seen[True] / max(1, toxic.sum()), seen[False] / max(1, (1 - toxic).sum()))
    return fit(text, number, np.log1p(count), grades, features, importance)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``expected_severity``, ``grade`` and ``toxic`` of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches):
        for batch, texts in slices(batches):
            exceeds = shared.value.exceeds(_scores(texts, shared.value))
            severity = exceeds.sum(axis=1)
            edge = np.ones((len(texts), 1))
            p = -np.diff(np.concatenate([edge, exceeds, 0 * edge], axis=1), axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(severity), pa.array(p.argmax(axis=1).astype(np.int32)),
                 pa.array(severity >= REJECT_FROM)],
                ["doc_id", "expected_severity", "grade", "toxic"])

    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return narrow.mapInArrow(judge, "doc_id long, expected_severity double, grade int, toxic boolean")


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns, whose text isn't toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def fine(batches):
        for batch, texts in slices(batches):
            exceeds = shared.value.exceeds(_scores(texts, shared.value))
            yield batch.filter(pa.array(exceeds.sum(axis=1) < REJECT_FROM))

    return docs.mapInArrow(fine, docs.schema)
