"""Language of code-switched text by a linear-chain conditional random field over words.

Each word has features: itself if it is in the lexicon of frequent words, its affixes, and its
character n-grams. Learned transitions say how likely the language changes from one word to
the next. Forward-backward gives every word's language probabilities within its whole text;
a document's language is the one with the largest mean.

Training: documents' languages label their words, and every label is learned. From each language a bounded
sample (``SAMPLE_DOCS`` different texts by hash, ``SEGMENTS`` stretches of ``SEGMENT_WORDS`` runs of letters, of at
most ``RUN_CHARS`` letters each, as evenly from these texts as they have them) is spliced into sequences, part of
which switch language, so that transitions are learned from both. All languages together give at most
``ALL_DOCS`` texts and ``ALL_SEGMENTS`` stretches, shared evenly, and one of each at least. Weights are fitted on the
driver by steps over ``BATCH`` sequences, which touch the weights of their own features only; a table of at most
``WEIGHTS`` weights takes fewer buckets when there are more languages.

A null text or one without letters is ``und`` with score 0; without a labelled document
so is every text. Repeated rows get the same answer each, and count as one text in training. Long texts are taken
whole: chains are cut into blocks whose transfer matrices are multiplied, which is exact. A text needs memory
in proportion to its words times the languages.
"""

from __future__ import annotations

import heapq
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tillwork import session
from tillwork.llm.common import slices
from tillwork.llm.words import Words

#: Texts and stretches sampled from each language, from all of them, and the words of a stretch.
SAMPLE_DOCS = 300
SEGMENTS = 1200
ALL_DOCS = 9_600
ALL_SEGMENTS = 9_600
SEGMENT_WORDS = 24
#: Longer runs of letters are cut in a stretch, as in texts without white space.
RUN_CHARS = 64
LEXICON = 4000
AFFIXES = (1, 2, 3, 4)
GRAMS = (1, 2, 3)
#: Share of training sequences that switch language.
SWITCHING = 0.3
BUCKETS = 1 << 17
#: Weights of all languages together.
WEIGHTS = 1 << 24
#: Sequences of a training step.
BATCH = 128
BLOCK = 32
#: Feature weights looked up at a time.
LOOKUP = 1 << 23
UNKNOWN = "und"


@dataclass
class Model:
    languages: list[str]
    lexicon: np.ndarray  # sorted hashes
    weights: np.ndarray  # [buckets, languages]
    transitions: np.ndarray  # [languages, languages]
    start: np.ndarray


def buckets(languages: int) -> int:
    """Rows of the table of weights, a power of two."""
    fitting = max(1, WEIGHTS // max(1, languages))
    return min(BUCKETS, 1 << fitting.bit_length() - 1)


def _feature_sets(words: Words, lexicon: np.ndarray, rows: int):
    """(bucket, word) arrays of every kind of feature."""
    shift = np.uint64(64 - rows.bit_length() + 1)
    whole = words.whole()
    if len(lexicon):
        at = np.minimum(np.searchsorted(lexicon, whole), len(lexicon) - 1)
        known = np.flatnonzero(lexicon[at] == whole)
        yield (whole[known] >> shift).astype(np.int64), known
    for n in AFFIXES:
        for keys, of in (words.prefix(n), words.suffix(n)):
            yield (keys >> shift).astype(np.int64), of
    for n in GRAMS:
        keys, of = words.grams(n)
        yield (keys >> shift).astype(np.int64), of


def _emissions(words: Words, model: Model) -> np.ndarray:
    k = len(model.languages)
    out = np.zeros((len(words), k), np.float32)
    step = max(1, LOOKUP // k)
    for bucket, of in _feature_sets(words, model.lexicon, len(model.weights)):
        for at in range(0, len(of), step):
            some, rows = of[at:at + step], model.weights[bucket[at:at + step]]
            first = np.flatnonzero(np.diff(some, prepend=-1))
            out[some[first]] += np.add.reduceat(rows, first, axis=0) if len(first) < len(some) else rows
    return out


def _normal(x: np.ndarray) -> np.ndarray:
    return x / x.sum(axis=tuple(range(1, x.ndim)), keepdims=True)


def marginals(emissions: np.ndarray, of: np.ndarray, model: Model) -> np.ndarray:
    """Probabilities of each word's language given its whole text; ``of`` is ascending."""
    n, k = emissions.shape
    if n == 0:
        return np.zeros((0, k), np.float32)
    likely = np.exp(emissions - emissions.max(axis=1, keepdims=True))
    step = np.exp(model.transitions - model.transitions.max()).astype(np.float32)
    start = _normal(np.exp(model.start - model.start.max())[None]).astype(np.float32)[0]
    # longer blocks where there are many languages, so that matrices need memory by the words alone
    block = max(BLOCK, k * k // 8)
    first_word = np.flatnonzero(np.diff(of, prepend=-1))
    size = np.diff(first_word, append=n)
    blocks = -(-size // block)
    first_block = np.cumsum(blocks) - blocks
    text = np.repeat(np.arange(len(size)), blocks)
    place = np.arange(len(text)) - first_block[text]
    begin = first_word[text] + place * block
    used = np.minimum(block, size[text] - place * block)
    head = place == 0
    # blocks by length, so that those with a t-th word are the first ones
    by_length = np.argsort(-used, kind="stable")
    reach = [int(x) for x in np.searchsorted(-used[by_length], -np.arange(1, used.max() + 1), side="right")]

    # transfer matrix of each block: from the state before its first word to that of its last
    several = np.flatnonzero(blocks[text] > 1)
    slot = np.full(len(text), -1)
    slot[several] = np.arange(len(several))
    across = np.broadcast_to(np.eye(k, dtype=np.float32), (len(several), k, k)).copy()
    for t in range(int(used.max()) if len(several) else 0):
        some = by_length[:reach[t]]
        some = some[slot[some] >= 0]
        nxt = (across[slot[some]].reshape(-1, k) @ step).reshape(-1, k, k)
        if t == 0:  # a text's first word has no transition before it
            nxt[head[some]] = np.eye(k, dtype=np.float32)
        across[slot[some]] = _normal(nxt * likely[begin[some] + t][:, None, :])
    before = np.empty((len(text), k), np.float32)
    before[head] = start
    behind = np.ones((len(text), k), np.float32) / k
    longest = np.argsort(-blocks, kind="stable")
    longest = longest[:np.searchsorted(-blocks[longest], -1, side="left")]
    many = blocks[longest]
    state = np.broadcast_to(start, (len(size), k)).copy()
    for j in range(int(many[0]) if len(many) else 0):
        some = longest[:np.searchsorted(-many, -j, side="left")]
        at = first_block[some] + j
        before[at] = state[some]
        state[some] = _normal(np.matmul(state[some][:, None, :], across[slot[at]])[:, 0])
    state = np.full((len(size), k), 1 / k, np.float32)
    for j in range(int(many[0]) if len(many) else 0):
        some = longest[:np.searchsorted(-many, -j, side="left")]
        at = first_block[some] + blocks[some] - 1 - j
        behind[at] = state[some]
        state[some] = _normal(np.matmul(across[slot[at]], state[some][:, :, None])[:, :, 0])

    forward = np.empty((n, k), np.float32)
    now = before
    for t, many in enumerate(reach):
        some = by_length[:many]
        nxt = now[some] @ step
        if t == 0:
            nxt[head[some]] = now[some][head[some]]
        now[some] = forward[begin[some] + t] = _normal(nxt * likely[begin[some] + t])
    now = behind
    for t in range(len(reach) - 1, -1, -1):
        some = by_length[:reach[t]]
        at = begin[some] + t
        forward[at] = _normal(forward[at] * now[some])
        now[some] = _normal((now[some] * likely[at]) @ step.T)
    return forward


def _sequences(segments: list[tuple[int, str]], rng) -> list[list[int]]:
    """Sequences of segment numbers; part of them switch language."""
    order = rng.permutation(len(segments)).tolist()
    out = []
    while order:
        several = rng.integers(2, 4) if rng.random() < SWITCHING else 1
        out.append([order.pop() for _ in range(min(several, len(order)))])
    return out


def _summed(rows: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys and the sums of their rows."""
    order = np.argsort(keys, kind="stable")
    first = np.flatnonzero(np.diff(keys[order], prepend=-1))
    return keys[order][first], np.add.reduceat(rows[order], first, axis=0)


def fit(segments: list[tuple[str, str]], rounds: int = 12, rate: float = 0.3, seed: int = 7) -> Model:
    """Fit on (language, text) stretches by adaptive gradient steps on the chain's log-likelihood."""
    segments = sorted(segments)
    names = sorted({lang for lang, _ in segments})
    label = {lang: i for i, lang in enumerate(names)}
    k, rng = len(names), np.random.default_rng(seed)
    words = Words([t for _, t in segments])
    whole, first, word_no, counts = np.unique(
        words.whole(), return_index=True, return_inverse=True, return_counts=True)
    often = whole[np.argsort(-counts, kind="stable")[:LEXICON]]
    model = Model(names, np.sort(often), np.zeros((buckets(k), k), np.float32),
                  np.zeros((k, k), np.float32), np.zeros(k, np.float32))
    if k < 2 or not len(words):
        return model
    # equal words have equal features, so these are kept for distinct words only
    place = np.full(len(words), -1)
    place[first] = np.arange(len(first))
    sets = [(b[place[of] >= 0].astype(np.int32), place[of][place[of] >= 0].astype(np.int32))
            for b, of in _feature_sets(words, model.lexicon, len(model.weights))]
    bucket, owner = (np.concatenate(x) for x in zip(*sets))
    bucket = bucket[np.argsort(owner, kind="stable")]
    features = np.bincount(owner, minlength=len(first))
    begins = np.cumsum(features) - features
    del sets, owner

    at = np.concatenate([[0], np.cumsum(np.bincount(words.of, minlength=len(segments)))])
    truths = np.array([label[lang] for lang, _ in segments])[words.of]
    rows = [np.concatenate([np.arange(at[x], at[x + 1]) for x in sequence])
            for sequence in _sequences(segments, rng)]
    rows = [r for r in rows if len(r)]
    seen = [np.zeros_like(p) for p in (model.weights, model.transitions, model.start)]

    def climb(p: np.ndarray, squares: np.ndarray, g: np.ndarray, some=slice(None)) -> None:
        squares[some] += g * g
        p[some] += rate * g / (np.sqrt(squares[some]) + 1e-6)

    for _ in range(rounds):
        order = rng.permutation(len(rows))
        for some in (order[i:i + BATCH] for i in range(0, len(order), BATCH)):
            # longest first, so that those with a t-th word are the first ones
            batch = sorted((rows[i] for i in some), key=len, reverse=True)
            sizes = np.array([len(r) for r in batch])
            flat, heads = np.concatenate(batch), np.cumsum(sizes) - sizes
            live = [heads[:n] for n in np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1), side="right")]
            used, word = np.unique(word_no[flat], return_inverse=True)
            many = features[used]
            spread = np.repeat(np.arange(len(used)), many)
            inside = np.arange(len(spread)) - np.repeat(np.cumsum(many) - many, many)
            mine = bucket[begins[used][spread] + inside]
            _, score = _summed(model.weights[mine], spread)
            e = score[word]
            e = np.exp(e - e.max(axis=1, keepdims=True))
            a = np.exp(model.transitions - model.transitions.max())
            post, now = np.empty_like(e), np.exp(model.start - model.start.max())[None]
            for t, h in enumerate(live):
                now = _normal((now[:len(h)] @ a if t else now) * e[h + t])
                post[h + t] = now
            back, g_trans = np.full((len(batch), k), 1 / k, np.float32), np.zeros_like(model.transitions)
            for t in range(len(live) - 1, -1, -1):
                h = live[t]
                ahead = e[h + t] * back[:len(h)]
                if t:
                    past = post[h + t - 1]
                    past = past / ((past @ a) * ahead).sum(axis=1, keepdims=True)
                    g_trans -= a * (past.T @ ahead)
                    np.add.at(g_trans, (truths[flat[h + t - 1]], truths[flat[h + t]]), 1)
                post[h + t] = _normal(post[h + t] * back[:len(h)])
                back[:len(h)] = _normal(ahead @ a.T)
            g = -post
            g[np.arange(len(flat)), truths[flat]] += 1
            _, g_word = _summed(g, word)
            touched, g_weights = _summed(g_word[spread], mine)
            climb(model.weights, seen[0], g_weights / len(flat), touched)
            climb(model.transitions, seen[1], g_trans / len(flat))
            climb(model.start, seen[2], g[heads].sum(axis=0) / len(flat))
    return model


def held_out(doc_id: Column) -> Column:
    """A quarter of all documents by checksum of their id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


_RUN = re.compile(rf"[^\W\d_]{{1,{RUN_CHARS}}}")


def stretches_of(doc_id: int, text: str | None, most: int) -> list[str]:
    """At most ``most`` stretches of a text, those to be taken first in front."""
    runs = _RUN.findall(text or "")
    begins = heapq.nsmallest(most, range(0, len(runs), SEGMENT_WORDS),
                             key=lambda at: (zlib.crc32(f"{doc_id}:{at}".encode()), at))
    return [" ".join(runs[at:at + SEGMENT_WORDS]) for at in begins]


def training_segments(docs: DataFrame) -> list[tuple[str, str]]:
    """The bounded sample: stretches of words of documents that may be learned from."""
    allowed = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"),
                          F.col("lang").cast("string")) \
        .filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    session.raise_group_limit(docs.sparkSession, max(SAMPLE_DOCS, SEGMENTS))
    # each text of a language once, by its copy with the smallest id
    own = F.struct("lang", F.xxhash64("text").alias("text_hash"))
    several = allowed.groupBy(own.alias("own")).agg(F.min("doc_id").alias("doc_id")).select("own.*", "doc_id")
    first = Window.partitionBy("lang").orderBy("text_hash")
    chosen = session.materialise(several.withColumn("no", F.row_number().over(first))
                                 .filter(F.col("no") <= SAMPLE_DOCS))
    languages = max(1, chosen.select("lang").distinct().count())
    texts, each = (max(1, min(some, whole // languages))
                   for some, whole in ((SAMPLE_DOCS, ALL_DOCS), (SEGMENTS, ALL_SEGMENTS)))
    chosen = chosen.filter(F.col("no") <= texts).select("lang", "text_hash", "doc_id")
    rows = allowed.withColumn("text_hash", F.xxhash64("text")) \
        .join(chosen, ["doc_id", "lang", "text_hash"]) \
        .groupBy("doc_id", "lang", "text_hash").agg(F.any_value("text").alias("text"))

    def cut(batches):
        for batch, some in slices(batches):
            ids, langs = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            out = [(i, no, lang, stretch) for i, lang, text in zip(ids, langs, some)
                   for no, stretch in enumerate(stretches_of(i, text, each))]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)],
                                                 ["doc_id", "nth", "lang", "stretch"])

    stretches = rows.select("doc_id", "text", "lang").mapInArrow(
        cut, "doc_id long, nth long, lang string, stretch string")
    pick = Window.partitionBy("lang").orderBy("nth", F.xxhash64("doc_id"), "doc_id", "stretch")
    picked = stretches.withColumn("no", F.row_number().over(pick)).filter(F.col("no") <= each)
    return [(r.lang, r.stretch) for r in picked.select("lang", "stretch").collect()]


def predict_texts(texts: list[str | None], model: Model) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language and score of each text, and each language's mean probability."""
    words = Words(texts)
    k = len(model.languages)
    if not k:
        return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros((len(texts), 0))
    probable = marginals(_emissions(words, model), words.of, model)
    n = np.bincount(words.of, minlength=len(texts))
    mean = np.stack([np.bincount(words.of, probable[:, j], len(texts)) for j in range(k)], axis=1)
    mean = mean / np.maximum(1, n)[:, None]
    best = mean.argmax(axis=1)
    score = np.where(n > 0, np.clip(mean.max(axis=1), 0, 1), 0.0)
    return [model.languages[b] if c else UNKNOWN for b, c in zip(best, n)], score, mean


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` of each row, from its text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by WEIGHTS

    def label(batches):
        for batch, texts in slices(batches, limit=max(1, 16_000_000 // max(16, len(shared.value.languages)))):
            names, score, _ = predict_texts(texts, shared.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names), pa.array(score)],
                                             ["doc_id", "lang_pred", "score"])

    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return narrow.mapInArrow(label, "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the documents that are not held out and predict all of them."""
    found = predict(docs, fit(training_segments(docs)))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
