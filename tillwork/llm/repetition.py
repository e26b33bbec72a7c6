"""Repetition coverage: how many characters of a text lie in repeated n-grams and lines.

All texts of a slice are one array. Words, lines and n-grams of every length get rolling
hashes from prefix sums; a sort brings equal ones of a text together; and a running count of
repeated n-grams tells which words they cover. Nothing is done per n-gram in Python, and a
text needs memory in proportion to its length.

Null counts as no words. Such a text, like any under ``MIN_WORDS`` words, fails the base
rule. Rows are judged one by one, so repeated rows get the same verdict each.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tillwork.llm.codes import Rolling, code_points, mix, owners, runs
from tillwork.llm.common import slices

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
BASE_WINDOW = 8
#: Characters a rule counts as symbols.
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Limits:
    """Largest share of word characters in later occurrences of repeated n-grams, by length, and in repeated lines."""

    ngrams: dict[int, float] = field(default_factory=lambda: {
        5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10})
    lines: float = 0.2


def _repeated(keys: np.ndarray, later: bool) -> np.ndarray:
    """Which keys occur twice or more; with ``later``, all but the first of each."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    marked = np.zeros(len(keys), bool)
    marked[order[1:][same]] = True
    if not later:
        marked[order[:-1][same]] = True
    return marked


def _covered(marked: np.ndarray, places: np.ndarray, n: int, words: int) -> np.ndarray:
    """Which words lie in a marked n-gram; ``places`` are the words the n-grams begin at."""
    begun = np.zeros(words + 1, np.int64)
    begun[places[marked] + 1] = 1
    begun = np.cumsum(begun)
    to = np.arange(1, words + 1)
    return begun[to] > begun[np.maximum(0, to - n)]


def measure(texts: list[str | None], lengths: tuple[int, ...]) -> dict[str, np.ndarray]:
    """Figures of each text: counts of words, symbols, repeated lines and words, and covered characters."""
    n_texts = len(texts)
    codes, starts = code_points(texts)
    space = (codes == 32) | ((codes >= 9) & (codes <= 13))
    begin, end = runs(~space)
    of = owners(starts, begin)
    chars = end - begin
    rolling = Rolling(codes)
    word = rolling(begin, end)
    total = lambda kept, weights=None: np.bincount(of[kept], weights, n_texts).astype(np.int64)
    symbol = np.isin(codes, np.array([ord(c) for c in SYMBOLS], np.uint32))
    out = {
        "n_words": np.bincount(of, None, n_texts).astype(np.int64),
        "word_chars": np.bincount(of, chars, n_texts).astype(np.int64),
        "n_symbols": np.bincount(owners(starts, np.flatnonzero(symbol)), None, n_texts).astype(np.int64),
    }

    line_end = np.flatnonzero(codes == 10)
    line_begin = np.concatenate([[0], line_end[:-1] + 1]) if len(line_end) else line_end
    first_word = np.searchsorted(begin, line_begin)
    words_in = np.searchsorted(begin, line_end) - first_word
    kept = words_in > 0
    line_begin, line_end, words_in, first_word = (x[kept] for x in (line_begin, line_end, words_in, first_word))
    line_of = owners(starts, line_begin)
    key = rolling(line_begin, line_end) ^ mix(line_of)
    again = _repeated(key, later=True)
    chars_to = np.concatenate([[0], np.cumsum(chars)])
    line_chars = chars_to[first_word + words_in] - chars_to[first_word]
    out["n_dup_lines"] = np.bincount(line_of[again], None, n_texts).astype(np.int64)
    out["dup_line_chars"] = np.bincount(line_of[again], line_chars[again], n_texts).astype(np.int64)

    series = Rolling(word)
    salt = mix(of)
    last_word = np.searchsorted(of, np.arange(n_texts), side="right")[of]
    for n in sorted({*lengths, BASE_WINDOW}):
        places = np.flatnonzero(np.arange(len(begin)) + n <= last_word)
        key = series(places, places + n) ^ salt[places]
        if n in lengths:
            inside = _covered(_repeated(key, later=True), places, n, len(begin))
            out[f"dup_{n}_chars"] = total(inside, chars[inside])
        if n == BASE_WINDOW:
            out["n_repeat_words"] = total(_covered(_repeated(key, later=False), places, n, len(begin)))
    return out


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def coverage(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Per row ``doc_id``, the base figures, covered characters by n-gram length, and the verdicts."""
    lengths = tuple(sorted(limits.ngrams))
    names = [*BASE, "dup_line_chars", *(f"dup_{n}_chars" for n in lengths)]

    def judge(batches):
        for batch, texts in slices(batches):
            found = measure(texts, lengths)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(found[n]) for n in names)], ["doc_id", *names])

    schema = ", ".join(f"{n} long" for n in ["doc_id", *names])
    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    fine = F.col("dup_line_chars") <= limits.lines * F.col("word_chars")
    for n in lengths:
        fine &= F.col(f"dup_{n}_chars") <= limits.ngrams[n] * F.col("word_chars")
    return narrow.mapInArrow(judge, schema).withColumns({"base_failed": failed, "kept": ~failed & fine})
