"""Hashed features of words: whole words, affixes and character n-grams."""

from __future__ import annotations

import numpy as np

from tillwork.llm.codes import Rolling, code_points, letters, mix, owners, runs


class Words:
    """The words (runs of letters, lower case) of several texts."""

    def __init__(self, texts: list[str | None]) -> None:
        lowered = [t.lower() if t else t for t in texts]
        self.codes, starts = code_points(lowered)
        self.n_texts = len(texts)
        self.inside = letters()[np.minimum(self.codes, 0x10FFFF)]
        self.begin, self.end = runs(self.inside)
        self.of = owners(starts, self.begin)
        self.rolling = Rolling(self.codes)

    def __len__(self) -> int:
        return len(self.begin)

    def whole(self) -> np.ndarray:
        return self.rolling(self.begin, self.end) ^ np.uint64(1)

    def prefix(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the first ``n`` letters, and the words that are longer."""
        longer = np.flatnonzero(self.end - self.begin > n)
        return self.rolling(self.begin[longer], self.begin[longer] + n) ^ np.uint64(16 + n), longer

    def suffix(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        longer = np.flatnonzero(self.end - self.begin > n)
        return self.rolling(self.end[longer] - n, self.end[longer]) ^ np.uint64(32 + n), longer

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all n-grams inside words, in order, and the words they are in."""
        size = np.maximum(0, self.end - self.begin - n + 1)
        word = np.repeat(np.arange(len(self)), size)
        first = np.cumsum(size) - size
        begin = self.begin[word] + np.arange(len(word)) - first[word]
        if n == 1:
            return mix(self.codes[begin] + np.uint64(48 << 32)), word
        return self.rolling(begin, begin + n) ^ np.uint64(48 + n), word
