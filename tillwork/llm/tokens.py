"""Token ids of whole texts by the ``tokenizers`` library, each distinct piece encoded once per worker.

Both vocabularies in use never join characters across the place where a run of
white space ends or begins in the way ``PIECES`` cuts, so a text's ids are those of its
pieces in turn. Texts with control characters that only Python counts as white
space, or with a special token's string, are encoded whole.

A piece of letters is one word to either vocabulary, and punctuation behind letters another one. So the library's model
is asked for words of Latin letters directly, without the search for words; an encoder does so only if its
vocabulary answers some probes alike both ways.

``Encoder.column`` takes many texts at once: their bytes are cut where white space begins, and behind letters, and each
distinct piece of the column is looked up once.
"""

from __future__ import annotations

import codecs
import os
import re
import struct
from itertools import islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"
END_ID = 1

#: A word with the one space before it, or the white space between words without that space.
PIECES = re.compile(r" ?\S+|\s+(?!\S)|\s+")
_ODD = re.compile("[\x1c-\x1f]")
_OTHER_SPACE = re.compile(r"[^\S \n]")
#: White space at which columns are cut.
SPACE = "\t\n\x0b\x0c\r "


# how byte vocabularies write bytes: printable ones as they are, the others in their order from U+0100 on
_PRINTED = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_OTHERS = [b for b in range(256) if b not in _PRINTED]
ALPHABET = "".join(chr(b if b in _PRINTED else 256 + _OTHERS.index(b)) for b in range(256))
LINE_END = ALPHABET[0x0A]
#: What a vocabulary does to words before: nothing, or lower case without the spaces.
FOLDS = (lambda pieces: pieces, lambda pieces: pieces.replace(" ", "").lower())
PROBES = ("a", "The", "zqxjk", "Zqxjk", "HELLO", "internationalisation", "s", "t", "Été", "straße", "ñ")
#: A word of Latin letters, and the same with the punctuation behind it, which is cut off.
LETTERS = re.compile(r"[A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff]+")
LATIN = re.compile(rf"({LETTERS.pattern})([.,;:!?$%&*|#<>()\[\]{{}}]*)")


def _bytes(characters: str) -> np.ndarray:
    """For each byte whether it is one of these."""
    table = np.zeros(256, bool)
    table[list(characters.encode())] = True
    return table


_IS_SPACE = _bytes(SPACE)
_IS_ODD = _bytes("\x1c\x1d\x1e\x1f")
_IS_LETTER = _bytes("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
_IS_MARK = _bytes(".,;:!?$%&*|#<>()[]{}")


def _buffers(texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of texts without nulls, and where each begins and the last one ends."""
    _, at, data = texts.buffers()
    at = np.frombuffer(at, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(data or b"", np.uint8)[at[0]:at[-1]]
    return raw, at - at[0]


class Known(dict):
    """Ids of words, with ``before`` in front of them.

    A word asked for in vain is noted in ``missed`` with an empty buffer, which is given back for its ids, so
    that the unknown words of a text are found together.
    """

    def __init__(self, before: str, given=()) -> None:
        super().__init__(given)
        self.before = before
        self.missed: dict[str, bytearray] = {}

    def __missing__(self, word: str) -> bytearray:
        return self.missed.setdefault(word, bytearray())

    def first(self, share: float) -> Known:
        """The words met first, which are those that come often."""
        return Known(self.before, islice(self.items(), int(len(self) * share)))


class Encoder:
    """``ids(text)`` gives the ids as little-endian bytes, ``width`` bytes each.

    ``keep`` bounds what a worker remembers: words as they are (``known``) or without the space before them
    (``spaced``), and ``marks``, which are white space and the punctuation behind words. Beyond it the last
    quarter of the words is forgotten, and all marks.
    """

    def __init__(self, name: str, keep: int = 500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        self.model = self.tokenizer.model
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, self.specials)))
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind, self.letter = f"<u{self.width}", "H" if self.width == 2 else "I"
        self.end = np.array([END_ID], self.kind).tobytes()
        self.keep, self.known, self.spaced = keep, Known(""), Known(" ")
        self.marks: dict[str, bytes] = {}
        self.fold = next((f for f in FOLDS if all(
            self._words(PROBES, before, f) == [self._whole(before + p) for p in PROBES] for before in ("", " "))), None)

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def _words(self, words, before: str, fold) -> list[bytes]:
        """Ids of words of Latin letters, by the model alone."""
        folded = fold(before + ("\n" + before).join(words))
        written = codecs.charmap_decode(folded.encode(), "strict", ALPHABET)[0].split(LINE_END)
        tokenize, pack, letter = self.model.tokenize, struct.pack, self.letter
        # one list at a time, or Python searches them all for garbage
        return [pack(f"<{len(ids)}{letter}", *ids) for word in written for ids in ([t.id for t in tokenize(word)],)]

    def _mark(self, mark: str) -> bytes:
        if mark not in self.marks:
            self.marks[mark] = self._whole(mark)
        return self.marks[mark]

    def _learn(self, known: Known) -> None:
        """Find the words missed, and know them from now on."""
        missed, known.missed = known.missed, {}
        new, tailed = {}, []
        for word, buffer in missed.items():
            cut = LATIN.fullmatch(word) if self.fold else None
            if not cut:
                known[word] = ids = self._whole(known.before + word)
                buffer += ids
            elif cut[2]:
                tailed.append((word, buffer, *cut.groups()))
            else:
                new[word] = buffer
        again = [t for t in tailed if t[2] in known]
        for t in tailed:
            if t[2] not in known:
                new.setdefault(t[2], bytearray())
        if new:
            for (word, buffer), ids in zip(new.items(), self._words(new, known.before, self.fold)):
                known[word] = ids
                buffer += ids
        for word, buffer, core, tail in tailed:
            buffer += known[core] + self._mark(tail)
        for word, buffer, _, _ in again:  # others may never come again
            known[word] = bytes(buffer)

    def _split(self, text: str) -> list[bytes | bytearray]:
        """The pieces of a text with single spaces and line ends between its words."""
        out, line_end = [], self._mark("\n")
        for line in text.split("\n"):
            words = line.split(" ")
            out.append(self.known[words[0]])
            out += map(self.spaced.__getitem__, words[1:])
            out.append(line_end)
        out.pop()
        return out

    def _searched(self, text: str) -> list[bytes | bytearray]:
        """The pieces of any text."""
        return [self._mark(p) if p.isspace() else self.spaced[p[1:]] if p[0] == " " else self.known[p]
                for p in PIECES.findall(text)]

    def _unfit(self) -> bool:
        """Whether words missed show that ``_split`` must not cut this text. Such words are never known."""
        if "" in self.known.missed or "" in self.spaced.missed:  # white space at an end or a line's end
            return True
        joined = "\n".join([*self.known.missed, *self.spaced.missed])
        return bool(_OTHER_SPACE.search(joined) or self.special.search(joined))

    def ids(self, text: str | None, end: bool = True) -> bytes:
        """All ids of ``text`` (null: none), with the end id behind them."""
        tail = self.end if end else b""
        if not text:
            return tail
        plain = "  " not in text and "\n\n" not in text
        found = self._split(text) if plain else []
        if not plain or (self.known.missed or self.spaced.missed) and self._unfit():
            self.known.missed, self.spaced.missed = {}, {}
            if _ODD.search(text) or self.special.search(text):
                return self._whole(text) + tail
            found = self._searched(text)
        for known in (self.known, self.spaced):
            if known.missed:
                self._learn(known)
        found.append(tail)
        joined = b"".join(found)
        self._forget()
        return joined

    def _forget(self) -> None:
        if len(self.known) + len(self.spaced) + len(self.marks) > self.keep:
            self.known, self.spaced, self.marks = self.known.first(0.75), self.spaced.first(0.75), {}

    def _whole_texts(self, texts: pa.LargeStringArray, raw: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Which texts must not be cut at all."""
        whole, data = np.zeros(len(texts), bool), raw.tobytes()
        for special in self.specials:
            if special and special.encode() in data:
                whole |= np.asarray(pc.match_substring(texts, special), bool)
        if len(odd := np.flatnonzero(_IS_ODD[raw])):
            whole[np.searchsorted(at, odd, side="right") - 1] = True
        return whole

    def _cuts(self, raw: np.ndarray, at: np.ndarray, whole: np.ndarray) -> np.ndarray:
        """Where pieces begin: texts, white space, and marks behind a letter. ``_searched`` cuts there too, but where
        a piece ends in white space of other kinds."""
        space = _IS_SPACE[raw]
        cut = space.copy()
        cut[1:] &= ~space[:-1]
        if self.fold:
            cut[1:] |= _IS_MARK[raw[1:]] & _IS_LETTER[raw[:-1]]
        for i in np.flatnonzero(whole):
            cut[at[i]:at[i + 1]] = False
        cut[at[:-1][at[:-1] < at[1:]]] = True
        return np.flatnonzero(cut)

    def _found(self, pieces: pa.LargeStringArray, whole: np.ndarray) -> tuple[list, np.ndarray, np.ndarray]:
        """Ids of distinct pieces, of which the ``whole`` ones are whole texts; the place of each piece among them;
        and which pieces must not be cut from what is behind them. If there are any, no ids are given."""
        raw, at = _buffers(pieces)
        first, second = raw[at[:-1]], raw[np.minimum(at[:-1] + 1, len(raw) - 1)]
        spaced = (first == 0x20) & (np.diff(at) > 1) & ~_IS_SPACE[second] & ~whole
        known = ~_IS_SPACE[first] & ~whole
        kinds = [np.flatnonzero(k) for k in (spaced, known, ~spaced & ~known & ~whole, whole)]
        order = np.concatenate(kinds)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        words, bare, others, texts = (pieces.take(pa.array(k)) for k in kinds)
        found, later = [], []
        for memory, column in ((self.spaced, pc.utf8_slice_codeunits(words, 1)), (self.known, bare)):
            asked = column.to_numpy(zero_copy_only=False).tolist()
            ids = list(map(memory.get, asked))
            new = [i for i, known in enumerate(ids) if known is None]
            plain = [i for i in new if LETTERS.fullmatch(asked[i])] if self.fold else []
            if plain:
                learnt = [asked[i] for i in plain]
                for i, word, of_word in zip(plain, learnt, self._words(learnt, memory.before, self.fold)):
                    ids[i] = memory[word] = of_word
            later += [(len(found) + i, memory.before + asked[i]) for i in new if ids[i] is None]
            found += ids
        later += enumerate(others.to_pylist(), len(found))
        unfit = np.zeros(len(pieces), bool)
        unfit[order[[i for i, piece in later if piece.lstrip(SPACE)[-1:].isspace()]]] = True
        if unfit.any():
            return [], place, unfit
        found += [b""] * len(others)
        parts = [self._searched(piece) for _, piece in later]
        for memory in (self.known, self.spaced):
            if memory.missed:
                self._learn(memory)
        for (i, _), part in zip(later, parts):
            found[i] = b"".join(part)
        return found + [self.ids(text, end=False) for text in texts.to_pylist()], place, unfit

    def column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``texts`` (null: none) in turn, with the end id behind each, and how many ids each has."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        raw, at = _buffers(texts)
        if not len(raw):
            return np.full(len(texts), END_ID, self.kind), np.ones(len(texts), np.int64)
        whole, found = self._whole_texts(texts, raw, at), []
        while not found:
            cuts = self._cuts(raw, at, whole)
            pieces = pa.LargeStringArray.from_buffers(
                len(cuts), pa.py_buffer(np.append(cuts, len(raw))), pa.py_buffer(raw)).dictionary_encode()
            index, begins = np.asarray(pieces.indices), np.searchsorted(cuts, at)
            alone = np.zeros(len(pieces.dictionary), bool)
            alone[index[begins[:-1][whole]]] = True
            found, place, unfit = self._found(pieces.dictionary, alone)
            whole[np.searchsorted(at, cuts[unfit[index]], side="right") - 1] = True
        ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))
        distinct = pa.Array.from_buffers(pa.large_binary(), len(found), [
            None, pa.py_buffer(np.concatenate([[0], ends])), pa.py_buffer(b"".join(found))])
        _, ends, data = distinct.take(pa.array(place[index])).buffers()
        ends = np.frombuffer(ends, np.int64, len(cuts) + 1) // self.width
        n = np.diff(ends[begins])
        self._forget()
        return np.insert(np.frombuffer(data, self.kind, ends[-1]), np.cumsum(n), END_ID), n + 1


_ENCODERS: dict[str, Encoder] = {}


def encoder(name: str) -> Encoder:
    """The worker's encoder for a vocabulary; workers serve many tasks."""
    if name not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[name] = Encoder(name)
    return _ENCODERS[name]
