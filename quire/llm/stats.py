"""Counts and shares of whole documents, many documents at a time."""

from __future__ import annotations

import numpy as np

from quire.llm.common import hashed, mixed, word_array, words

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True
_POINT = np.zeros(256, dtype=bool)
_POINT[list(b".,;:?")] = True
_MULTIPLIER = np.uint64(0x9FB21C651E98DF25)


def per_document(mask: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many bytes of each document are marked."""
    sums = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
    return sums[at[1:]] - sums[at[:-1]]


def _keyed(values: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """The values made distinct by document."""
    return mixed(values ^ mixed(doc.astype(np.uint64) + np.uint64(1)))


def _distinct(values: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """How many distinct values each document has."""
    _, first = np.unique(_keyed(values, doc), return_index=True)
    return np.bincount(doc[first], minlength=n)


def windows(hashes: np.ndarray, doc: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of every window of `width` words inside one document."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total = total * _MULTIPLIER + hashes[k : k + n]
    begins = np.flatnonzero(doc[:n] == doc[width - 1 :])
    return begins, mixed(total[begins])


class Words:
    """The words of a step's documents: hashes, document numbers, and counts that rules and features need."""

    def __init__(self, data: np.ndarray, at: np.ndarray):
        self.data, self.at, self.n = data, at, len(at) - 1
        self.starts, self.ends, self.doc = words(data, at)
        self.hashes = hashed(word_array(data, self.starts, self.ends))
        self.n_words = np.bincount(self.doc, minlength=self.n).astype(np.int64)

    def word_chars(self) -> np.ndarray:
        points = np.concatenate(([0], np.cumsum((self.data & 0xC0) != 0x80)))
        return np.bincount(self.doc, weights=points[self.ends] - points[self.starts], minlength=self.n).astype(np.int64)

    def n_symbols(self) -> np.ndarray:
        return per_document(_SYMBOL[self.data], self.at)

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(begins, ends, documents) of the lines that hold a word, parted at line feeds."""
        breaks = np.flatnonzero(self.data == 10)
        full = self.at[:-1] < self.at[1:]
        begins = np.unique(np.concatenate((self.at[:-1][full], breaks + 1)))
        begins = begins[begins < len(self.data)]
        doc = np.searchsorted(self.at, begins, "right") - 1
        ends = np.minimum(np.append(breaks, len(self.data))[np.searchsorted(breaks, begins)], self.at[1:][doc])
        held = np.searchsorted(self.starts, ends) > np.searchsorted(self.starts, begins)
        return begins[held], ends[held], doc[held]

    def n_lines_and_dup_lines(self) -> tuple[np.ndarray, np.ndarray]:
        begins, ends, doc = self.lines()
        if not len(begins):
            return np.zeros(self.n, np.int64), np.zeros(self.n, np.int64)
        n_lines = np.bincount(doc, minlength=self.n)
        return n_lines, n_lines - _distinct(spans(self.data, begins, ends), doc, self.n)

    def n_repeat_words(self, width: int = 8) -> np.ndarray:
        begins, found = windows(self.hashes, self.doc, width)
        out = np.zeros(self.n, np.int64)
        if len(begins):
            _, which, count = np.unique(_keyed(found, self.doc[begins]), return_inverse=True, return_counts=True)
            again = begins[count[which] > 1]
            if len(again):
                cover = np.zeros(len(self.hashes) + 1, np.int64)
                np.add.at(cover, again, 1)
                np.add.at(cover, again + width, -1)
                out = np.bincount(self.doc[np.cumsum(cover[:-1]) > 0], minlength=self.n)
        return out

    def grams(self, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """(bucket, document) of every hashed word and pair of neighbouring words."""
        pairs, pair_hashes = windows(self.hashes, self.doc, 2)
        m = np.uint64(buckets - 1)
        return np.concatenate((self.hashes & m, pair_hashes & m)).astype(np.int64), np.concatenate((self.doc, self.doc[pairs]))

    def features(self) -> np.ndarray:
        """A row of statistics for each document; NAMES has what they are."""
        chars, n = self.word_chars(), np.maximum(self.n_words, 1)
        each = np.maximum(chars, 1)
        n_lines, dup = self.n_lines_and_dup_lines()
        lengths = self.ends - self.starts
        last = self.data[self.ends - 1] if len(self.ends) else np.zeros(0, np.uint8)
        first = self.data[self.starts] if len(self.starts) else last
        same = np.concatenate(([False], (self.hashes[1:] == self.hashes[:-1]) & (self.doc[1:] == self.doc[:-1])))[: len(self.doc)]
        by = lambda mask: np.bincount(self.doc[mask], minlength=self.n) / n
        upper = _UPPER[self.data]
        upper_words = np.concatenate(([0], np.cumsum(upper)))
        shouted = (upper_words[self.ends] - upper_words[self.starts]) * 2 > lengths
        return np.column_stack(
            [
                np.log1p(self.n_words),
                np.minimum(chars / n, 30),
                per_document(upper, self.at) / each,
                self.n_symbols() / each,
                per_document(self.data == 33, self.at) / each,
                per_document(_DIGIT[self.data], self.at) / each,
                per_document(_POINT[self.data], self.at) / each,
                dup / np.maximum(n_lines, 1),
                self.n_repeat_words() / n,
                _distinct(self.hashes, self.doc, self.n) / n ** 0.9 if len(self.doc) else np.zeros(self.n),
                by(same),
                by(lengths <= 3),
                np.log1p(self.n_words / np.maximum(n_lines, 1)),
                by(shouted & (lengths > 1)),
                by(_SYMBOL[last] | (last == 33)),
                by(_UPPER[first]),
                by(last == 46),
                by((lengths == 1) & _SYMBOL[last]),
            ]
        )


NAMES = ("log_words", "word_length", "upper", "symbols", "exclamations", "digits", "points", "dup_lines", "repeat_words", "variety", "same_as_last", "short_words", "words_a_line", "shouted", "symbol_end", "capital_start", "stop_end", "symbol_words")


def spans(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans that do not overlap, in order."""
    import pyarrow as pa

    lengths = ends - begins
    offsets = np.zeros(len(begins) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    which = np.repeat(begins - offsets[:-1], lengths) + np.arange(offsets[-1])
    return hashed(pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[which]))]))
