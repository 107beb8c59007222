"""Counts over the words and lines of many texts at once, from their UTF-8 bytes."""

from __future__ import annotations

import numpy as np

from tidemart.llm.grams import SPACE, runs, span_hashes, windows

SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True


def sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sum of values[start:end] for each span."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[ends] - total[starts]


def repeats(owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(is there an equal hash before it in its document, is there one anywhere else in it)."""
    order = np.lexsort((np.arange(len(owner)), hashes, owner))
    same = np.zeros(len(owner) + 1, bool)
    same[1:-1] = (owner[order][1:] == owner[order][:-1]) & (hashes[order][1:] == hashes[order][:-1])
    before, anywhere = np.zeros(len(owner), bool), np.zeros(len(owner), bool)
    before[order] = same[:-1]
    anywhere[order] = same[:-1] | same[1:]
    return before, anywhere


class TextCounts:
    """Per document of a slice (bytes, offsets); words are runs without ASCII white space."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets, self.n_docs = data, offsets, len(offsets) - 1
        starts, ends, self.doc = runs(~SPACE[data], offsets)
        self.starts, self.ends = starts, ends
        self.hashes = span_hashes(data, starts, ends)
        self.n_words = self.per_doc(np.ones(len(starts), np.int64))

    def per_doc(self, word_values: np.ndarray) -> np.ndarray:
        return np.bincount(self.doc, word_values, self.n_docs)

    def bytes_where(self, mask: np.ndarray) -> np.ndarray:
        return sums(mask, self.offsets[:-1], self.offsets[1:])

    def word_chars(self) -> np.ndarray:
        points = sums((self.data & 0xC0) != 0x80, self.starts, self.ends)
        return self.per_doc(points).astype(np.int64)

    def n_symbols(self) -> np.ndarray:
        return self.bytes_where(SYMBOL[self.data])

    def n_dup_lines(self) -> np.ndarray:
        """Lines that hold a word and equal an earlier line of the document."""
        starts, ends, doc = runs(self.data != 0x0A, self.offsets)
        opens = np.zeros(len(self.data), np.int64)
        opens[self.starts] = 1
        worded = sums(opens, starts, ends) > 0
        starts, ends, doc = starts[worded], ends[worded], doc[worded]
        before, _ = repeats(doc, span_hashes(self.data, starts, ends))
        return np.bincount(doc, before, self.n_docs).astype(np.int64)

    def repeated_words(self, n: int = 8) -> np.ndarray:
        """Which words lie in an n-word window that the document holds more than once."""
        hashes, at = windows(self.hashes, self.doc, n)
        _, again = repeats(self.doc[at], hashes)
        edge = np.zeros(len(self.hashes) + 1, np.int64)
        np.add.at(edge, at[again], 1)
        np.add.at(edge, at[again] + n, -1)
        return np.cumsum(edge)[:-1] > 0
