"""Hashed text features in numpy, sparse matrices without a further library, and linear models on them."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from weftline.llm import words as W

PREFIXES = (4, 6)


def word_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text index, feature hash, words per text): lower-case words and their beginnings, one entry per occurrence."""
    w = W.words(texts, W.ALNUM, W.LOWER_CASE)
    doc = w.text_of_word()
    kinds = [w.hash, *[w.prefixes(n) for n in PREFIXES]]
    return np.tile(doc, len(kinds)), np.concatenate(kinds), w.counts


def distinct_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct feature hashes of each text, joined, and their number per text."""
    doc, h, _ = word_features(texts)
    if not len(doc):
        return h, np.zeros(len(texts), np.int64)
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[new], np.bincount(doc[new], minlength=len(texts))


@dataclass
class Vocabulary:
    """Sorted feature hashes with a small filter in front of the search."""

    hashes: np.ndarray

    def __post_init__(self):
        self.hashes = np.sort(np.asarray(self.hashes, np.uint64))
        self.filter = np.zeros(1 << 16, bool)
        self.filter[(self.hashes >> np.uint64(48)).astype(np.int64)] = True

    def places(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which entries of ``h`` are known, and their column numbers."""
        if not len(self.hashes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        maybe = np.flatnonzero(self.filter[(h >> np.uint64(48)).astype(np.int64)])
        spot = np.minimum(np.searchsorted(self.hashes, h[maybe]), len(self.hashes) - 1)
        known = self.hashes[spot] == h[maybe]
        return maybe[known], spot[known]

    def rows(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (text, column) pairs of a string array, and words per text."""
        doc, h, counts = word_features(texts)
        at, col = self.places(h)
        pairs = np.unique(doc[at] * len(self.hashes) + col) if len(at) else np.zeros(0, np.int64)
        return pairs // max(1, len(self.hashes)), pairs % max(1, len(self.hashes)), counts


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def row_sums(row: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(row, values, minlength=n)
