"""Benchmark decontamination by Wu-Manber search over words.

A window is ``width`` consecutive words of a benchmark item (a shorter item is one window).
Symbols are words and blocks are pairs of words.  A shift table tells how far the search may
jump when a block cannot end a window; where it gives no jump, the block's hash selects the
windows that end so, and the words themselves are compared.  Windows of each length are
searched on their own, so that a short item does not shorten the jumps of the others.

Documents are never shuffled.  Windows are copied to the tasks in blocks of at most
``max_words`` words (items are dealt by hash), one search per block, and all blocks are
searched in the same pass; a benchmark of any size is searched completely.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm import words as W

LANE_WORDS = 512
FIELDS = "n_words bigint, n_hit bigint, items array<string>, spans array<struct<start:int,stop:int>>"


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return W.mix(a * np.uint64(0x9FB21C651E98DF25) + b)


class WindowSet:
    """Search tables for windows of one length in words."""

    def __init__(self, length: int, windows: dict[bytes, list[str]]):
        self.length, self.windows = length, windows
        text = pa.array([w.decode() for w in windows])
        h = W.words(text, W.ALNUM, W.LOWER_CASE).hash.reshape(-1, length)
        self.block = min(2, length)
        ends = [self._block(h[:, j - 1] if j else None, h[:, j]) for j in range(self.block - 1, length)]
        self.bits = min(24, max(12, (len(text) * length * 8).bit_length()))
        self.shift = np.full(1 << self.bits, length - self.block + 1, np.int16)
        for back, keys in enumerate(reversed(ends)):
            np.minimum.at(self.shift, self._slot(keys), back)
        self.suffixes = np.unique(ends[-1])

    def _block(self, a, b):
        return b if self.block == 1 else _pair(a, b)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(64 - self.bits)).astype(np.int64)

    def search(self, w: W.Words) -> list[tuple[int, bytes]]:
        """First word and text of each occurrence."""
        m, h = self.length, w.hash
        room = np.maximum(0, w.counts - m + 1)  # window starts of each text
        lanes = -(-room // LANE_WORDS)
        begin = np.repeat(w.first[:-1], lanes) + W.ranges(lanes) * LANE_WORDS
        limit = np.minimum(begin + LANE_WORDS, np.repeat(w.first[:-1] + room, lanes)) + m - 1
        at = begin + m - 1
        found = []
        while len(at):
            keys = self._block(h[at - 1] if self.block == 2 else None, h[at])
            jump = self.shift[self._slot(keys)]
            stop = jump == 0
            if stop.any():
                spot = np.minimum(np.searchsorted(self.suffixes, keys[stop]), len(self.suffixes) - 1)
                found.append(at[stop][self.suffixes[spot] == keys[stop]] - m + 1)
                jump = np.maximum(jump, 1)
            at = at + jump
            going = at < limit
            at, limit = at[going], limit[going]
        hits = []
        for s in np.concatenate(found) if found else ():
            text = b" ".join(w.word(i) for i in range(s, s + m)).lower()
            if text in self.windows:
                hits.append((int(s), text))
        return hits


def window_sets(items: Iterable[tuple[str, str | None]], width: int) -> list[WindowSet]:
    """Search tables from (item id, text) pairs."""
    by_length: dict[int, dict[bytes, list[str]]] = {}
    for item, text in items:
        w = W.words(pa.array([text], pa.string()), W.ALNUM, W.LOWER_CASE)
        ws = [w.word(i).lower() for i in range(len(w.hash))]  # bytes.lower() folds A-Z alone
        m = min(width, len(ws))
        for i in range(len(ws) - m + 1 if m else 0):
            owners = by_length.setdefault(m, {}).setdefault(b" ".join(ws[i:i + m]), [])
            if not owners or owners[-1] != item:
                owners.append(item)
    return [WindowSet(m, windows) for m, windows in sorted(by_length.items())]


def _searcher(copies: list):
    def search(texts: pa.Array) -> list[pa.Array]:
        w = W.words(texts, W.ALNUM, W.LOWER_CASE)
        hit = np.zeros(len(w.hash) + 1, np.int32)
        items: dict[int, set[str]] = {}
        for copy in copies:
            for tables in copy.value:
                for s, text in tables.search(w):
                    hit[s] += 1
                    # several windows may end one run of hit words, so count openings against closings
                    hit[s + tables.length] -= 1
                    doc = int(np.searchsorted(w.first, s, "right")) - 1
                    items.setdefault(doc, set()).update(tables.windows[text])
        covered = np.cumsum(hit[:-1]) > 0
        upto = np.concatenate([[0], np.cumsum(covered)])
        n_hit = upto[w.first[1:]] - upto[w.first[:-1]]
        owners, spans = [], []
        for d in range(len(texts)):
            owners.append(sorted(items.get(d, ())))
            if not n_hit[d]:
                spans.append([])
                continue
            edge = np.diff(np.concatenate([[0], covered[w.first[d]:w.first[d + 1]].view(np.int8), [0]]))
            spans.append([{"start": int(a), "stop": int(b)} for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))])
        kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
        return [pa.array(w.counts, pa.int64()), pa.array(n_hit, pa.int64()),
                pa.array(owners, pa.list_(pa.string())), pa.array(spans, kind)]

    return search


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                   item_text: str = "text", carry: list[str] | None = None, width: int = 13,
                   max_words: int = 200_000) -> DataFrame:
    """Words of each document that lie in a benchmark window.

    Rows ``(row, n_words, n_hit, items, spans)``: ``row`` packs the carried columns, ``items``
    are the ids whose windows occur, ``spans`` the covered word ranges (stop exclusive).

    Null and empty texts have no words and no hits; a null item text has no windows; a null
    item id is reported as ``"null"``.  Repeated documents each give a row, and repeated items
    one id.  An empty benchmark hits nothing; empty documents give no rows.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(W.column(item_id).cast("string"), F.lit("null")).alias("item"),
                             W.column(item_text).cast("string").alias("text")).dropna()
    # a text has at most one word for each two bytes, and each word is in at most `width` windows
    size = items.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    blocks = max(1, -(-size // (2 * max_words)))
    copies = []
    for b in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b).orderBy("item", "text").toLocalIterator()
        copies.append(spark.sparkContext.broadcast(window_sets(((r["item"], r["text"]) for r in part), width)))
    return W.text_map(docs, text, carry, _searcher(copies), FIELDS)


def is_contaminated(n_words, n_hit):
    """At least one word in twenty is hit."""
    return (n_hit > 0) & (F.lit(20) * n_hit >= n_words)


def items_digest(items):
    """SHA-256 of the sorted item ids, joined by commas."""
    return F.sha2(F.array_join(F.array_sort(items), ","), 256)
