"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie.

The pieces and their log scores come from a SentencePiece model file.  A text gets the
whitespace marker for each space and one in front; the path of pieces with the largest sum
of scores wins.  A character that no piece covers counts as unknown, with a score ten below
the worst piece, and is written as its byte pieces (as the unknown piece where the model has none).

A best path breaks wherever no piece holds the two characters side by side: in front of a run
of markers, at line ends, often at punctuation.  Texts are cut there, and each segment is solved
once per task and kept in a bounded table.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from weftline.llm import words as W

MARK = "▁"
UNKNOWN_PENALTY = 10.0  # fixed value: distance of the unknown score below the worst piece
KEPT_SEGMENTS, KEPT_LENGTH = 200_000, 48
FIELDS = "n_tokens bigint, n_unknown bigint, ids array<int>, decoded string"


@dataclass
class DoubleArray:
    """Trie in two integer arrays: child = base[node] + byte + 1, valid if check[child] = node."""

    base: list[int]
    check: list[int]
    value: list[int]
    REACH = 512

    @classmethod
    def build(cls, keys: Iterable[tuple[bytes, int]]) -> DoubleArray:
        """From distinct non-empty keys and their values."""
        tree: list[dict[int, int]] = [{}]
        ends: dict[int, int] = {}
        for key, value in keys:
            node = 0
            for b in key:
                nxt = tree[node].get(b)
                if nxt is None:
                    nxt = tree[node][b] = len(tree)
                    tree.append({})
                node = nxt
            ends[node] = value
        size = 2 * len(tree) + 4096
        base, check, value = np.zeros(size, np.int64), np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        check[0] = 0
        low, high, todo = 1, 1, [(0, 0)]  # single children fill the holes that larger families leave
        while todo:
            node, slot = todo.pop()
            if node in ends:
                value[slot] = ends[node]
            children = tree[node]
            if not children:
                continue
            codes = np.array(sorted(children)) + 1
            while True:
                at = low if len(codes) == 1 else high
                if at + 2 * cls.REACH > len(check):
                    base, check, value = (np.concatenate([x, np.full(len(x), x[-1])]) for x in (base, check, value))
                begins = at + np.flatnonzero(check[at:at + cls.REACH] < 0) - codes[0]
                begins = begins[begins > 0]
                for c in codes[1:]:
                    begins = begins[check[begins + c] < 0]
                if len(begins):
                    break
                if len(codes) == 1:
                    low += cls.REACH
                else:
                    high += cls.REACH // 2
            start = int(begins[0])
            if len(codes) == 1:
                low = max(low, start + int(codes[0]))
            base[slot] = start
            check[start + codes] = slot
            todo += [(children[int(c) - 1], start + int(c)) for c in codes]
        used = int(np.flatnonzero(check >= 0)[-1]) + 258
        return cls(base[:used].tolist(), check[:used].tolist(), value[:used].tolist())


@dataclass
class UnigramModel:
    """Pieces by id, their scores, and which ids are bytes; picklable, with tables built on first use."""

    pieces: list[str]
    scores: list[float]
    unknown: int
    bytes_of: dict[int, int]
    silent: set[int] = field(default_factory=set)

    @classmethod
    def from_file(cls, path: str) -> UnigramModel:
        """Read pieces, scores and kinds from a SentencePiece ``.model`` file."""
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        return cls([sp.id_to_piece(i) for i in range(n)], [sp.get_score(i) for i in range(n)], sp.unk_id(),
                   {i: int(sp.id_to_piece(i)[3:5], 16) for i in range(n) if sp.is_byte(i)},
                   {i for i in range(n) if sp.is_control(i) or sp.is_unused(i)})

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_ready"}

    def ready(self) -> UnigramModel:
        if "_ready" not in self.__dict__:
            special = self.silent | set(self.bytes_of) | {self.unknown}
            normal = {}
            for i, p in enumerate(self.pieces):
                if i not in special and p:
                    normal.setdefault(p, i)
            self._trie = DoubleArray.build((p.encode(), i) for p, i in normal.items())
            self._worst = min((self.scores[i] for i in normal.values()), default=0.0) - UNKNOWN_PENALTY
            self._byte_ids = {b: i for i, b in self.bytes_of.items()}
            self._segments = re.compile(r"[^\n]+|\n" if any(MARK in p.lstrip(MARK) for p in normal) else rf"{MARK}*[^{MARK}\n]+|{MARK}+|\n")
            if any("\n" in p for p in normal):
                self._segments = re.compile(r"(?s).+")
            self._pairs = {p[i:i + 2] for p in normal for i in range(len(p) - 1)}
            self._kept: dict[str, tuple[int, ...]] = {}
            self._parts: dict[str, tuple[int, ...]] = {}
            self._ready = True
        return self

    def __setstate__(self, state):
        self.__dict__.update({k: v for k, v in state.items() if not k.startswith("_")})

    def viterbi(self, text: str) -> tuple[int, ...]:
        """Ids on the best path; of equal paths the one whose last piece is longest."""
        data = text.encode()
        n = len(data)
        best, back, via = [float("-inf")] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        best[0] = 0.0
        base, check, value, scores = self._trie.base, self._trie.check, self._trie.value, self.scores
        at = 0
        while at < n:
            first = data[at]
            wide = at + (1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4)
            here, single, node, i = best[at], False, 0, at
            while i < n:
                child = base[node] + data[i] + 1
                if check[child] != node:
                    break
                node = child
                i += 1
                piece = value[node]
                if piece >= 0:
                    if i == wide:
                        single = True
                    total = here + scores[piece]
                    if total > best[i]:
                        best[i], back[i], via[i] = total, at, piece
            if not single and here + self._worst > best[wide]:
                best[wide], back[wide], via[wide] = here + self._worst, at, -1
            at = wide
        out: list[int] = []
        at = n
        while at:
            begin = back[at]
            if via[at] >= 0:
                out.append(via[at])
            else:
                raw = [self._byte_ids.get(b) for b in data[begin:at]]
                out += [self.unknown] if None in raw else raw[::-1]
            at = begin
        return tuple(out[::-1])

    def encode(self, text: str) -> list[int]:
        """Ids of one text; empty for the empty text."""
        self.ready()
        if not text:
            return []
        kept = self._kept
        parts = self._segments.findall(MARK + text.replace(" ", MARK))
        try:
            return list(chain.from_iterable([kept[p] for p in parts]))
        except KeyError:
            pass
        out: list[int] = []
        for p in parts:
            ids = kept.get(p)
            if ids is None:
                ids = self._solve(p)
                if len(p) <= KEPT_LENGTH:
                    if len(kept) >= KEPT_SEGMENTS:
                        kept.clear()
                    kept[p] = ids
            out += ids
        return out

    def _solve(self, segment: str) -> tuple[int, ...]:
        """Best path of a segment, cut once more between characters that no piece has side by side."""
        if segment.lstrip(MARK).isalpha():
            return self.viterbi(segment)  # letters are nearly always found side by side
        pairs, done = self._pairs, self._parts
        cuts = [0, *[i for i in range(1, len(segment)) if segment[i - 1:i + 1] not in pairs], len(segment)]
        out: list[int] = []
        for a, b in zip(cuts, cuts[1:]):
            part = segment[a:b]
            ids = done.get(part)
            if ids is None:
                ids = self.viterbi(part)
                if len(part) <= KEPT_LENGTH:
                    if len(done) >= KEPT_SEGMENTS:
                        done.clear()
                    done[part] = ids
            out += ids
        return tuple(out)

    def decode(self, ids: Iterable[int]) -> str:
        """Text of ids: byte pieces become bytes, markers become spaces, and the leading one goes."""
        self.ready()
        table = self.__dict__.get("_raw")
        if table is None:
            table = self._raw = [
                bytes([self.bytes_of[i]]) if i in self.bytes_of else b"" if i in self.silent else
                "⁇".encode() if i == self.unknown else p.replace(MARK, " ").encode() for i, p in enumerate(self.pieces)]
        raw = b"".join([table[i] for i in ids])
        return (raw[1:] if raw.startswith(b" ") else raw).decode("utf-8", "replace")


def default_model_path() -> str:
    return os.environ.get("PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")


def encode_texts(docs: DataFrame, model: UnigramModel, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Rows ``(row, n_tokens, n_unknown, ids, decoded)`` for every whole text.

    ``decoded`` is the text that the ids give back: the input itself, save for characters the
    model cannot spell and for markers in the input, which come back as spaces.  Null texts
    have null ``ids`` and ``decoded`` and no tokens; the empty text has none and decodes to
    itself.  Repeated rows give repeated results; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the vocabulary

    def run(texts: pa.Array) -> list[pa.Array]:
        m = shared.value
        ids = [None if t is None else m.encode(t) for t in texts.to_pylist()]
        unknown = m.unknown
        return [pa.array([len(x or ()) for x in ids], pa.int64()),
                pa.array([x.count(unknown) if x else 0 for x in ids], pa.int64()),
                pa.array(ids, pa.list_(pa.int32())),
                pa.array([None if x is None else m.decode(x) for x in ids], pa.string())]

    return W.text_map(docs, text, carry, run, FIELDS)
