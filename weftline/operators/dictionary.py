"""Names of a dictionary table inside texts, by Aho-Corasick automata.

The dictionary is cut into shards of bounded size, and one task per shard builds its automaton, level by level with
numpy; the automata are staged as flat arrays.  A text is read in many lanes in step: a lane starts as many bytes before
its own stretch as the longest name has, so it misses nothing, and the cost follows the length of the texts, not the
number of names.  Texts do not move; some shards at a time travel to them.

Null and empty names are left out and repeated names count once; null and empty texts hold no name.  Positions are code
points, the end exclusive.  Matching is exact: lower-case both sides for another rule.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.session import shared_table

SHARD_BYTES = 4 << 20  # name bytes of one automaton, and so its largest number of nodes
SHARDS_PER_PASS = 4  # automata that travel together: at most about 20 bytes per node
SLICE_BYTES = 1 << 20  # text bytes read in step; a longer text is a slice of its own
LANE_BYTES = 512
DENSE_NODES = 1 << 15  # automata up to this size get a whole table of next states (32 MiB), the same states by one look
_SCRAMBLE = np.uint64(0x9E3779B97F4A7C15)
_STORED = "shard int, data binary, offsets binary, edges binary, fail binary, first_out binary, name_of binary"


class Automaton:
    """Trie edges in a hash table, failure links, and the nearest node that ends a name.

    Edges are numbered level by level; edge ``j`` leads to node ``j + 1`` and is named ``parent * 256 + byte``.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, edges: np.ndarray):
        self.data, self.offsets = data, offsets
        self.size = np.diff(offsets)
        self.longest = int(self.size.max(initial=0))
        self.edge_of = np.concatenate([np.array([-1]), edges]).astype(np.int64)  # by child node
        bits = max(4, int(2 * len(edges)).bit_length())
        self._shift, self._mask = np.uint64(64 - bits), (1 << bits) - 1
        self._slots = np.zeros(1 << bits, np.int32)
        rest = np.arange(1, len(edges) + 1, dtype=np.int32)
        slot = self._slot(edges)
        while len(rest):
            free = self._slots[slot] == 0
            self._slots[slot[free]] = rest[free]  # of several for one slot the last stays
            lost = self._slots[slot] != rest
            rest, slot = rest[lost], (slot[lost] + 1) & self._mask
        self.root = self._child(np.zeros(256, np.int64), np.arange(256))
        self.fail = self.first_out = self.name_of = np.zeros(1, np.int32)
        self.table: np.ndarray | None = None

    @classmethod
    def build(cls, names: list[bytes]) -> Automaton:
        """Automaton of distinct, non-empty names."""
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in names], dtype=np.int64)])
        data = np.frombuffer(b"".join(names), np.uint8)
        size, at, live = np.diff(offsets), np.zeros(len(names), np.int64), np.arange(len(names))
        levels: list[np.ndarray] = []
        nodes = 1
        while len(live := live[size[live] > len(levels)]):
            edges, place = np.unique(at[live] * 256 + data[offsets[live] + len(levels)], return_inverse=True)
            at[live] = nodes + place
            nodes += len(edges)
            levels.append(edges)
        done = cls(data, offsets, np.concatenate(levels) if levels else np.zeros(0, np.int64))
        done.fail, done.first_out = np.zeros(nodes, np.int32), np.zeros(nodes, np.int32)
        done.name_of = np.full(nodes, -1, np.int32)
        done.name_of[at] = np.arange(len(names))
        low = 1
        for depth, edges in enumerate(levels):
            mine = np.arange(low, low + len(edges))
            if depth:
                done.fail[mine] = done.step(done.fail[edges >> 8].astype(np.int64), edges & 255)
            done.first_out[mine] = np.where(done.name_of[mine] >= 0, mine, done.first_out[done.fail[mine]])
            low += len(edges)
        return done

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * _SCRAMBLE) >> self._shift).astype(np.int64)

    def _child(self, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """Child node, 0 where the trie has none."""
        key = state * 256 + byte
        slot = self._slot(key)
        out = self._slots[slot].astype(np.int64)
        todo = np.flatnonzero((out > 0) & (self.edge_of[out] != key))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & self._mask
            out[todo] = self._slots[slot[todo]]
            todo = todo[(out[todo] > 0) & (self.edge_of[out[todo]] != key[todo])]
        return out

    def step(self, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """Next states: the child, else the child of the nearest failure state that has one, else the root."""
        if self.table is not None:
            return self.table[state, byte]
        out, state = self.root[byte], state.copy()
        todo = np.flatnonzero(state)
        while len(todo):
            child = self._child(state[todo], byte[todo])
            found = child > 0
            out[todo[found]] = child[found]
            todo = todo[~found]
            state[todo] = self.fail[state[todo]]
            todo = todo[state[todo] > 0]
        return out

    def densify(self) -> None:
        """Write all next states out, level by level: those of the failure state, with the node's own children over them."""
        edges = self.edge_of[1:]
        table = np.zeros((len(self.edge_of), 256), np.int32)
        low, high = 0, 1
        while low < high:
            table[low:high] = table[self.fail[low:high]]
            first, last = np.searchsorted(edges, [low * 256, high * 256])
            table[edges[first:last] >> 8, edges[first:last] & 255] = np.arange(first + 1, last + 1)
            low, high = first + 1, last + 1
        self.table = table

    def name(self, k: int) -> str:
        return self.data[self.offsets[k]:self.offsets[k + 1]].tobytes().decode()

    def search(self, data: np.ndarray, offsets: np.ndarray, every: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(text, end, name)`` of the names in joined texts, the end as inclusive byte in ``data``.

        Without ``every`` only the longest name that ends at a byte.
        """
        none = np.zeros(0, np.int64)
        if not len(self.edge_of) - 1 or not len(data):
            return none, none, none
        before = self.longest - 1
        lane = max(LANE_BYTES, 2 * self.longest)
        size = np.diff(offsets)
        lanes = -(-size // lane)
        text = np.repeat(np.arange(len(size)), lanes)
        own = offsets[text] + lane * (np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes))
        start = np.maximum(offsets[text], own - before)
        length = np.minimum(own + lane, offsets[text + 1]) - start
        order = np.argsort(-length, kind="stable")
        text, own, start, length = text[order], own[order], start[order], length[order]
        active = np.searchsorted(-length, -np.arange(int(length.max())), side="left")  # lanes longer than the step
        state = np.zeros(len(text), np.int64)
        found: list[tuple[np.ndarray, ...]] = []
        for i, n in enumerate(active):
            at = start[:n] + i
            state = self.step(state[:n], data[at])
            out = self.first_out[state]
            hit = np.flatnonzero((out > 0) & (at >= own[:n]))
            if len(hit):
                found.append((text[hit], at[hit], out[hit]))
        if not found:
            return none, none, none
        texts, ends, nodes = (np.concatenate(x) for x in zip(*found))
        all_found = [(texts, ends, nodes)]
        while every and len(nodes):
            nodes = self.first_out[self.fail[nodes]]
            more = nodes > 0
            texts, ends, nodes = texts[more], ends[more], nodes[more]
            all_found.append((texts, ends, nodes))
        texts, ends, nodes = (np.concatenate(x) for x in zip(*all_found))
        return texts, ends, self.name_of[nodes].astype(np.int64)


@dataclass
class Dictionary:
    """Staged automata of a table of names, one row per shard."""

    automata: DataFrame
    shards: int


def build(names: DataFrame, name_col: str = "name", where: str | None = None, shard_bytes: int = SHARD_BYTES) -> Dictionary:
    """Automata of all distinct names, stored as ``where/automata`` or in the shared folder."""
    distinct = names.select(F.col(name_col).cast("string").alias("name")).filter("name <> ''").distinct()
    total = distinct.agg(F.sum(F.octet_length("name")).alias("n")).first()["n"] or 0
    shards = max(1, -(-total // shard_bytes))

    def one(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        a = Automaton.build(sorted(x.encode() for x in table.column("name").to_pylist()))
        parts = (a.data, a.offsets, a.edge_of[1:], a.fail, a.first_out, a.name_of)
        return pa.table([pa.array([shard], pa.int32()), *[pa.array([p.tobytes()], pa.binary()) for p in parts]],
                        [f.split()[0] for f in _STORED.split(", ")])

    sharded = distinct.withColumn("shard", F.pmod(F.xxhash64("name"), F.lit(shards)).cast("int"))
    return Dictionary(shared_table(sharded.groupBy("shard").applyInArrow(one, _STORED), "automata", where), int(shards))


def open_dictionary(spark, where: str) -> Dictionary:
    """A dictionary that :func:`build` stored."""
    automata = spark.read.parquet(f"{where}/automata")
    return Dictionary(automata, (automata.agg(F.max("shard")).first()[0] or 0) + 1)


_loaded: dict[str, list[Automaton]] = {}  # a worker keeps the automata of one pass


def _load(token: str, stored: list[dict]) -> list[Automaton]:
    if token not in _loaded:
        _loaded.clear()
        done = []
        for row in stored:
            a = Automaton(np.frombuffer(row["data"], np.uint8), np.frombuffer(row["offsets"], np.int64), np.frombuffer(row["edges"], np.int64))
            a.fail, a.first_out, a.name_of = (np.frombuffer(row[k], np.int32) for k in ("fail", "first_out", "name_of"))
            if len(a.edge_of) <= DENSE_NODES:
                a.densify()
            done.append(a)
        _loaded[token] = done
    return _loaded[token]


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about SLICE_BYTES of text; a longer text stands alone."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    low = 0
    while low < batch.num_rows:
        base = upto[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(upto, base + SLICE_BYTES, side="right")))
        yield batch.slice(low, high - low)
        low = high


def _run(texts: DataFrame, text_col: str, keys: list[str], dictionary: Dictionary, every: bool,
         fields: str, report: Callable) -> DataFrame:
    """``report(automaton, text, start, end, name)`` for each slice and shard; one pass for some shards, no shuffle."""
    spark = texts.sparkSession
    packed = texts.select(F.struct(*keys).alias("row"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([packed.schema["row"], *T.StructType.fromDDL(fields).fields])
    parts = []
    for low in range(0, dictionary.shards, SHARDS_PER_PASS):
        rows = dictionary.automata.filter(F.col("shard").between(low, low + SHARDS_PER_PASS - 1)).orderBy("shard").collect()
        if not rows:
            continue
        shared = spark.sparkContext.broadcast([{k: bytes(v) if k != "shard" else v for k, v in r.asDict().items()} for r in rows])

        def run(batches: Iterator[pa.RecordBatch], shared=shared, token=uuid.uuid4().hex) -> Iterator[pa.RecordBatch]:
            automata = None
            for batch in batches:
                automata = automata or _load(token, shared.value)
                for part in _slices(batch):
                    text = [(x or "").encode() for x in part.column(1).to_pylist()]
                    data = np.frombuffer(b"".join(text), np.uint8)
                    offsets = np.concatenate([[0], np.cumsum([len(x) for x in text], dtype=np.int64)])
                    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # code points before a byte
                    for a in automata:
                        t, end, name = a.search(data, offsets, every)
                        begin, first = points[end + 1 - a.size[name]] - points[offsets[t]], points[end + 1] - points[offsets[t]]
                        t, columns = report(a, t, begin, first, name)
                        if len(t):
                            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(t)), *columns], schema.names)

        parts.append(packed.mapInArrow(run, schema))
    if not parts:
        return spark.createDataFrame([], schema).select("row.*", *schema.names[1:])
    done = parts[0]
    for p in parts[1:]:
        done = done.union(p)
    return done.select("row.*", *schema.names[1:])


def _names(a: Automaton, name: np.ndarray) -> pa.Array:
    known, place = np.unique(name, return_inverse=True)
    return pa.array([a.name(k) for k in known], pa.string()).take(pa.array(place))


def occurrences(texts: DataFrame, text_col: str, keys: list[str], dictionary: Dictionary) -> DataFrame:
    """Every occurrence, overlapping ones too: ``keys``, ``name``, ``begin``, ``end``."""
    def report(a, t, begin, end, name):
        return t, [_names(a, name), pa.array(begin, pa.int64()), pa.array(end, pa.int64())]

    return _run(texts, text_col, keys, dictionary, True, "name string, begin bigint, end bigint", report)


def name_counts(texts: DataFrame, text_col: str, keys: list[str], dictionary: Dictionary) -> DataFrame:
    """``keys``, ``name`` and ``n``, its occurrences: a row per text and name, counted where the text lies."""
    def report(a, t, begin, end, name):
        pairs, n = np.unique(t * len(a.size) + name, return_counts=True)
        return pairs // len(a.size), [_names(a, pairs % len(a.size)), pa.array(n, pa.int64())]

    return _run(texts, text_col, keys, dictionary, True, "name string, n bigint", report)


def longest_names(texts: DataFrame, text_col: str, keys: list[str], dictionary: Dictionary) -> DataFrame:
    """``keys``, ``name``, ``begin`` of the longest name in the texts with these keys; texts without a name have no row.

    Length counts code points; of equally long names the smallest counts, and of its places the first.
    """
    def report(a, t, begin, end, name):
        # names of a shard are sorted, so their number orders them
        order = np.lexsort((begin, name, begin - end, t))
        t, begin, name = t[order], begin[order], name[order]
        first = np.flatnonzero(np.diff(t, prepend=-1))
        return t[first], [_names(a, name[first]), pa.array(begin[first], pa.int64())]

    found = _run(texts, text_col, keys, dictionary, True, "name string, begin bigint", report)
    best = F.min(F.struct((-F.length("name")).alias("s"), "name", "begin"))
    return found.groupBy(*keys).agg(best.alias("b")).select(*keys, "b.name", "b.begin")
