"""Skip-gram word vectors without the vocabulary on the driver.

The method is that of Spark ML's Word2Vec with one iteration: hierarchical softmax over a Huffman tree of the counts; tasks
train on their own sentences, and the vectors of a word are averaged over the tasks that changed it.  There tasks share vectors only
inside an executor; here one task's share of the text is trained first, and all others start from its model.
The tree depends on the counts alone, so the driver builds it from their histogram, as runs of equal nodes, and
sends those; a task looks up the paths of its own words only.  Words are counted, numbered and averaged in shuffles.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.operators.ordering import dense_index
from weftline.session import shared_table

SENTENCE_WORDS = 1_000  # longer sentences are cut, as the library does
LANES = 32  # places of a task's text that are read in step
MOST_STEPS = 32  # gradients of one step that a vector takes in whole; more are scaled down to as many
RATE = 0.025


class HuffmanRuns:
    """Huffman tree over ``words`` with given counts; ``histogram`` has (count, number of words), counts rising.

    Words are numbered by rising count, inner nodes follow.  Nodes of equal weight are paired in runs, so the tree is a few
    intervals of nodes: node ``i`` of one that starts at ``low`` has the parent ``first + (i - low + shift) // 2``.
    """

    def __init__(self, histogram: list[tuple[int, int]]):
        self.words = sum(n for _, n in histogram)
        leaves, inner, at = deque(), deque(), 0
        for weight, n in histogram:
            leaves.append((weight, at, n))
            at += n
        pieces: list[tuple[int, int, int]] = []  # low, shift, first

        def smallest() -> tuple[int, deque]:
            """All nodes of the smallest weight: intervals (low, n)."""
            weight = min(q[0][0] for q in (leaves, inner) if q)
            return weight, deque((low, n) for q in (leaves, inner) for _, low, n in iter(lambda q=q: q.popleft() if q and q[0][0] == weight else None, None))

        left = None  # a lone node of smaller weight, with its weight
        while leaves or inner:
            weight, runs = smallest()
            if left:
                low, n = runs.popleft()
                pieces += [(left[0], 0, at), (low, 1, at)]
                self._put(inner, left[1] + weight, at, 1)
                at, left = at + 1, None
                if n > 1:
                    runs.appendleft((low + 1, n - 1))
            total = sum(n for _, n in runs)
            shift, even = 0, total - total % 2
            for low, n in runs:
                if min(n, even - shift) > 0:
                    pieces.append((low, shift, at))
                if shift + n > even:
                    left = (low + n - 1, weight)
                shift += n
            if even:
                self._put(inner, 2 * weight, at, even // 2)
                at += even // 2
        self.root = at - 1
        pieces.sort()
        self.low, self.shift, self.first = (np.array(x, dtype=np.int64) for x in zip(*pieces)) if pieces else (np.zeros(0, np.int64),) * 3

    @staticmethod
    def _put(inner: deque, weight: int, low: int, n: int) -> None:
        """Queue new nodes behind those of the same or smaller weight; only a lone node may be lighter than what waits."""
        behind = []
        while inner and inner[-1][0] > weight:
            behind.append(inner.pop())
        inner.append((weight, low, n))
        inner.extend(reversed(behind))

    def paths(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Inner nodes from the word up to the root, -1 beyond it, and on which side (0 or 1) of each the way goes down."""
        nodes, sides, now = [], [], np.asarray(words, dtype=np.int64)
        while (inside := now != self.root).any():
            inside &= now >= 0
            piece = np.searchsorted(self.low, now, side="right") - 1
            place = now - self.low[piece] + self.shift[piece]
            now = np.where(inside, self.first[piece] + place // 2, -1)
            nodes.append(now)
            sides.append(np.where(inside, place % 2, 0).astype(np.int8))
            now = np.where(now == self.root, -1, now)
            if (now < 0).all():
                break
        if not nodes:
            return np.zeros((len(words), 0), np.int64), np.zeros((len(words), 0), np.int8)
        return np.stack(nodes, axis=1), np.stack(sides, axis=1)


def start_vectors(words: np.ndarray, size: int, seed: int) -> np.ndarray:
    """Uniform in [-0.5, 0.5) / size, the same for a word in every task."""
    with np.errstate(over="ignore"):
        x = (words.astype(np.uint64)[:, None] * np.uint64(size) + np.arange(size, dtype=np.uint64)) + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15)
        for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(by)
        x ^= x >> np.uint64(31)
    return (((x >> np.uint64(40)).astype(np.float32) / np.float32(1 << 24)) - np.float32(0.5)) / np.float32(size)


def _add(to: np.ndarray, at: np.ndarray, what: np.ndarray, steps: np.ndarray) -> None:
    """Add rows that may share their place; a place that more than MOST_STEPS steps meet takes as many on average."""
    order = np.argsort(at, kind="stable")
    at = at[order]
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    sums, n = np.add.reduceat(what[order], first, axis=0), np.add.reduceat(steps[order], first)
    to[at[first]] += sums * np.minimum(1, MOST_STEPS / np.maximum(n, 1)).astype(np.float32)[:, None]


def train(words: np.ndarray, starts: np.ndarray, vectors: np.ndarray, path: np.ndarray, sides: np.ndarray, weights: np.ndarray,
          window: int, rng: np.random.Generator, falling: bool = True) -> np.ndarray:
    """Train ``vectors`` and the ``weights`` of inner nodes in place; returns which vectors changed.

    ``words`` are numbers of vectors, cut into sentences at ``starts`` (the first is 0); ``path`` has the nodes of each, the last
    node standing for none.  :data:`LANES` stretches of the text are read in step, and each step is a word of every lane with all
    its neighbours.  The rate falls to nothing along the text, or stays.
    """
    n, size, none = len(words), vectors.shape[1], len(weights) - 1
    changed = np.zeros(len(vectors), dtype=bool)
    if not n:
        return changed
    depth = (path < none).sum(axis=1)
    wanted = (1 - sides).astype(np.float32)
    sentence = np.searchsorted(starts, np.arange(n), side="right") - 1
    begin, end = starts[sentence], np.append(starts[1:], n)[sentence]
    offsets = np.r_[-window:0, 1:window + 1]
    lanes = min(LANES, n)
    stretch = -(-n // lanes)
    lane_starts = np.arange(lanes) * stretch
    for step in range(stretch):
        at = lane_starts + step
        at = at[at < n]
        alpha = np.float32(RATE * max(1 - step / stretch, 1e-4) if falling else RATE)
        reach = window - rng.integers(0, window, len(at))
        near = at[:, None] + offsets
        ok = (np.abs(offsets) <= reach[:, None]) & (near >= begin[at][:, None]) & (near < end[at][:, None])
        near_words, middle = words[np.where(ok, near, 0)], words[at]
        met = near_words[ok]
        if not len(met):
            continue
        changed[met] = True
        deep = depth[middle].max()
        if not deep:  # a vocabulary of one word has no tree
            continue
        nodes = path[middle, :deep]
        x, w = vectors[near_words], weights[nodes]
        f = x @ w.transpose(0, 2, 1)
        used = ok[:, :, None] & (nodes < none)[:, None, :] & (np.abs(f) < 6)
        g = np.where(used, (wanted[middle, :deep][:, None, :] - 1 / (1 + np.exp(-np.clip(f, -6, 6)))) * alpha, np.float32(0))
        _add(weights, nodes.ravel(), (g.transpose(0, 2, 1) @ x).reshape(-1, size), used.sum(axis=1).ravel())
        _add(vectors, met, (g @ w)[ok], np.ones(len(met), dtype=np.int64))
    return changed


@dataclass(frozen=True)
class Model:
    """Vectors of some words and weights of some inner nodes, by rising number."""

    words: np.ndarray
    vectors: np.ndarray
    nodes: np.ndarray
    weights: np.ndarray


def _known(numbers: np.ndarray, values: np.ndarray, asked: np.ndarray, into: np.ndarray) -> None:
    """Put values of known numbers where they are asked for."""
    if len(numbers):
        at = np.searchsorted(numbers, asked).clip(max=len(numbers) - 1)
        met = numbers[at] == asked
        into[met] = values[at[met]]


_OWN = "word string, number bigint, is_node boolean, changed boolean, vector array<float>"


def _trained(tree: HuffmanRuns, size: int, window: int, seed: int, first: Model | None, falling: bool):
    """Rows of tasks, each its words (``sentence`` -1) and then its sentences, to vectors of the words; with no ``first`` also weights."""
    def rows(names: list, numbers: np.ndarray, is_node: bool, changed: np.ndarray, vectors: np.ndarray) -> pa.RecordBatch:
        n = len(numbers)
        return pa.RecordBatch.from_arrays([
            pa.array(names, pa.string()), pa.array(numbers, pa.int64()), pa.array(np.full(n, is_node)), pa.array(changed),
            pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * size, pa.int32()), pa.array(vectors.ravel(), pa.float32()))],
            ["word", "number", "is_node", "changed", "vector"])

    def one(task: int, names: list, numbers: list[int], sentences: list[list[str]]) -> Iterator[pa.RecordBatch]:
        numbers, local = np.array(numbers, dtype=np.int64), {w: i for i, w in enumerate(names)}
        sentences = [p for p in ([local[w] for w in s if w in local] for s in sentences) if p]  # rare words are left out
        text = np.fromiter((w for p in sentences for w in p), dtype=np.int64, count=sum(map(len, sentences)))
        vectors = start_vectors(numbers, size, seed)
        path, sides = tree.paths(numbers)
        nodes = np.unique(path)
        nodes = nodes[nodes >= 0]
        path = np.where(path >= 0, np.searchsorted(nodes, path), len(nodes)).astype(np.int32)
        weights = np.zeros((len(nodes) + 1, size), dtype=np.float32)
        if first:
            _known(first.words, first.vectors, numbers, vectors)
            _known(first.nodes, first.weights, nodes, weights[:-1])
        changed = train(text, np.cumsum([0, *map(len, sentences)])[:-1], vectors, path, sides, weights, window,
                        np.random.default_rng([seed, task]), falling=falling)
        yield rows(names, numbers, False, changed, vectors)
        if not first:
            yield rows([None] * len(nodes), nodes, True, np.ones(len(nodes), dtype=bool), weights[:-1])

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, names, numbers, sentences = None, [], [], []
        for batch in batches:
            for task, sentence, word, number, words in zip(*(batch.column(c).to_pylist() for c in ("task", "sentence", "word", "number", "words"))):
                if task != now:
                    if names:
                        yield from one(now, names, numbers, sentences)
                    now, names, numbers, sentences = task, [], [], []
                if sentence < 0:
                    names.append(word)
                    numbers.append(number)
                else:
                    sentences.append(words)
        if names:
            yield from one(now, names, numbers, sentences)

    return tasks


def _pieces(words: Column) -> Column:
    """A sentence in stretches of at most SENTENCE_WORDS words."""
    return F.when(F.size(words) <= SENTENCE_WORDS, F.array(words)).otherwise(F.transform(
        F.sequence(F.lit(0), F.floor((F.size(words) - 1) / SENTENCE_WORDS).cast("int")),
        lambda i: F.slice(words, i * SENTENCE_WORDS + 1, F.lit(SENTENCE_WORDS))))


def skip_gram_vectors(sentences: DataFrame, words_col: str, size: int, window: int, seed: int, min_count: int,
                      n_tasks: int) -> DataFrame:
    """``(word, embedding)`` of every word that occurs ``min_count`` times, trained on all sentences in ``n_tasks`` tasks."""
    text = sentences.filter(F.size(words_col) > 0).select(F.explode(_pieces(F.col(words_col))).alias("words"))
    text = text.withColumn("sentence", F.monotonically_increasing_id())
    dealt = text.withColumn("task", F.pmod(F.xxhash64("sentence"), F.lit(n_tasks)).cast("int"))
    # stored by task, so that the words of a task are found where it lies
    stored = shared_table(dealt.repartitionById(n_tasks, F.col("task")), "sentences")
    met = shared_table(stored.select("task", F.explode("words").alias("word")).groupBy("task", "word").agg(F.count(F.lit(1)).alias("n")), "met")
    counts = met.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)
    numbered = shared_table(dense_index(counts, ["n", "word"], "number"), "vocabulary")
    # different counts are at most as many as the square root of twice the number of words
    tree = HuffmanRuns([(r["n"], r["words"]) for r in numbered.groupBy("n").agg(F.count(F.lit(1)).alias("words")).orderBy("n").collect()])
    if not tree.words:
        raise ValueError(f"no word occurs {min_count} times")
    known = met.select("task", "word").join(numbered, met["word"].eqNullSafe(numbered["word"])).select(
        "task", F.lit(-1).cast("bigint").alias("sentence"), met["word"], "number", F.lit(None).cast("array<string>").alias("words"))
    rows = known.unionByName(stored.withColumns({"word": F.lit(None).cast("string"), "number": F.lit(None).cast("bigint")}))

    def own(some: DataFrame, tasks: int, first: Model | None) -> DataFrame:
        laid = some.repartitionById(tasks, F.col("task")).sortWithinPartitions("task", "sentence", "number")
        return laid.mapInArrow(_trained(tree, size, window, seed, first, tasks == n_tasks), _OWN)

    # the first task's share, drawn from all over the text, is trained alone: from its model the others start in one direction
    begun = shared_table(own(rows.filter("task = 0"), 1, None), "first")
    trained = begun.filter("not is_node").withColumn("changed", F.lit(False))
    if n_tasks > 1:
        def part(condition: str) -> list[np.ndarray]:
            found = begun.filter(condition).select("number", "vector").toArrow()
            number, vector = (c.combine_chunks() for c in found.columns)
            order = np.argsort(number)
            return [number.to_numpy()[order], vector.flatten().to_numpy().reshape(-1, size)[order]]

        others = own(rows.filter("task > 0"), n_tasks, Model(*part("not is_node"), *part("is_node")))
        trained = trained.unionByName(others)
    # whole rows are shuffled, because their sums and counts would be larger; a word no other task changed has the same vector in all rows
    mean = [F.coalesce(F.avg(F.when(F.col("changed"), F.col("vector")[i])), F.max(F.col("vector")[i]).cast("double")).cast("float").alias(f"v{i}")
            for i in range(size)]
    one = trained.select("word", "changed", "vector").repartition("word").groupBy("word").agg(*mean)
    found = shared_table(one.select("word", F.array(*[f"v{i}" for i in range(size)]).alias("vector")), "vectors")
    return found.select("word", F.col("vector").cast("array<double>").alias("embedding"))
