"""Word vectors beyond the driver's vocabulary: the same method, every word, and neighbours that make sense."""

from __future__ import annotations

import heapq
import random
from collections import Counter

import numpy as np
import pytest

from weftline.operators import learning, skip_gram


def best_cost(counts):
    heap, total = list(counts), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        total += both
        heapq.heappush(heap, both)
    return total


def test_runs_make_a_huffman_tree():
    rng = random.Random(1)
    for _ in range(400):
        counts = sorted(rng.choice([1, 1, 2, 3, rng.randrange(1, 60)]) for _ in range(rng.randrange(1, 60)))
        nodes, sides = skip_gram.HuffmanRuns(sorted(Counter(counts).items())).paths(np.arange(len(counts)))
        assert ((nodes >= 0).sum(axis=1) * counts).sum() == best_cost(counts)
        codes = ["".join(str(s) for s, n in zip(side, node) if n >= 0)[::-1] for side, node in zip(sides, nodes)]
        assert len(set(codes)) == len(codes) and len(np.unique(nodes[nodes >= 0])) == len(counts) - 1
        above = {}  # a node has one place in the tree
        for code, node in zip(codes, nodes):
            path = [n for n in node if n >= 0]
            assert all(above.setdefault(n, code[:len(path) - 1 - d]) == code[:len(path) - 1 - d] for d, n in enumerate(path))


def sentences(n):
    """Sentences of one of eight topics, with common words between them."""
    rng = random.Random(3)
    found = []
    for k in range(n):
        topic = rng.randrange(8)
        length = 2500 if k % 500 == 7 else rng.randrange(1, 40)
        found.append([f"common{min(int(rng.paretovariate(1)), 20)}" if rng.random() < 0.3 else f"t{topic}w{int(15 * rng.random() ** 2)}"
                      for _ in range(length)])
    return [*found, [], ["t0w0", "once"], ["alone"]]


@pytest.fixture()
def no_library(monkeypatch):
    """the library collected the vocabulary on the driver."""
    def refuse(**_):
        raise AssertionError("the vocabulary goes to the driver")

    monkeypatch.setattr(learning, "Word2Vec", refuse)


@pytest.mark.parametrize("task_words", [500_000, 40_000])
def test_many_words_are_trained_without_the_driver(spark, no_library, monkeypatch, task_words):
    monkeypatch.setattr(learning, "TASK_WORDS", task_words)
    rows = sentences(5000)
    assert sum(map(len, rows)) > 100_000  # one task, or three
    df = spark.createDataFrame([(r,) for r in [*rows, None]], "words array<string>").repartition(3)
    found = learning.word_vectors(df, "words", driver_words=100)
    assert found.dtypes == [("word", "string"), ("embedding", "array<double>")]
    vectors = [(r["word"], r["embedding"]) for r in found.collect()]
    assert Counter(w for w, _ in vectors) == Counter({w for r in rows for w in r})
    assert all(len(v) == 16 and np.isfinite(v).all() and any(v) for _, v in vectors)
    known = {w: np.array(v) / np.linalg.norm(v) for w, v in vectors if w[0] == "t"}
    words = sorted(known)
    like = np.array([known[w] for w in words]) @ np.array([known[w] for w in words]).T
    same = np.array([[a.split("w")[0] == b.split("w")[0] for b in words] for a in words])
    assert like[same].mean() > 0.8 and like[~same].mean() < 0.3
    again = {r["word"]: r["embedding"] for r in found.collect()}
    assert all(again[w] == v for w, v in vectors)


def test_rare_words_have_no_vector(spark, no_library):
    rows = [["a", "b", "a"], ["a", "b", "c"], ["b", "d", "d"]] + [[f"x{i}"] for i in range(200)]
    df = spark.createDataFrame([(r,) for r in rows], "words array<string>")
    found = learning.word_vectors(df, "words", size=4, min_count=2, driver_words=100)
    assert sorted((r["word"], len(r["embedding"])) for r in found.collect()) == [("a", 4), ("b", 4), ("d", 4)]
    with pytest.raises(ValueError, match="no word"):
        learning.word_vectors(df, "words", min_count=50, driver_words=100)


def test_few_words_go_to_the_library(spark, monkeypatch):
    def refuse(*_):
        raise AssertionError("few words")

    monkeypatch.setattr(skip_gram, "skip_gram_vectors", refuse)
    df = spark.createDataFrame([(["a", "b", "a"],), (["b", "c"],), (None,)], "words array<string>")
    assert sorted(r["word"] for r in learning.word_vectors(df, "words").collect()) == ["a", "b", "c"]
