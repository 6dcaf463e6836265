"""Skipping lists loses no neighbour."""

from __future__ import annotations

import numpy as np
import pytest

from weftline.operators import neighbours as N
from weftline.operators import pruned_search as P

SCHEMA = "key bigint, embedding array<double>"


def frame(spark, v, schema=SCHEMA):
    return spark.createDataFrame([(i, None if x is None else [float(y) for y in x]) for i, x in enumerate(v)], schema).repartition(5)


def in_order(rows):
    got = {}
    for r in sorted(rows, key=lambda r: (r["question"], r["rank"])):
        got.setdefault(r["question"], []).append((r["key"], round(r["score"], 9)))
    return got


@pytest.fixture(scope="module")
def clustered():
    rng = np.random.default_rng(8)
    middle = rng.normal(size=(25, 16)) * 4
    v = middle[rng.integers(0, 25, 3000)] + rng.normal(size=(3000, 16)) * 0.15
    v[7] = 0.0
    v[11:15] = v[10]  # ties
    return v


@pytest.mark.parametrize("metric", N.METRICS)
def test_equals_the_whole_join(spark, clustered, metric):
    corpus = frame(spark, clustered)
    asks = corpus.filter("key % 13 = 0 or key between 5 and 14").withColumnRenamed("key", "question")
    answer = P.pruned_knn(P.store_lists(corpus, 32, metric=metric), asks, 6, round_first=8)
    assert in_order(answer.result.collect()) == in_order(N.knn_join(corpus, asks, 6, metric=metric, round_first=8).collect())
    assert answer.visits.groupBy("question", "list_id").count().filter("count > 1").count() == 0
    share = answer.scored_share().first()
    assert share["pairs"] == asks.count() * 3000 and share["share"] < 0.15


def test_vectors_without_structure_are_exact_too(spark):
    v = np.random.default_rng(9).normal(size=(400, 6))
    corpus = frame(spark, v)
    asks = frame(spark, np.random.default_rng(10).normal(size=(30, 6)), "question bigint, embedding array<double>")
    for k in (1, 5, 500):  # more than there are rows as well
        answer = P.pruned_knn(P.store_lists(corpus, 12, sample=50), asks, k, block_bytes=3000)
        assert in_order(answer.result.collect()) == in_order(N.knn_join(corpus, asks, k).collect())


def test_damaged_vectors_and_empty_tables(spark):
    v = [[1.0, 0.0], None, [float("nan"), 1.0], [0.0, 0.0], [0.0, 1.0], [float("inf"), 0.0], [0.6, 0.8]]
    corpus = frame(spark, v)
    asks = corpus.withColumnRenamed("key", "question")
    got = in_order(P.pruned_knn(P.store_lists(corpus, 4), asks, 9).result.collect())
    assert set(got) == {0, 3, 4, 6} and [k for k, _ in got[0]] == [0, 6, 3, 4] and [s for _, s in got[3]] == [0.0] * 4
    only_zero = P.pruned_knn(P.store_lists(corpus.filter("key = 3"), 4), asks, 2)
    assert {q: [k for k, _ in x] for q, x in in_order(only_zero.result.collect()).items()} == {q: [3] for q in (0, 3, 4, 6)}
    empty = P.pruned_knn(P.store_lists(corpus.limit(0)), asks, 2)
    assert empty.result.count() == 0 and empty.scored_share().first()["share"] is None
    assert P.pruned_knn(P.store_lists(corpus), asks.limit(0), 2).result.count() == 0


def test_second_pass_keeps_rows_within_the_bound(spark, monkeypatch):
    """every cell gave its k best rows of every question, so the rows to merge grew with the square of the table."""
    given, real = [], P._score_cells

    def noted(*args):
        given.append((args[1], real(*args)))
        return given[-1][1]

    monkeypatch.setattr(P, "_score_cells", noted)
    v = np.random.default_rng(3).normal(size=(3000, 12))
    corpus = frame(spark, v)
    asks = corpus.filter("key % 10 = 0").withColumnRenamed("key", "question")
    answer = P.pruned_knn(P.store_lists(corpus, 16, sample=500), asks, 4, block_bytes=40_000)
    assert in_order(answer.result.collect()) == in_order(N.knn_join(corpus, asks, 4).collect())
    probes, hits = given[1]
    seen = {q: sorted((r.score for r in given[0][1].collect() if r.question == q), reverse=True)[3] for q in (0, 500, 2990)}
    found = [r for r in hits.collect() if r.question in seen]
    assert found and all(r.score >= seen[r.question] for r in found)
    assert probes.count() == 300


def test_a_vector_moves_to_few_blocks():
    """blocks of 2 MiB had every vector of a larger table copied hundreds of times."""
    assert 615_000 / P._block_rows(615_000, 8 * 64 + 64, P.BLOCK_BYTES, 12) < 12
    assert P._block_rows(51_282, 8 * 64 + 64, P.BLOCK_BYTES, 12) * 7 >= 51_282 > P._block_rows(51_282, 8 * 64 + 64, P.BLOCK_BYTES, 12) * 6
    assert P._block_rows(10, 1 << 30, 3000, 8) == 1


@pytest.mark.parametrize("metric", N.METRICS)
def test_words_as_keys_and_single_precision(spark, metric):
    v = np.random.default_rng(4).normal(size=(200, 5)).astype(np.float32)
    v[20:30] = v[3]
    corpus = frame(spark, v, "key bigint, embedding array<float>").selectExpr("concat('é', key) as key", "embedding")
    asks = corpus.selectExpr("key as question", "embedding")
    answer = P.pruned_knn(P.store_lists(corpus, 8, metric=metric), asks, 5, round_first=6, block_bytes=2000)
    assert in_order(answer.result.collect()) == in_order(N.knn_join(corpus, asks, 5, metric=metric, round_first=6).collect())
    with pytest.raises(Exception):
        mixed = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0])], SCHEMA)
        P.pruned_knn(P.store_lists(mixed, 2), mixed.withColumnRenamed("key", "question"), 1).result.collect()
