"""Batch search against brute force, in both forms of the join."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline.operators import neighbours as N
from weftline.sources import readers, writers


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(300, 8))
    v[7] = 0.0
    v[11] = v[10]  # a tie
    corpus = spark.createDataFrame([(int(i), int(i % 4), [float(x) for x in v[i]]) for i in range(300)],
                                   "key bigint, user_id int, embedding array<double>").repartition(5)
    asks = corpus.filter("key < 40").select(F.col("key").alias("question"), "user_id", "embedding")
    return v, corpus, asks


def brute(v, metric, k, scoped):
    out = {}
    for q in range(40):
        rows = []
        for i in range(300):
            if scoped and i % 4 != q % 4:
                continue
            if metric == "cosine":
                n = np.linalg.norm(v[i]) * np.linalg.norm(v[q])
                rows.append((-(float(v[i] @ v[q]) / n if n else 0.0), i))
            else:
                rows.append((float(np.linalg.norm(v[i] - v[q])), i))
        rows.sort(key=lambda r: (round(r[0], 9), r[1]))
        out[q] = [i for _, i in rows[:k]]
    return out


@pytest.mark.parametrize("metric", ["cosine", "l2"])
@pytest.mark.parametrize("scope", [None, "user_id"])
@pytest.mark.parametrize("block_bytes", [N.QUESTION_BYTES, 2000])
def test_knn_join(spark, data, metric, scope, block_bytes):
    v, corpus, asks = data
    found = N.knn_join(corpus, asks, 6, metric=metric, scope=scope, round_first=9, block_bytes=block_bytes).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r["question"], r["rank"])):
        got.setdefault(r["question"], []).append(r["key"])
    assert got == brute(v, metric, 6, scope is not None)


def test_single_search_equals_batch(spark, data):
    v, corpus, asks = data
    one = N.search(corpus, [float(x) for x in v[5]], 4, tenant=1, key_col="key").collect()
    batch = N.knn_join(corpus, asks.filter("question = 5"), 4, scope="user_id").orderBy("rank").collect()
    assert [r["key"] for r in one] == [r["key"] for r in batch]


def test_probing_every_list_is_exact(spark, data):
    _, corpus, asks = data
    centroids = N.mean_vectors(corpus, "user_id").withColumnRenamed("user_id", "list_id")
    ivf = N.build_inverted_file(corpus, centroids)
    approx = N.ivf_search(ivf, centroids, asks, 5, nprobe=4)
    exact = N.knn_join(corpus, asks, 5)
    report = N.compare_results(exact, approx).agg(F.min("overlap"), F.max("max_diff")).first()
    assert report[0] == 5 and report[1] < 1e-12


def test_stored_lists_prune(spark, data, tmp_path):
    _, corpus, _ = data
    centroids = N.mean_vectors(corpus, "user_id").withColumnRenamed("user_id", "list_id")
    N.write_inverted_file(N.build_inverted_file(corpus, centroids), str(tmp_path / "ivf"))
    stored = readers.vector_table(spark, str(tmp_path / "ivf"), 2, "list_id")
    assert "PartitionFilters: [isnotnull(list_id" in stored._jdf.queryExecution().toString()
    assert stored.count() == N.build_inverted_file(corpus, centroids).filter("list_id = 2").count()


def test_tie_goes_to_exact():
    assert N.pick_winner(3.0, 3.0)["winner"] == "exact"
    assert N.pick_winner(3.5, 3.0) == {"exact_ms": 3.5, "approx_ms": 3.0, "abs_diff_ms": 0.5, "winner": "approximate"}


def test_unknown_metric(data):
    _, corpus, asks = data
    with pytest.raises(ValueError):
        N.knn_join(corpus, asks, 1, metric="dot")


def test_written_table_is_read_back(spark, data, tmp_path):
    _, corpus, _ = data
    writers.rebuild(corpus, str(tmp_path / "t"), "user_id")
    assert readers.vector_table(spark, str(tmp_path / "t"), 1).count() == 75


def test_questions_are_merged_together(monkeypatch):
    """The interpreter's work follows the slices, not questions times slices; equal vectors tie wherever they stand."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 64))
    x[300:] = x[:300][rng.permutation(300)]
    q, calls, offer = x[rng.permutation(600)].repeat(5, axis=0), [], N._Best.offer
    monkeypatch.setattr(N._Best, "offer", lambda self, *a: (calls.append(1), offer(self, *a))[1])
    best = N._Best(len(q), 4, True)
    for lo in range(0, 600, 200):
        N._offer_rows(best, np.arange(lo, lo + 200), None, x[lo:lo + 200], q, None, np.arange(len(q)), "cosine", None)
    assert len(calls) < 100
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    score = np.round((q / np.linalg.norm(q, axis=1)[:, None]) @ unit.T, 12)
    want = np.argsort(-score, axis=1, kind="stable")[:, :4]
    got = best.frame(np.arange(len(q)))
    assert got["question"].tolist() == np.repeat(np.arange(len(q)), 4).tolist()
    assert np.array_equal(got["key"].to_numpy().reshape(-1, 4), want)
