"""Boosted trees on groups of equal bins learn what they learn on the rows."""

from __future__ import annotations

import numpy as np
import pytest

from weftline.operators import learning


def rows(spark, n, distinct):
    rng = np.random.default_rng(12)
    price, debt, kind = rng.integers(0, distinct, n) / 7.0, rng.integers(0, 9, n), rng.integers(0, 4, n)
    label = ((price > distinct / 14) ^ (kind == 2) ^ (rng.random(n) < 0.1)).astype(float)
    data = [(i, float(p), int(d), None if i % 83 == 0 else f"k{k}", float(y))
            for i, (p, d, k, y) in enumerate(zip(price, debt, kind, label))]
    return spark.createDataFrame(data, "id int, price double, debt int, kind string, label double").repartition(3)


def by_id(scored):
    return {r["id"]: r["approval"] for r in scored.collect()}


def test_groups_give_the_probabilities_of_rows(spark):
    df = rows(spark, 3000, 25)
    train = df.filter("id % 3 > 0")
    test = df.filter("id % 3 = 0").selectExpr("id", "if(id % 97 = 0, null, price) as price", "if(id % 89 = 0, double('nan'), debt) as debt", "kind", "label")
    plain, grouped = (by_id(learning.boosted_scores(train, test, ["price", "kind", "debt"], "label", trees=8, group_beyond=most))
                      for most in (10_000, 100))
    assert plain.keys() == grouped.keys() and len(plain) == 1000
    assert max(abs(plain[i] - grouped[i]) for i in plain) < 1e-9


def test_missing_numbers_are_refused_either_way(spark):
    df = rows(spark, 300, 25).selectExpr("if(id = 7, null, price) as price", "kind", "label")
    for most in (10_000, 100):
        with pytest.raises(Exception, match="NaN"):
            learning.boosted_scores(df, df, ["price", "kind"], "label", trees=2, group_beyond=most)


def test_trees_read_groups(spark, monkeypatch):
    """each of the hundred trees read every training row."""
    seen = []

    class Noted(learning.GBTClassifier):
        def _fit(self, dataset):
            seen.append((dataset.count(), dataset.agg({"_weight": "sum"}).first()[0] if "_weight" in dataset.columns else None))
            return super()._fit(dataset)

    monkeypatch.setattr(learning, "GBTClassifier", Noted)
    df = rows(spark, 120_000, 5000)
    scored = learning.boosted_scores(df, df.filter("id % 10 = 0"), ["price", "kind"], "label", trees=3)
    assert scored.columns == ["id", "price", "debt", "kind", "label", "approval", "credit_score"]
    error = scored.selectExpr("avg(pow(label - approval, 2)) as e", "var_pop(label) as v", "count(1) as n").first()
    assert error["n"] == 12_000 and error["e"] < error["v"]
    (groups, weight), = seen
    assert groups <= 33 * 5 * 2 and weight == 120_000
