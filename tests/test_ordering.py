"""Numbering, totals and splits do not depend on the number of partitions."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from weftline.operators import lookup, ordering


@pytest.fixture(params=[1, 3, 16])
def partitions(spark, request):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(request.param))
    yield request.param
    spark.conf.set("spark.sql.shuffle.partitions", old)


def test_dense_index_counts_from_zero_in_order(spark, partitions):
    df = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("k"))
    rows = ordering.dense_index(df, "k").collect()
    assert sorted((r["k"], r["idx"]) for r in rows) == [(i, i) for i in range(1000)]


def test_running_total(spark, partitions):
    df = spark.range(500).select("id", (F.col("id") % 5).alias("v"))
    rows = sorted(ordering.running_total(df, "id", "v").collect(), key=lambda r: r["id"])
    total = 0
    for r in rows:
        total += r["v"]
        assert r["running"] == total


@pytest.mark.parametrize("n", [0, 1, 37, 299, 300, 400])
def test_flag_first_by_hash_is_exact(spark, n):
    df = spark.range(300).withColumnRenamed("id", "k")
    got = {r["k"] for r in ordering.flag_first_by_hash(df, 7, ["k"], n).filter("taken").collect()}
    order = sorted(range(300), key=lambda k: (hashlib.md5(f"7:{k}".encode()).hexdigest(), k))
    assert got == set(order[:n])


def test_order_statistics_and_quantiles(spark):
    df = spark.createDataFrame([(float(x),) for x in [5, 1, 1, 9, 3, 3, 3]], "x double")
    assert ordering.order_statistics(df, "x", {"a": 0, "b": 3, "c": 6}) == {"a": 1.0, "b": 3.0, "c": 9.0}
    assert ordering.linear_quantiles(df, "x", {"q": 0.25})["q"] == 2.0


def test_first_and_last_per_key(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, "z")], "k string, o int, v string")
    assert {(r["k"], r["v"]) for r in ordering.first_per_key(df, "k", ["o"]).collect()} == {("a", "y"), ("b", "z")}
    assert {(r["k"], r["v"]) for r in ordering.last_per_key(df, "k", ["o"]).collect()} == {("a", "x"), ("b", "z")}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_lookup_join_is_the_same_shuffled_and_copied(spark, how):
    big = spark.range(4000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"), "id")
    small = spark.range(0, 60, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    copied = sorted(map(tuple, lookup.lookup_join(big, small, ["k"], how).collect()), key=str)
    shuffled = lookup.lookup_join(big, small, ["k"], how, max_rows=1, hot_rows=500)
    assert sorted(map(tuple, shuffled.select(*big.columns, *(["v"] if how in ("inner", "left") else [])).collect()), key=str) == copied


def test_positional_join_pads_the_shorter_side(spark):
    a = spark.createDataFrame([(3,), (1,), (2,)], "a int")
    b = spark.createDataFrame([("x",), ("y",)], "b string")
    rows = sorted(ordering.positional_join(a, "a", b, "b").collect(), key=lambda r: r["idx"])
    assert [(r["a"], r["b"]) for r in rows] == [(1, "x"), (2, "y"), (3, None)]


@pytest.mark.parametrize("n", [0, 1, 5, 25, 33, 99, 100, 120])
def test_repeated_and_null_keys_are_split_exactly(spark, n):
    rows = [(None if k % 10 == 9 else k % 10, "same" if k % 2 else f"row {k}") for k in range(100)]
    df = spark.createDataFrame(rows, "k int, v string").repartition(5)
    got = ordering.flag_first_by_hash(df, 7, ["k"], n).collect()
    assert sum(r["taken"] for r in got) == min(n, 100)
    assert sorted((str(r["k"]), r["v"]) for r in got) == sorted((str(k), v) for k, v in rows)
    assert len({r["k"] for r in got if r["taken"]} & {r["k"] for r in got if not r["taken"]}) <= 1  # only the key at the cut is divided


def test_steps_that_took_whole_values_or_one_task(spark):
    """No join by whole texts, patterns once per title, words of a text in many tasks."""
    from pyspark.sql import functions as F

    from weftline.functions.registry import register
    from weftline.operators import brands, summaries

    register(spark)
    spark.createDataFrame([(1, "x" * 300), (1, "x" * 300), (2, None)], "d int, text string").createOrReplaceTempView("weft_test_docs")
    chunks = spark.sql("SELECT d, c.chunk_index AS i, length(c.chunk_text) AS n FROM weft_test_docs, LATERAL weft_chunks(text) AS c")
    assert "Join" not in chunks._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, chunks.collect())) == [(1, 0, 256), (1, 0, 256), (1, 1, 76), (1, 1, 76)]
    rows = spark.createDataFrame([("b",), ("b",), ("",), ("",), ("",), (None,), (None,), (None,), ("a",)], "t string")
    top = brands.top_values(rows.select(F.regexp_replace("t", "z", "").alias("brand")), n=2)
    plan = top._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert not [line for line in plan if "Filter" in line and "regexp_replace" in line]
    assert [tuple(r) for r in top.collect()] == [("b", 2), ("a", 1)]
    long = spark.range(3_000).select("id", F.repeat(F.lit("word other "), 2_000).alias("text"))
    assert summaries.content_words(long, "id").rdd.getNumPartitions() >= 3_000 * 22_000 // summaries.TASK_BYTES
