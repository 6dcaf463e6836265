"""Calls, rows, columns and files that a job must not lose, and damaged input that it must not hide."""

from __future__ import annotations

import json
import shutil

import pytest
from pyspark.sql import functions as F

from weftline.functions import plugs
from weftline.operators import answers, brands, chunking, corpus_search, lookup, model_outputs, neighbours, requests, summaries
from weftline.sources import readers, upsert, writers


def test_every_call_is_answered(spark):
    corpus = spark.createDataFrame([("a.txt", "one\ntwo"), ("b.txt", "two"), (None, "two"), ("c.txt", None)], "path string, text string")
    same = [(7, "grep", '{"pat": "two"}')] * 600
    nulls = [(None, "glob", '{"pat": "*.txt"}')] * 500 + [(1, "glob", '{"pat": "a*"}')]
    odd = [(2, None, "{}"), (3, "grep", "{}"), (4, "grep", '{"pat": "("}'), (5, "read", "{}"), (6, "glob", None)]
    calls = spark.createDataFrame(same + nulls + odd, "call_id int, name string, args string")
    got = [tuple(r) for r in corpus_search.run_calls(calls, corpus, pattern_block=2).select("call_id", "name", "output").collect()]
    assert sum(g[0] == 7 for g in got) == 600 * 3
    assert sum(g[0] is None and g[1] == "glob" for g in got) == 500 * 3
    assert (1, "glob", "a.txt") in got and (2, None, "error: unknown tool 'null'") in got
    assert [g for g in got if g[0] in (3, 6)] and all(g[2] == "error: 'pat'" for g in got if g[0] in (3, 6))
    assert [g[2] for g in got if g[0] == 4] == ["error: missing ), unterminated subpattern at position 0"]
    assert [g[2] for g in got if g[0] == 5] == ["error: 'path'"]


def test_upsert_keeps_columns_and_tenants(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "user_id string, k int, v int, extra string"
    upsert.upsert(spark, path, spark.createDataFrame([("a", 1, 1, "x"), ("a", 2, 1, "y"), ("b", 1, 1, "z")], schema), ["user_id", "k"], "v")
    upsert.upsert(spark, path, spark.createDataFrame([("a", 1, 2)], "user_id string, k int, v int"), ["user_id", "k"], "v")
    got = {(r["user_id"], r["k"]): (r["v"], r["extra"]) for r in spark.read.parquet(path).collect()}
    assert got == {("a", 1): (2, None), ("a", 2): (1, "y"), ("b", 1): (1, "z")}


def test_failed_swap_loses_nothing(spark, tmp_path, monkeypatch):
    """The swap fails after it has dropped a stored tenant: the merged rows stay, and the swap can be finished."""
    path = str(tmp_path / "t")
    schema = "user_id string, k int, v int"
    upsert.upsert(spark, path, spark.createDataFrame([("a", 1, 1), ("a", 2, 1), ("b", 1, 1)], schema), ["user_id", "k"], "v")

    def half_way(staged, where, partition):
        shutil.rmtree(f"{where}/user_id=a")
        raise OSError("no space left")

    with monkeypatch.context() as broken:
        broken.setattr(upsert, "_replace", half_way)
        with pytest.raises(upsert.SwapFailed) as failed:
            upsert.upsert(spark, path, spark.createDataFrame([("a", 1, 2)], schema), ["user_id", "k"], "v")
    assert failed.value.staged_at in str(failed.value) and "no space left" in str(failed.value.__cause__)
    upsert.finish_swap(spark, failed.value.staged_at, path)
    got = {(r["user_id"], r["k"]): r["v"] for r in spark.read.parquet(path).collect()}
    assert got == {("a", 1): 2, ("a", 2): 1, ("b", 1): 1}
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(failed.value.staged_at)


def test_all_jobs_are_written(spark, tmp_path):
    rows = spark.range(950).select(F.format_string("%05d", "id").alias("id"), F.lit("some text").alias("text"))
    plan = writers.write_request_shards(rows, "Task", ["id"], str(tmp_path / "out"), "base", stamp=1, job_bytes=80_000)
    assert plan.jobs > 2
    written = [json.loads(line)["recordId"] for f in sorted((tmp_path / "out").glob("*.jsonl")) for line in f.read_text().splitlines()]
    assert written == [f"{i:05d}" for i in range(950)]
    table = requests.request_table(rows, "Task", ["id"])
    assert requests.assign_shards(table, plan, first_job_only=True).count() == plan.max_rows


def test_damaged_input_is_an_error(spark, tmp_path):
    (tmp_path / "export.json").write_text('[{"title": "a", "mapping": {}}, {"ti')
    with pytest.raises(Exception, match="damaged export"):
        readers.exports(spark, str(tmp_path / "export.json")).collect()
    folder = tmp_path / "train"
    folder.mkdir()
    (folder / "a.jsonl").write_text('{"text": "x"}\nnot json\n')
    with pytest.raises(Exception, match="damaged training line"):
        readers.training_rows(spark, str(folder)).collect()
    out = tmp_path / "batch"
    out.mkdir()
    (out / "a.jsonl.out").write_text('{"recordId": "1"}\n\n{"recordId": \n')
    with pytest.raises(Exception, match="damaged batch output"):
        readers.batch_outputs(spark, str(out)).collect()


def test_lookup_join_is_repeatable_over_shuffled_input(spark):
    big = spark.range(3000).repartition(7, "id").select(F.when(F.col("id") % 3 > 0, F.lit(1)).when(F.col("id") % 6 == 0, F.col("id")).alias("k"), "id")
    small = spark.range(0, 3000, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v")).unionByName(
        spark.createDataFrame([(1, 5)], "k bigint, v bigint"))
    runs = [sorted(map(str, lookup.lookup_join(big, small, ["k"], "left", max_rows=0, hot_rows=100).collect())) for _ in range(3)]
    assert runs[0] == runs[1] == runs[2] and len(runs[0]) == 3000


@pytest.mark.parametrize("scope", [None, "g"])
def test_knn_in_blocks_moves_no_corpus(spark, scope):
    corpus = spark.range(200).select(F.col("id").alias("key"), F.expr("cast(id % 3 as int) as g"),
                                     F.expr("array(cast(id % 17 as double), cast(id % 7 as double), 1d)").alias("embedding"))
    asks = corpus.filter("key % 5 = 0").withColumnRenamed("key", "question")
    whole = neighbours.knn_join(corpus, asks, 3, scope=scope)
    blocks = neighbours.knn_join(corpus, asks, 3, scope=scope, block_bytes=1000)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, blocks.collect()))
    assert "CoGroup" not in blocks._jdf.queryExecution().toString()


def test_separators_are_literal_and_packing_is_linear(spark):
    df = spark.createDataFrame([("ab|cd||ef",), ("",), (None,), ("x." * 20000,)], "t string")
    rows = df.select(chunking.separator_chunks("t", "|", 3).alias("c")).collect()
    assert [r["c"] for r in rows[:3]] == [["ab", "cd", "ef"], [], None]
    packed = df.select(chunking.separator_chunks("t", ".", 5).alias("c")).collect()[3]["c"]
    assert packed[:2] == ["x.x.x", "x.x.x"] and len(packed) == 6667


def test_reports_with_dotted_names_and_latencies(spark):
    log = spark.createDataFrame([("Qwen2.5-3B", "p", 1, "a", 0.5, "t" * 900)], "model string, prompt string, step int, answer string, latency double, tool_result string")
    results = model_outputs.evaluation_results(log, None)
    assert len(results.first()["tool_result"]) == 900
    wide = model_outputs.pivot_results(results, ["Qwen2.5-3B", "other"])
    lines = [r["line"] for r in model_outputs.report_lines(wide, ["Qwen2.5-3B", "other"]).orderBy("line_no").collect()]
    assert "| **Answer** | a | *(no result)* |" in lines
    prompts = spark.createDataFrame([("q", "p", "c", 1, "best", 12.5)], "question string, prompt string, context string, chunks_used int, top_text string, retrieval_ms double")
    r = answers.answer_records(prompts, lambda: lambda ps: [p + "!" for p in ps]).first()
    assert r["answer"] == "p!" and r["generation_ms"] >= 0 and r["total_ms"] == pytest.approx(r["retrieval_ms"] + r["generation_ms"])
    hits = spark.createDataFrame([("q", "k", 0.5)], "question string, key string, score double")
    assert neighbours.comparison_report(hits, hits, 3.0, 2.0).first()["winner"] == "approximate"
    m = spark.createDataFrame([("c", "q")], "c string, q string").select(answers.chat_messages(F.col("c"), F.col("q"), answers.STRICT_SYSTEM).alias("m")).first()["m"]
    assert [x["role"] for x in m] == ["system", "user"] and m[1]["content"].startswith("Context:\nc\n\nQuestion: q")


def test_large_dictionaries_and_annotators(spark):
    words = {f"w{i}": float(i) for i in range(100_000)}
    df = spark.createDataFrame([("w5 w7 none",), ("none",), (None,)], "t string")
    assert [r["s"] for r in df.select(plugs.lexicon_score("t", words).alias("s")).collect()] == [6.0, 0.0, None]
    names = [f"name{i}" for i in range(5000)] + ["acme", "acme tools"]
    got = spark.createDataFrame([("The ACME Tools kit",), ("nothing",)], "t string").select(brands.known_brand(F.col("t"), names).alias("b"))
    assert [r["b"] for r in got.collect()] == ["Acme Tools", None]

    def annotator():
        return lambda texts: [[(s, [(w, "NOUN" if w.isalpha() else "X") for w in s.split()]) for s in t.split(";") if s] for t in texts]

    docs = spark.createDataFrame([(1, "a b;b b 1;c"), (2, "")], "k int, text string")
    r = {x["k"]: x for x in summaries.summarize(docs, "k", n_sentences=1, stop_words=(), annotator=annotator).collect()}
    assert r[1]["summary"] == "b b 1" and r[1]["num_sentences"] == 3 and r[1]["top_keywords"][0]["word"] == "b"
    assert r[2]["error"] == summaries.EMPTY_TEXT
