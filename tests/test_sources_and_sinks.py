"""Readers and writers on small hand-made files."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from weftline.operators import export, requests, training
from weftline.sources import readers, upsert, writers


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


@pytest.fixture()
def export_file(tmp_path):
    def message(role, parts, at=None, content=True):
        m = {"id": "m", "author": {"role": role}, "create_time": at}
        if content:
            m["content"] = {"content_type": "text", "parts": parts}
        return m

    data = [
        {"title": "Beta talk", "create_time": 1745331688.921647, "mapping": {
            "z": {"id": "z", "message": None, "parent": None, "children": ["a"]},
            "a": {"id": "a", "message": message("system", [""])},
            "c": {"id": "c", "message": message("assistant", ["later", "", {"kind": "image"}], 20.5)},
            "b": {"id": "b", "message": message("user", ["hello"], 10.25)},
            "d": {"id": "d", "message": message("user", [], content=False)},
            "n": None}},
        {"title": None, "id": "id-2", "mapping": None},
        {"title": "alpha: x/y", "id": "id-3", "mapping": {}},
        {"title": "Alpha: X/Y", "id": "id-4", "mapping": {}},
    ]
    return put(tmp_path / "export" / "conversations.json", json.dumps(data, indent=1))


def test_export_messages_and_markdown(spark, export_file):
    ex = readers.exports(spark, export_file)
    first = export.messages(ex, ["ord"]).filter("ord = 0").orderBy("seq").collect()
    assert [(r["role"], r["ts"]) for r in first] == [("system", 0.0), ("user", 10.25), ("assistant", 20.5)]
    text = export.render(ex, sanitize=False).filter("ord = 0").first()["content"]
    assert text == ("# Beta talk\n\n**Created:** 1745331688.921647\n\n## System\n\n## User\n\nhello\n\n"
                    "## Assistant\n\nlater\n\n{\"kind\":\"image\"}\n\n")
    listed = export.sorted_titles(ex).orderBy("idx").collect()
    assert [r["title"] for r in listed] == ["alpha: x/y", "Alpha: X/Y", "Beta talk", "Untitled Conversation 1"]
    assert export.by_position(ex, 2).first()["title"] == "Beta talk"
    with pytest.raises(IndexError):
        export.by_position(ex, 4)


def test_markdown_files_last_one_wins(spark, export_file, tmp_path):
    writers.write_markdown(readers.exports(spark, export_file), str(tmp_path / "md"))
    names = sorted(os.listdir(tmp_path / "md"))
    assert names == ["alpha__x_y.md", "beta_talk.md", "conversation_1.md"]
    assert "id-4" in (tmp_path / "md" / "alpha__x_y.md").read_text()


def test_title_lists(spark, export_file, tmp_path):
    writers.write_titles(readers.exports(spark, export_file), str(tmp_path / "t"), str(tmp_path / "j"))
    assert [r["value"] for r in spark.read.text(str(tmp_path / "t")).collect()][0] == "alpha: x/y"
    assert spark.read.json(str(tmp_path / "j")).filter("id = ''").count() == 1


def record(uid, parent, kind, content):
    return json.dumps({"uuid": uid, "parentUuid": parent, "type": kind, "message": {"content": content}})


def test_transcripts_drop_broken_files_whole(spark, tmp_path):
    good = [record("a", None, "user", "hi"), record("b", "a", "assistant", [{"type": "text", "text": "yo"}])]
    put(tmp_path / "r1" / "deep" / "ok.jsonl", "\n".join(good) + "\n")
    put(tmp_path / "r1" / "blank.jsonl", good[0] + "\n\n" + good[1] + "\n")
    put(tmp_path / "r2" / "bad.jsonl", good[0] + "\n{oops\n")
    put(tmp_path / "r2" / "other.txt", "x")
    rows = readers.transcripts(spark, [str(tmp_path / "r1"), str(tmp_path / "r2")]).orderBy("line_no").collect()
    assert [(r["uuid"], r["parent"], r["line_no"]) for r in rows] == [("a", None, 0), ("b", "a", 1)]
    assert rows[0]["content"] == '"hi"'


def test_line_numbers_over_many_blocks(spark, tmp_path):
    put(tmp_path / "big.txt", "".join(f"line {i}\n" for i in range(5000)))
    put(tmp_path / "small.txt", "line 0\nline 1")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = readers.numbered_lines(spark, str(tmp_path), "*.txt").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(rows) == 5002
    assert all(r["line"] == f"line {r['line_no']}" for r in rows)


def test_documents_seeds_and_lines(spark, tmp_path):
    put(tmp_path / "tree" / "a" / "x.md", "# x")
    put(tmp_path / "tree" / "y.py", "y = 1")
    put(tmp_path / "tree" / "z.bin", "no")
    assert readers.document_tree(spark, str(tmp_path / "tree")).count() == 2
    seed = put(tmp_path / "seeds" / "doc-b.txt", "b\ntext")
    put(tmp_path / "seeds" / "doc-a.txt", "a")
    assert sorted(r["document_id"] for r in readers.seed_documents(spark, str(tmp_path / "seeds")).collect()) == ["doc-a", "doc-b"]
    put(tmp_path / "none" / "x.md", "")
    with pytest.raises(FileNotFoundError):
        readers.seed_documents(spark, str(tmp_path / "none"))
    one = readers.text_document(spark, seed).first()
    assert one["text"] == "b\ntext" and one["metadata"] == {"source": seed}
    assert [r["line"] for r in readers.text_lines(spark, seed).orderBy("line_no").collect()] == ["b", "text"]


def test_csv(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "hi",\nyou', None), (2, "x", 2.5)], "id int, name string, price double")
    writers.write_csv(df.coalesce(1), str(tmp_path / "csv"))
    back = readers.csv_table(spark, str(tmp_path / "csv"), "id int, name string, price double", ["name"], multi_line=True)
    assert sorted(map(tuple, back.collect())) == [(1, 'say "hi",\nyou', None), (2, "x", 2.5)]
    with pytest.raises(ValueError, match="available"):
        readers.csv_table(spark, str(tmp_path / "csv"), "id int", ["brand"])


def test_parquet_json_and_literals(spark, tmp_path):
    df = readers.literal_rows(spark, [{"id": 1, "tip": 2.5}, {"id": 2}], "id int, tip double")
    writers.write_parquet(df, str(tmp_path / "p"))
    assert sorted(map(tuple, readers.parquet_table(spark, str(tmp_path / "p"), ["id"]).collect())) == [(1,), (2,)]
    writers.write_json_lines(df, str(tmp_path / "j"))
    assert sorted(r["value"] for r in spark.read.text(str(tmp_path / "j")).collect()) == ['{"id":1,"tip":2.5}', '{"id":2}']


def test_training_rows_route_by_shape(spark, tmp_path):
    rows = [{"text": "ready made"}, {"messages": [{"role": "user", "content": "Explain joins"},
                                                  {"role": "assistant", "content": "They combine."}]},
            {"messages": [{"role": "user", "content": "ok thanks"}, {"role": "assistant", "content": "x"}]},
            {"messages": [{"role": "assistant", "content": "no user"}]}]
    put(tmp_path / "b.jsonl", "\n".join(map(json.dumps, rows)) + "\n")
    got = training.prepare(readers.training_rows(spark, str(tmp_path)), ["file", "line_no"]).orderBy("line_no").collect()
    assert [r["reason"] for r in got] == [None, None, "follow-up", "follow-up"]
    assert got[1]["text"] == ("<|start|>user<|message|>Explain joins<|end|>"
                              "<|start|>assistant<|channel|>final<|message|>They combine.<|end|>")


def test_opening_is_used_up_by_a_dropped_row(spark):
    long_one = [{"role": r, "content": "Explain joins"} for r in ("user", "assistant") * 4]
    short = long_one[:2]
    rows = spark.createDataFrame([("f", 0, None, long_one), ("f", 1, None, short)],
                                 "file string, line_no int, text string, messages array<struct<role:string,content:string>>")
    got = training.prepare(rows, ["file", "line_no"]).orderBy("line_no").collect()
    assert [r["reason"] for r in got] == ["too many messages", "repeated opening"]


def test_batch_outputs(spark, tmp_path):
    def out(rid, parts, usage=True):
        m = {"content": [{"type": "text", "text": p} for p in parts]}
        if usage:
            m["usage"] = {"input_tokens": 3, "output_tokens": 4}
        return json.dumps({"recordId": rid, "modelOutput": m})

    put(tmp_path / "o" / "a.jsonl.out", "\n".join([out("1", ["ml"]), "", out("2", ['{"a":', " 1}"]), out("1", ["late"]),
                                                  json.dumps({"recordId": "3"})]) + "\n")
    put(tmp_path / "o" / "ignored.jsonl", out("9", ["x"]))
    parsed = requests.parse_responses(readers.batch_outputs(spark, str(tmp_path / "o")))
    rows = {r["record_id"]: r for r in requests.first_response(parsed, ["file", "line_no"]).withColumn(
        "parsed", F.to_json("parsed")).collect()}
    assert rows["1"]["raw"] == "ml" and rows["1"]["parsed"] == "{}" and rows["1"]["input_tokens"] == 3
    assert rows["2"]["parsed"] == '{"a":1}' and rows["3"]["raw"] == "" and rows["3"]["output_tokens"] == 0
    empty = readers.batch_outputs(spark, str(tmp_path / "missing"))
    assert empty.columns == ["file", "line_no", "recordId", "modelOutput"] and empty.isEmpty()


def test_request_shards(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(requests, "MIN_ROWS_PER_FILE", 10)
    rows = spark.range(95).select(F.col("id").cast("string").alias("id"), F.lit("x" * 40000).alias("text"), F.col("id").alias("o"))
    plan = writers.write_request_shards(rows, "Task", ["o"], str(tmp_path / "s"), "job", target_mb=1, stamp=7)
    names = sorted(os.listdir(tmp_path / "s"))
    assert names[0] == "job-7-part-00000.jsonl" and len(names) == -(-95 // plan.rows_per_file)
    ids = [json.loads(x)["recordId"] for n in names for x in (tmp_path / "s" / n).read_text().splitlines()]
    assert ids == [str(i) for i in range(95)]
    with pytest.raises(ValueError, match="no rows"):
        requests.shard_plan(requests.request_table(rows.limit(0), "T", ["o"]))
    with pytest.raises(ValueError, match="limit"):
        requests.check_shards(spark.createDataFrame([(0, 50)], "shard_id bigint, bytes bigint"), 50)


def test_upsert_is_idempotent_and_keeps_stale_chunks(spark, tmp_path):
    path = str(tmp_path / "store")
    schema = "user_id string, document_chunk string, chunk_text string, version bigint"
    first = spark.createDataFrame([("u", "d#0", "old", 1), ("u", "d#1", "tail", 1), ("w", "e#0", "keep", 1)], schema)
    second = spark.createDataFrame([("u", "d#0", "new", 2)], schema)
    for batch in (first, second, second):
        upsert.upsert(spark, path, batch, ["user_id", "document_chunk"], "version")
    rows = {(r["user_id"], r["document_chunk"]): r["chunk_text"] for r in spark.read.parquet(path).collect()}
    assert rows == {("u", "d#0"): "new", ("u", "d#1"): "tail", ("w", "e#0"): "keep"}


def test_append_rebuild_and_two_stores(spark, tmp_path):
    df = spark.createDataFrame([("u", "a"), ("u", "b")], "user_id string, chunk_text string")
    path = str(tmp_path / "app")
    writers.write_twice(df, lambda d: writers.append_chunks(d, path), lambda d: writers.rebuild(d, str(tmp_path / "re")))
    writers.append_chunks(df, path)
    writers.rebuild(df, str(tmp_path / "re"))
    assert spark.read.parquet(path).count() == 4 and spark.read.parquet(str(tmp_path / "re")).count() == 2
    numbered = str(tmp_path / "num")
    for _ in range(2):
        writers.append_numbered(spark, df.select("chunk_text"), ["chunk_text"], numbered)
    assert sorted((r["id"], r["chunk_text"]) for r in spark.read.parquet(numbered).collect()) == [
        (0, "a"), (1, "b"), (2, "a"), (3, "b")]


def test_images_and_listing(spark, tmp_path):
    for name in ("b.PNG", "a.jpg", "c.txt"):
        put(tmp_path / "im" / name, "x")
    assert sorted(os.path.basename(r["path"]) for r in readers.image_folder(spark, str(tmp_path / "im")).collect()) == ["a.jpg", "b.PNG"]
    from weftline.operators import corpus_search

    os.utime(tmp_path / "im" / "a.jpg", (1, 1))
    put(tmp_path / "im" / "build" / "z.jpg", "x")
    listed = corpus_search.list_paths(readers.file_listing(spark, str(tmp_path / "im")), "**/*.[a-z]*".replace("[a-z]", ""), True)
    assert [os.path.basename(r["path"]) for r in listed.collect()][-1] == "a.jpg"
    assert not any("build" in r["path"] for r in listed.collect())
