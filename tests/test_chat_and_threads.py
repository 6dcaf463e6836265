"""Threads, messages and views on small fixtures."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from weftline.operators import export, threads
from weftline.operators.ordering import dense_index

SCHEMA = "file string, line_no bigint, uuid string, parent string, type string, content string"


def table(spark, rows):
    return spark.createDataFrame([("f", i, u, p, t, json.dumps(c)) for i, (u, p, t, c) in enumerate(rows)], SCHEMA)


def walks(spark, records):
    nodes = threads.nodes(records)
    return threads.walk_up(nodes, threads.leaves(records, nodes))


def paths(spark, records):
    return {r["leaf"]: r["path"] for r in threads.threads(walks(spark, records)).collect()}


def test_long_chain_is_cut_at_sixty(spark):
    rows = [(f"n{i}", f"n{i - 1}" if i else None, "user" if i % 2 == 0 else "assistant", "x") for i in range(65)]
    path = paths(spark, table(spark, rows))["n64"]
    assert path == [f"n{i}" for i in range(5, 65)]


def test_branches_foreign_parents_and_repeated_uuids(spark):
    rows = [("a", None, "user", "1"), ("b", "a", "assistant", "2"), ("c", "b", "user", "3"), ("c2", "b", "user", "4"),
            ("s", "c", "system", "skip"), ("d", "s", "assistant", "5"), ("c", "gone", "user", "again")]
    got = paths(spark, table(spark, rows))
    # c now hangs on a missing parent; its old child link to b still makes b an inner node
    assert got == {"c": ["c"], "c2": ["a", "b", "c2"], "d": ["d"]}


def test_hot_parent(spark):
    rows = [("root", None, "user", "q")] + [(f"k{i}", "root", "assistant", "a") for i in range(500)]
    got = paths(spark, table(spark, rows))
    assert len(got) == 500 and all(p == ["root", leaf] for leaf, p in got.items())


def test_contents_become_messages(spark):
    big = "y" * 900
    rows = [
        ("u1", None, "user", "  plain  "),
        ("u2", None, "user", [{"type": "tool_result", "content": big}, {"type": "text", "text": "dropped"}]),
        ("u3", None, "user", [{"type": "tool_result", "content": [{"type": "text", "text": "[1"}, {"type": "img"}, {"type": "text", "text": "2]"}]}]),
        ("u4", None, "user", [{"type": "tool_result", "content": ""}, {"type": "text", "text": "a"}, {"type": "text", "text": "b"}]),
        ("u5", None, "user", "   "),
        ("u6", None, "user", [{"type": "tool_result", "content": "[looks like a list]"}]),
        ("a1", None, "assistant", "ignored string"),
        ("a2", None, "assistant", [{"type": "thinking", "text": "t"}, {"type": "text", "text": " one "}, {"type": "text", "text": "two"}]),
        ("a3", None, "assistant", [{"type": "text", "text": "x"}, {"type": "tool_use", "name": "Read", "input": {"b": 1, "a": [2]}}]),
        ("a4", None, "assistant", [{"type": "tool_use", "name": "Unknown", "input": {}}]),
        ("a5", None, "assistant", [{"type": "tool_use", "name": "Bash"}]),
    ]
    records = table(spark, rows)
    got = {r["uuid"]: r["text"] for r in threads.node_messages(records, threads.nodes(records)).collect()}
    assert set(got) == {"u1", "u2", "u3", "u4", "u6", "a2", "a3", "a5"}
    assert got["u1"] == "plain" and got["u4"] == "a b" and got["a2"] == "one\ntwo"
    assert json.loads(got["u2"]) == [{"type": "tool_result", "content": "y" * 800}]
    assert json.loads(got["u3"]) == [{"type": "tool_result", "content": "[1\n2]"}]
    assert json.loads(got["u6"]) == [{"type": "tool_result", "content": "[looks like a list]"}]
    assert json.loads(got["a3"]) == [{"type": "tool_use", "name": "Read", "input": {"a": [2], "b": 1}}]
    assert json.loads(got["a5"]) == [{"type": "tool_use", "name": "Bash", "input": {}}]


def msgs(text):
    """``u`` user, ``a`` assistant, ``t`` assistant tool call, ``r`` tool result."""
    kinds = {"u": ("user", "q"), "a": ("assistant", "x"), "t": ("assistant", "[call"), "r": ("user", "[res")}
    return [kinds[c] for c in text]


@pytest.mark.parametrize("text, expected", [
    ("ut", True), ("u", False), ("ua", False), ("utra", True), ("rt", False), ("utr", False), ("uut", False),
    ("tu", False), ("", False),
])
def test_validity(spark, text, expected):
    df = spark.createDataFrame([(msgs(text),)], "m array<struct<role: string, content: string>>")
    assert df.select(threads.is_valid(F.col("m")).alias("v")).first()["v"] is expected


def reference_windows(m):
    def valid(w):
        return (len(w) >= 2 and w[0][0] == "user" and not w[0][1].startswith("[") and w[-1][0] == "assistant"
                and any(r == "assistant" and c.startswith("[") for r, c in w)
                and all(x[0] != y[0] for x, y in zip(w, w[1:])))

    out = []
    for s in range(0, len(m) - 1, 2):
        w = m[s:s + 12]
        w = w if w[-1][0] == "assistant" else w[:-1]
        if valid(w):
            out.append(w)
    return out


@pytest.mark.parametrize("text", ["", "u", "ut", "utra" * 6, "utrau" * 5, "ua" * 10 + "ut", "uutraut", "utra" * 3 + "u"])
def test_windows(spark, text):
    m = msgs(text)
    df = spark.createDataFrame([(m,)], "messages array<struct<role: string, content: string>>")
    got = df.select(threads.windows(F.col("messages")).alias("w")).first()["w"] or []
    assert [[tuple(x) for x in w] for w in got] == reference_windows(m)


def test_examples_from_records(spark):
    rows = []
    for i in range(16):
        kind = "user" if i % 2 == 0 else "assistant"
        content = f"question {i}" if kind == "user" else [{"type": "tool_use", "name": "Read", "input": {"i": i}}]
        rows.append((f"n{i}", f"n{i - 1}" if i else None, kind, content))
    got = threads.build_examples(table(spark, rows)).collect()
    assert sorted(len(r["messages"]) for r in got) == [2, 4, 6, 8, 10, 12, 12, 12]


def test_thread_view(spark):
    schema = "thread_id int, created_at int, role string, content array<struct<type: string, text: string>>"
    rows = [(1, 3, "user", [("text", " hi ")]), (1, 1, "user", [("file", None)]), (1, 2, "assistant", []),
            (1, 4, "user", [("image_file", None)]), (1, 5, "user", [("odd", None)])]
    got = export.thread_view(spark.createDataFrame(rows, schema)).collect()
    assert [r["message"] for r in got] == ["[File received]", "[No content]", "hi", "[Image received]", "[No content]"]


def test_dense_index_is_used_for_sorted_titles(spark):
    df = spark.createDataFrame([(0, "b"), (1, "a")], "o int, t string")
    assert {(r["t"], r["idx"]) for r in dense_index(df, "t").collect()} == {("a", 0), ("b", 1)}
