"""Path patterns of tool calls find what their expression finds, and those that name a file need no index."""

from __future__ import annotations

import itertools
import json
import re
from collections import Counter

import pytest

from weftline.operators import corpus_search, trigrams

PATHS = ["x.txt", "a/x.txt", "a/b/x.txt", "ab/c/x.txt", "a/x.txt", "b/y.txt", "a.b/y.txt", "a/b/", "d/[x].txt", "é/x.txt", "a/xxtxt", "up\nb/y.txt", "a/x.txt\n"]
NAMED = ["x.txt", "a/x.txt", "*/x.txt", "**/x.txt", "a**/x.txt", "a/**/x.txt", "?/x.txt", "a?/*/x.txt", "**/b/x.txt", "a.b/y.txt", "a?b/y.txt", "b/y.txt", "d/[x].txt",
         "a/b/", "**/", "(/x.txt", "", "z/none.txt", "*/*/x.txt", "***/x.txt"]
WILD = ["*.txt", "a/*", "**", "**/*.txt", "a/?.txt"]


def calls_of(spark, patterns):
    rows = [(k if k % 5 else None, "glob", json.dumps({"pat": p})) for k, p in enumerate([*patterns, *patterns[:2]])]
    return spark.createDataFrame(rows, "call_id int, name string, args string")


def wanted(patterns):
    found = Counter()
    for k, p in enumerate([*patterns, *patterns[:2]]):
        rx = re.compile(corpus_search.glob_pattern(p))
        for path in PATHS:
            if "\n" not in path and rx.search(path):
                found[k if k % 5 else None, "glob", 0, path] += 1
    return found


@pytest.mark.parametrize("patterns", [NAMED, WILD, NAMED + WILD])
def test_path_patterns(spark, patterns):
    corpus = spark.createDataFrame([*((p, "text") for p in PATHS), (None, "text")], "path string, text string").repartition(3)
    got = Counter(tuple(r) for r in corpus_search.run_calls(calls_of(spark, patterns), corpus, pattern_block=2).collect() if "\n" not in r["output"])
    assert got == wanted(patterns)


def test_file_names_need_no_index(spark, monkeypatch):
    """every path pattern was compiled, and all paths were indexed, before a file name was looked at."""
    def refuse(*_):
        raise AssertionError("no index is needed")

    monkeypatch.setattr(trigrams, "path_index", refuse)
    monkeypatch.setattr(trigrams, "build_index", refuse)
    corpus = spark.createDataFrame([(p, "text") for p in PATHS], "path string, text string")
    got = Counter(tuple(r) for r in corpus_search.run_calls(calls_of(spark, NAMED), corpus).collect() if "\n" not in r["output"])
    assert got == wanted(NAMED)


def test_hits_leave_in_small_batches(spark, monkeypatch):
    rows = {"patterns": [[{"pattern": p, "regex": p} for p in ("a", "b", ".", "")]] * 20, "path": ["p", None] * 10, "first_line": [1, 33] * 10, "text": ["ab\nA\n\nb"] * 20}
    import pyarrow as pa

    monkeypatch.setattr(trigrams, "HIT_ROWS", 7)
    batches = list(trigrams._hits(iter([pa.RecordBatch.from_pydict(rows)])))
    assert max(b.num_rows for b in batches) <= 7 + 4
    found = Counter(tuple(r.values()) for b in batches for r in b.to_pylist())
    lines = list(enumerate(["ab", "A", "", "b"]))
    assert found == Counter((p, path, first + n, line) for path, first in itertools.islice(itertools.cycle([("p", 1), (None, 33)]), 20)
                            for p in ("a", "b", ".", "") for n, line in lines if re.search(p, line))
