"""A JSON array is read by many tasks and loses nothing at the borders of their splits."""

from __future__ import annotations

import json
import random

import pytest

from weftline.sources import json_array, readers


@pytest.fixture()
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(n) for n in names]
    spark.conf.set(names[0], "300")
    spark.conf.set(names[1], "0")
    yield
    for n, v in zip(names, old):
        spark.conf.set(n, v)


def value(rnd, depth=0):
    kind = rnd.randrange(8 if depth < 4 else 5)
    text = "".join(rnd.choice('a{}[]",\\é\n 𝄞:x') for _ in range(rnd.choice((0, 3, 12, 400))))
    if kind < 3:
        return text
    if kind < 5:
        return rnd.choice((None, True, 1.5, -7))
    if kind == 5:
        return [value(rnd, depth + 1) for _ in range(rnd.randrange(4))]
    return {f"k{i}{text[:4]}": value(rnd, depth + 1) for i in range(rnd.randrange(4))}


def test_elements_and_places(spark, small_splits, tmp_path):
    rnd = random.Random(5)
    want = {}
    for f in range(6):
        rows = [value(rnd) for _ in range((0, 1, 60, 90, 2, 30)[f])]
        pad = rnd.choice(("", " \n"))
        (tmp_path / f"{f}.json").write_text(pad + json.dumps(rows, ensure_ascii=f % 2 == 0, indent=rnd.choice((None, 2))) + pad)
        want[f"{f}.json"] = rows
    (tmp_path / "long.json").write_text(json.dumps(["x}" * 5000, {"a": ["{" * 3000]}]))
    want["long.json"] = ["x}" * 5000, {"a": ["{" * 3000]}]
    found = json_array.elements(spark, str(tmp_path))
    got = {n: {} for n in want}
    for r in found.collect():
        name = r["file"].rsplit("/", 1)[1]
        assert r["ord"] not in got[name]
        got[name][r["ord"]] = json.loads(r["text"])
        raw = (tmp_path / name).read_bytes()
        assert raw[r["offset"]:r["offset"] + len(r["text"].encode())] == r["text"].encode()
    assert {n: [x[i] for i in range(len(x))] for n, x in got.items()} == want
    assert spark.read.option("lineSep", "}").text(str(tmp_path)).rdd.getNumPartitions() > 50


@pytest.mark.parametrize("text", [" ", "{}", "7", "[1", "[1]]", "][", "[1] [2]", "[1],2", "x[1]", "[1]x", "[1,]", "[,1]", "[1,,2]", '["a]', "[1}", "[1]}", '{"a":[1]}'])
def test_what_is_no_array_is_an_error(spark, tmp_path, text):
    (tmp_path / "ok.json").write_text("[1]")
    (tmp_path / "nothing.json").write_text("")
    (tmp_path / "bad.json").write_text(text)
    with pytest.raises(Exception, match="damaged JSON array.*bad.json"):
        json_array.elements(spark, str(tmp_path)).collect()


def test_damaged_export_is_named_by_its_byte(spark, tmp_path):
    first = '[{"title": "a", "mapping": {}}, '
    (tmp_path / "e.json").write_text(first + '{"title": nonsense}, {"title": "c"}]')
    with pytest.raises(Exception, match=f"damaged export: .*e.json at byte {len(first) - 1}"):
        readers.exports(spark, str(tmp_path)).collect()
