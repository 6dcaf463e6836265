"""Names of a dictionary are found where a plain search finds them."""

from __future__ import annotations

import random

import pytest

from weftline.operators import dictionary
from weftline.operators.dictionary import Automaton


def places(text, names):
    return [(n, i, i + len(n)) for n in names for i in range(len(text)) if text.startswith(n, i)]


@pytest.fixture(scope="module")
def case(spark):
    rng = random.Random(4)
    draw = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    names = sorted({draw("abé", rng.randint(1, 6)) for _ in range(70)} | {draw("abé", 900), "naïve 😀", "a b"})
    texts = [(i, draw("abéc ", rng.choice([0, 1, 7, 40]))) for i in range(60)]
    texts += [(60, None), (61, ""), (62, draw("abéc", 5000) + names[-1] + "naïve 😀"), (62, "a b"), (None, "ab")]
    texts.append((63, "c" + next(n for n in names if len(n) == 900) + "c"))
    return names, texts, spark.createDataFrame(texts, "id bigint, text string")


def table(spark, names):
    return spark.createDataFrame([(n,) for n in [*names, names[0], "", None]], "name string")


@pytest.mark.parametrize("shard_bytes", [dictionary.SHARD_BYTES, 150])
def test_occurrences_counts_and_longest(spark, case, shard_bytes, tmp_path):
    names, texts, rows = case
    built = dictionary.build(table(spark, names), where=str(tmp_path / "d"), shard_bytes=shard_bytes)
    assert (built.shards > dictionary.SHARDS_PER_PASS) == (shard_bytes == 150)
    stored = dictionary.open_dictionary(spark, str(tmp_path / "d"))
    key = str
    want = sorted(((i, *p) for i, x in texts for p in places(x or "", names)), key=key)
    assert sorted((tuple(r) for r in dictionary.occurrences(rows, "text", ["id"], stored).collect()), key=key) == want
    counts = {}
    for k, (i, x) in enumerate(texts):
        for n, _, _ in places(x or "", names):
            counts[k, i, n] = counts.get((k, i, n), 0) + 1
    got = dictionary.name_counts(rows, "text", ["id"], stored).collect()
    assert sorted((tuple(r) for r in got), key=key) == sorted(((i, n, c) for (_, i, n), c in counts.items()), key=key)
    best = {}
    for i, n, begin, _ in want:
        best[i] = min(best.get(i, (1, "", 0)), (-len(n), n, begin))
    got = dictionary.longest_names(rows, "text", ["id"], stored).collect()
    assert {r["id"]: (-len(r["name"]), r["name"], r["begin"]) for r in got} == best


def test_empty_sides_and_extra_columns(spark, case):
    names, _, rows = case
    empty = dictionary.build(spark.createDataFrame([], "name string"))
    assert dictionary.occurrences(rows, "text", ["id"], empty).count() == 0
    built = dictionary.build(table(spark, names))
    assert dictionary.longest_names(rows.limit(0), "text", ["id"], built).count() == 0
    clash = spark.createDataFrame([("x", 1, 2, "a b")], "row string, shard int, id int, text string")
    assert dictionary.occurrences(clash, "text", ["row", "shard"], built).count() == len(places("a b", names))


def test_a_million_names(spark):
    """Names come from a table and meet in several automata; the found rows equal a lookup by pieces."""
    names = spark.range(1_000_000).selectExpr("concat('n', lpad(cast(id as string), 7, '0'), '-', substr(md5(cast(id as string)), 1, 4)) as name")
    built = dictionary.build(names)
    assert built.shards == 4
    texts = spark.range(0, 3_000_000, 1499).selectExpr(
        "id", "concat('see n', lpad(cast(id as string), 7, '0'), '-', substr(md5(cast(id as string)), 1, 4), ' or n0000000-0000 end') as text")
    found = dictionary.occurrences(texts, "text", ["id"], built)
    assert [r["id"] for r in found.select("id").orderBy("id").collect()] == list(range(0, 1_000_000, 1499))
    assert found.filter("`begin` <> 4 or `end` <> 17").count() == 0


def test_work_follows_the_text(monkeypatch):
    """A byte costs about two lookups with five names and with fifty thousand."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    text = " ".join(word() for _ in range(5000)).encode()
    looked = []
    for n in (5, 50_000):
        automaton = Automaton.build(sorted({word().encode() for _ in range(n)}))
        count = [0]
        plain = automaton._child
        monkeypatch.setattr(automaton, "_child", lambda s, b, c=count, f=plain: (c.__setitem__(0, c[0] + len(s)), f(s, b))[1])
        data = dictionary.np.frombuffer(text, dictionary.np.uint8)
        automaton.search(data, dictionary.np.array([0, len(data)]))
        looked.append(count[0] / len(text))
    assert max(looked) < 2.1


def test_written_out_states_are_the_same(case):
    """A small automaton's whole table gives what its edges and failure links give."""
    names, texts, _ = case
    automaton = Automaton.build(sorted(n.encode() for n in names))
    coded = [(x or "").encode() for _, x in texts]
    data = dictionary.np.frombuffer(b"".join(coded), dictionary.np.uint8)
    offsets = dictionary.np.cumsum([0, *map(len, coded)])
    linked = automaton.search(data, offsets)
    automaton.densify()
    assert len(linked[0]) and all((a == b).all() for a, b in zip(linked, automaton.search(data, offsets)))
