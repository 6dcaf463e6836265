"""The trigram index finds what a scan finds, and reads only the blocks that can match."""

from __future__ import annotations

import random
import re

import pytest

from weftline.operators import corpus_search, trigrams

PATTERNS = ["needle", "(?i)NEEDLE", "ne+dle", "(?:nee|noo)dle", "^line 7\\b", "[0-9]{3}x", "x?yz?", "", "İstanbul|ISTANBUL", "(?i)istanbul", "(?i)kiss", "a.c", "(abc)+d",
            "(?:abc){2}", "ab(?=cd)", "é{2,}", "tail$", "\\\\d", "(?x) nee dle  # free", "naïve", "(?i)NAÏVE", "abc*d", "(?:xyz)?needle", "\\w+ing"]


def texts():
    rng = random.Random(2)
    words = ["needle", "Needle", "neeeedle", "noodle", "abc", "abcabcd", "abcd", "éé", "tail", "\\d", "ISTANBUL", "İstanbul", "ıstanbul", "Kiss", "kiſs", "123x", "y",
             "naïve", "NAÏVE", "abd", "singing", "a c", "axc"]
    rows = []
    for k in range(120):
        lines = [f"line {i} " + " ".join(rng.choice(words) if rng.random() < 0.04 else f"w{rng.randrange(500)}" for _ in range(6)) for i in range(rng.choice([0, 1, 5, 90]))]
        rows.append((f"p{k % 100}" if k % 13 else None, "\n".join(lines) + ("\n" if k % 2 else "")))
    return [*rows, ("empty", ""), ("null", None), ("breaks", "\n\n"), ("long", "z " * 100_000 + "needle")]


def scan(rows, pattern):
    found = []
    for path, text in rows:
        if text:
            found += [(path, n, line) for n, line in enumerate(text.removesuffix("\n").split("\n"), 1) if re.search(pattern, line)]
    return found


def test_index_finds_what_a_scan_finds(spark, tmp_path):
    rows = texts()
    index = trigrams.build_index(spark.createDataFrame(rows, "path string, text string"), str(tmp_path / "index"))
    asked = spark.createDataFrame([(p, p) for p in PATTERNS], "pattern string, regex string")
    got = {}
    for r in trigrams.search(index, asked).collect():
        got.setdefault(r["pattern"], []).append((r["path"], r["line_no"], r["line"]))
    key = lambda x: (str(x[0]), *x[1:])
    for p in PATTERNS:
        assert sorted(got.get(p, []), key=key) == sorted(scan(rows, p), key=key), p
    again = trigrams.open_index(spark, str(tmp_path / "index"))
    hits = corpus_search.grep_index(again, "(?i)needle", limit=5).collect()
    want = sorted((x for x in scan(rows, "(?i)needle")), key=lambda x: (x[0] is not None, x[0] or "", x[1]))
    assert [(h["path"], h["line_no"]) for h in hits] == [w[:2] for w in want[:5]] and all(h["more"] == len(want) - 5 for h in hits)


def test_few_blocks_are_read(spark):
    rows = [(f"d{k}", "\n".join(f"word{k}x{i} common words" for i in range(64))) for k in range(200)]
    index = trigrams.build_index(spark.createDataFrame(rows, "path string, text string"))
    assert index.blocks.count() == 200 * 2
    asked = spark.createDataFrame([("rare", "word77x1[0-9] common"), ("none", "quixotic"), ("all", "common words")], "pattern string, regex string")
    read = {r["pattern"]: r["count"] for r in trigrams.candidates(index, asked).groupBy("pattern").count().collect()}
    assert read.get("none", 0) == 0 and read["rare"] <= 4 and read["all"] == 400
    assert trigrams.search(index, asked.filter("pattern = 'rare'")).count() == 10


def test_every_word_of_a_corpus(spark):
    rng = random.Random(4)
    rows = [(f"d{k}", "\n".join(" ".join(rng.choice("abcdeé") * rng.randrange(1, 4) + str(rng.randrange(60)) for _ in range(8)) for _ in range(40))) for k in range(12)]
    words = sorted({w for _, text in rows for w in text.split()})
    asked = spark.createDataFrame([(w, rf"(?<!\S){w}(?!\S)") for w in words], "pattern string, regex string")
    got = trigrams.search(trigrams.build_index(spark.createDataFrame(rows, "path string, text string")), asked)
    want = {(w, p, n) for p, text in rows for n, line in enumerate(text.split("\n"), 1) for w in line.split()}
    assert {(r["pattern"], r["path"], r["line_no"]) for r in got.collect()} == want


def test_packs_of_many_loose_patterns(spark):
    rows = [("a", "1 2 3\n4 5 6"), ("b", "7 8 9")]
    asked = spark.createDataFrame([(str(k), str(k)) for k in range(10)], "pattern string, regex string")
    got = trigrams.search(trigrams.build_index(spark.createDataFrame(rows, "path string, text string")), asked, pack=3)
    assert sorted(r["pattern"] for r in got.collect()) == [str(k) for k in range(1, 10)]


@pytest.mark.parametrize("pattern, grams", [
    ("needle", ["dle", "edl", "eed", "nee"]), ("(?i)KISS", ["iss", "kis"]), ("ab(cd)+ef", ["abc", "bcd"]), ("ab|cdef", []), ("a.bcd?", []),
    ("(?i)naïve", []), ("naïve", ["aïv", "naï", "ïve"]), ("(?:abc)?def", ["def"]), ("(?i:ABC)DEF", ["abc", "bcd", "cde", "def"]), ("ab\ncd", [])])
def test_required_trigrams(pattern, grams):
    assert trigrams.required_grams(pattern) == grams


def grams_of(texts):
    grams, places = trigrams.block_grams(texts)
    return list(zip(trigrams._gram_names(grams), places.tolist()))


def test_trigrams_in_arrays(monkeypatch):
    """Each trigram of the folded lines once per text, also where a window ends or characters are many."""
    rng = random.Random(5)
    texts = ["".join(rng.choice("abAB\nÉéİıſK\U0001f600") for _ in range(rng.choice([0, 1, 2, 3, 50, 400]))) for _ in range(60)]
    want = sorted((line[i:i + 3], k) for k, text in enumerate(texts) for line in {trigrams.fold(x) for x in text.split("\n")} for i in range(len(line) - 2))
    for window in (4 << 20, 1000, 64):
        monkeypatch.setattr(trigrams, "RUN_CHARS", window)
        got = grams_of(texts)
        assert len(got) == len(set(got)) and sorted(got) == sorted(set(want)), window
    monkeypatch.undo()
    wide = "".join(map(chr, range(0x10000, 0x10000 + 230_000)))  # too many different characters for one number per pair
    got = grams_of(["abcabc"] * 1000 + [wide])
    assert got[:3000:1000] == [("abc", 0), ("bca", 0), ("cab", 0)] and len(got) == 3000 + 230_000 - 2
    assert grams_of([]) == grams_of(["", "ab", "\n\n\n"]) == []


def test_fold_is_by_character():
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    assert trigrams.fold(every) == every.translate(str.maketrans(trigrams._FOLD))
    assert trigrams.fold("ABC xyZ[") == "abc xyz["


def test_common_patterns_need_no_candidates(spark, monkeypatch):
    """a pattern that most blocks hold made a row of candidates per block."""
    rows = [(f"d{k}", "\n".join(f"word{k} Common words {i}" for i in range(64))) for k in range(50)]
    index = trigrams.build_index(spark.createDataFrame(rows, "path string, text string"))
    seen = []
    monkeypatch.setattr(trigrams, "candidates", lambda i, p, found=trigrams.candidates: seen.append(sorted(r["pattern"] for r in p.collect())) or found(i, p))
    asked = spark.createDataFrame([(p, p) for p in ("common", "(?i)common words 6[0-9]", "word7 ", "quixotic", "7$")], "pattern string, regex string")
    got = {}
    for r in trigrams.search(index, asked, pack=2).collect():
        got.setdefault(r["pattern"], set()).add((r["path"], r["line_no"]))
    assert seen == [["quixotic", "word7 "]]
    for p in ("common", "(?i)common words 6[0-9]", "word7 ", "quixotic", "7$"):
        assert got.get(p, set()) == {(path, n) for path, n, _ in scan(rows, p)}, p


def test_postings_are_rows_of_runs(spark):
    """A trigram takes a row per run of blocks, not per block, and the counts are those of blocks."""
    lines = "\n".join(f"alpha beta {i}" for i in range(20_000))
    index = trigrams.build_index(spark.createDataFrame([("p", lines)], "path string, text string"))
    n_blocks = index.blocks.count()
    row = index.postings.filter("gram = 'alp'")
    assert row.count() < n_blocks / 50 and index.grams.filter("gram = 'alp'").first()["n"] == n_blocks > 300
    hits = trigrams.search(index, spark.createDataFrame([("p1", "beta 1999[89]$"), ("p2", "beta 77$")], "pattern string, regex string"))
    assert sorted((r["pattern"], r["line_no"]) for r in hits.collect()) == [("p1", 19_999), ("p1", 20_000), ("p2", 78)]
