"""Merkle manifest, chat tree and prefix trie against brute force on small fixtures."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from weftline.llm import chat_tree, merkle, prefix_counts, prefix_trie, queries, running
from weftline.session import ship_package

DATA = "/root/testdata/sf0.001"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


# ---------------------------------------------------------------- running sums

def test_running_sums_in_hot_and_small_groups(spark):
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.7 else f"g{rng.randrange(9)}", k, rng.randrange(5)) for k in range(700)]
    df = spark.createDataFrame(rows, "g string, k int, v bigint").repartition(7)
    got = running.running(df, ["g"], [F.col("k").desc()], ["v"]).collect()
    for r in got:
        earlier = [v for g, k, v in rows if g == r["g"] and k > r["k"]]
        assert (r["before_v"], r["all_v"]) == (sum(earlier), sum(v for g, _, v in rows if g == r["g"]))
    assert len(got) == len(rows)
    assert running.running(df.limit(0), ["g"], [F.col("k")], ["v"]).collect() == []


# ---------------------------------------------------------------- Merkle manifest

FIELDS = ["doc_id", "lang", "text"]


def brute_leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def brute_up(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha("".join(below[i:i + 8])) for i in range(0, len(below), 8)])
    return levels


def brute_path(levels, at):
    sides = []
    for level in levels[:-1]:
        run = at // 8 * 8
        sides.append(("".join(level[run:at]), "".join(level[at + 1:run + 8])))
        at //= 8
    return sides


def brute_manifest(rows):
    """Sorted (doc_id, leaf, subroot, root, path) of (doc_id, lang, text) rows."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        members = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, brute_leaf(r)))
        trees[g] = (members, brute_up([brute_leaf(r) for r in members]))
    top = brute_up([trees[g][1][-1][0] for g in names]) if names else None
    out = []
    for k, g in enumerate(names):
        members, levels = trees[g]
        for at, r in enumerate(members):
            out.append((r[0], levels[0][at], levels[-1][0], top[-1][0], brute_path(levels, at) + brute_path(top, k)))
    return out


def documents(n_big):
    rng = random.Random(5)
    rows = [(i, "en", f"text {i}") for i in range(n_big)]
    rows += [(i, "de", f"Text {i}") for i in range(65)] + [(7, "fr", "Seul")] + [(i, "es", "") for i in range(8)] + [(i, "é", "x" * 70_000) for i in range(9)]
    rows += [(1, None, "no language"), (2, None, None), (None, "de", "no id"), (None, "de", "no id"), (3, "de", "Text 3"), (3, "de", "another 3"), (4, "", "empty name")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("n_big", [0, 513, 5000])
def test_manifest_against_brute_force(spark, n_big):
    rows = documents(n_big)
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id bigint, lang string, text string, tree string, digest int")
    got = merkle.manifest(df, FIELDS, by="lang", key="doc_id").withColumn("again", merkle.fold(F.col("leaf"), F.col("path")))
    got = got.withColumn("proof", merkle.proof_digest(F.col("path"))).collect()
    want = brute_manifest(rows)
    key = lambda r: (str(r[0]), r[1:4], str(r[4]))
    shown = [(r["doc_id"], r["leaf"], r["subroot"], r["root"], [(s["left"], s["right"]) for s in r["path"]]) for r in got]
    assert sorted(shown, key=key) == sorted(want, key=key)
    assert all(r["again"] == r["root"] for r in got)
    assert sorted(r["proof"] for r in got) == sorted(sha("".join(a + b for a, b in w[4])) for w in want)


def test_manifest_of_one_row_and_of_none(spark):
    one = spark.createDataFrame([(1, "en", "x")], "doc_id bigint, lang string, text string")
    r = merkle.manifest(one, FIELDS, by="lang", key="doc_id").first()
    assert r["leaf"] == r["subroot"] == r["root"] == brute_leaf((1, "en", "x")) and r["path"] == []
    assert merkle.manifest(one.limit(0), FIELDS, by="lang", key="doc_id").collect() == []


def test_changed_text_does_not_fold_to_the_root(spark):
    df = spark.createDataFrame(documents(20), "doc_id bigint, lang string, text string")
    made = merkle.manifest(df, FIELDS, by="lang", key="doc_id", extra={"now": merkle.digest([F.col("doc_id"), F.col("lang"), F.concat("text", F.lit("!"))])})
    assert made.filter(merkle.fold(F.col("now"), F.col("path")) == F.col("root")).filter("now <> leaf").isEmpty()


# ---------------------------------------------------------------- tries

def conversations():
    """Shared beginnings, exact copies, a long chain, nulls, repeated rows and a comb."""
    rng = random.Random(11)
    rows = []
    for c in [*range(0, 60), 100, 101, 102, 150, 199, 205, 300, -3, -150]:
        n = rng.choice([1, 1, 2, 3, 5, 8, 9])
        for t in range(n):
            text = f"same {t}" if rng.random() < 0.6 else f"own {c} {t} \\</turn> <turn:é> \\\\"
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", text))
    rows += [(400, t, "user" if t % 2 == 0 else "assistant", f"same {t}") for t in range(70)]  # a long chain and copies of its beginnings
    rows += [(401 + k, t, "user" if t % 2 == 0 else "assistant", f"same {t}" if t < 3 * k else f"leaf {k}") for k in range(12) for t in range(3 * k + 1)]
    rows += [(500, 0, None, None), (500, 1, "assistant", ""), (501, None, "user", "first"), (501, 0, "us>er\n", "then"), (501, 1, "assistant", "z" * 50_000)]
    rows += [(502, 3, "user", "twice"), (502, 3, "user", "twice"), (502, 3, "user", "other"), (None, 0, "user", "nobody"), (None, 1, "assistant", "at all")]
    rng.shuffle(rows)
    return rows


SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def digest_of(role, text):
    return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()


def in_order(rows):
    talks = defaultdict(list)
    for c, t, role, text in rows:
        role, text = role or "", text or ""
        talks[c].append(((t is not None, t or 0, digest_of(role, text)), (role, text)))
    return {c: [x for _, x in sorted(v)] for c, v in talks.items()}


def rebuilt(talks):
    out = {}
    for c, own in talks.items():
        h = 0 if c is None else zlib.crc32(str(c).encode()) % 6
        base = None if c is None else c - (c % 100 if c >= 0 else -(-c % 100))
        out[c] = (talks.get(base, [])[:h] if c is not None else []) + own[h:]
    return out


def brute_trie(talks):
    low = lambda c: prefix_trie.NO_ID if c is None else c
    members, kids = defaultdict(list), defaultdict(set)
    for c, turns in talks.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                kids[tuple(turns[:d - 1])].add(tuple(turns[:d]))
    name = {p: min(m, key=low) for p, m in members.items()}

    def leaves(p):
        return sum(map(leaves, kids[p])) if kids[p] else 1

    def saved(p):
        return (len(members[p]) - 1) * (len(p[-1][1]) if p else 0) + sum(map(saved, kids[p]))

    rows = []
    for p, m in members.items():
        ends = sorted((c for c in m if len(talks[c]) == len(p)), key=low)
        rows.append((name[p], len(p), name[p[:-1]] if p else None, len(m), len(kids[p]), leaves(p), saved(p),
                     sha(",".join("" if c is None else str(c) for c in ends))))
    return rows


@pytest.mark.parametrize("height", [2, 3, 32])
def test_trie_against_brute_force(spark, height):
    ship_package(spark)
    rows = conversations()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", chain int, digest string")
    turns = prefix_counts.numbered_turns(df)
    got = prefix_counts.prefix_trie(prefix_counts.rebuilt_turns(turns), height=height)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, brute_trie(rebuilt(in_order(rows)))))


def test_trie_of_nothing_and_of_turnless_conversations(spark):
    ship_package(spark)
    empty = spark.createDataFrame([], SCHEMA)
    assert prefix_counts.prefix_trie(prefix_counts.rebuilt_turns(prefix_counts.numbered_turns(empty))).collect() == []
    ids = [c for c in range(1, 40) if zlib.crc32(str(c).encode()) % 6 > 0]  # no base, and the only own turn is cut
    df = spark.createDataFrame([(c, 0, "user", "hi") for c in ids], SCHEMA)
    got = prefix_counts.prefix_trie(prefix_counts.rebuilt_turns(prefix_counts.numbered_turns(df))).collect()
    assert [tuple(r) for r in got] == [(ids[0], 0, None, len(ids), 0, 1, 0, sha(",".join(map(str, ids))))]


def test_many_ids_end_at_one_node(spark):
    """Pieces of one node follow in numeric order."""
    ship_package(spark)
    ids = [*range(-9000, 9000, 7), *range(10**12, 10**12 + 9000, 11)]
    df = spark.createDataFrame([(bytearray(b"k"), i) for i in ids], "key binary, chain bigint")
    assert prefix_counts.id_digests(df).first()["ends_sha256"] == sha(",".join(map(str, ids)))


@pytest.mark.parametrize("height", [2, 32])
def test_chat_stream_rows_positions_and_intervals(spark, height):
    ship_package(spark)
    rows = conversations()
    talks = in_order(rows)
    stream, threads = chat_tree.format_chats(spark.createDataFrame(rows, SCHEMA), height=height)
    stream = sorted(stream.collect(), key=lambda r: r["row"])
    threads = {r["conv_id"]: r for r in threads.collect()}
    assert [r["row"] for r in stream] == list(range(len(stream)))
    assert len(stream) == len({tuple(t[:d]) for t in talks.values() for d in range(1, len(t) + 1)})  # shared turns once
    at = 0
    open_rows = []  # ancestors of the row, by a stack over the depths
    for r in stream:
        assert r["first_token"] == at
        at += len(r["ids"])
        open_rows = [*open_rows[:r["depth"]], r["row"]]
        assert len(open_rows) == r["depth"] + 1
        seen = [k for x in r["attends"] for k in range(x["first_row"], x["next_row"])]
        assert seen == open_rows
        tokens = [k for x in r["attends"] for k in range(x["first_token"], x["next_token"])]
        assert tokens == [k for j in open_rows for k in range(stream[j]["first_token"], stream[j]["first_token"] + len(stream[j]["ids"]))]
        before = sum(len(stream[j]["ids"]) for j in open_rows[:-1])
        assert r["position_ids"] == list(range(before, before + len(r["ids"])))
        assert all(a["next_token"] < b["first_token"] for a, b in zip(r["attends"], r["attends"][1:]))
    total = at
    assert max(len(r["attends"]) for r in stream) <= total.bit_length() + 1
    coder = chat_tree.tokenizer(open(chat_tree.default_ranks_path(), "rb").read())
    for c, turns in talks.items():
        path = [k for x in threads[c]["attends"] for k in range(x["first_row"], x["next_row"])]
        shown = "".join(coder.decode(stream[k]["ids"]) for k in path)
        assert shown == "".join("".join(chat_tree.turn_parts(*t)) for t in turns)
        assert threads[c]["n_turns"] == len(turns)


def test_chats_read_back(spark):
    ship_package(spark)
    rows = conversations()
    talks = in_order(rows)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", row int, ids string")
    got = {r["conv_id"]: r for r in chat_tree.read_chats(*chat_tree.format_chats(df)).collect()}
    assert set(got) == set(talks)
    for c, turns in talks.items():
        said = "".join(x for r, x in turns if r == "assistant")
        assert tuple(got[c])[1:] == (len(turns), sha("".join(f"{r}\n{x}\n" for r, x in turns)), len(said), sha(said),
                                     sum(len("".join(chat_tree.turn_parts(*t))) for t in turns))
    none = spark.createDataFrame([], SCHEMA)
    assert chat_tree.read_chats(*chat_tree.format_chats(none)).collect() == []


@pytest.mark.parametrize("text", ["", "\\", "\\\\</turn>", "<turn:user></turn>\n", "<\\turn:", "</tu\\rn>", "a\\\nb", "<<turn:turn:>", "\\### Assistant: </turn> ok", "é😀" * 3])
def test_escape_is_reversible_and_hides_control_strings(text):
    for role in (False, True):
        shown = chat_tree.escape(text, role)
        assert chat_tree.unescape(shown) == text
        assert "</turn>" not in shown and "<turn:" not in shown


def test_control_string_conversation(spark):
    got = {r["conv_id"]: r for r in queries.QUERIES["op12_chat_tree"](spark, DATA).collect()}
    said = "\\### Assistant: </turn> ok"
    assert got[-7]["turns_sha256"] == sha(f"user\n{said}\nassistant\n{said}\n") and got[-7]["loss_sha256"] == sha(said)
    assert got[-7]["loss_chars"] == len(said) and got[-7]["n_turns"] == 2
