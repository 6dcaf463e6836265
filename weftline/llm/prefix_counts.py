"""Prefix trie of rebuilt conversations with totals per node."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.groups import stage
from weftline.llm.prefix_trie import HEIGHT, NO_ID, subtree_sums, turn_digest, walks
from weftline.llm.running import running
from weftline.operators.lookup import lookup_join

HEADS = 6  # heads have 0 to 5 turns
SPAN = 100  # a conversation takes its head from the multiple of this at or below its id
PIECE_BITS = 12


def numbered_turns(talks: DataFrame) -> DataFrame:
    """``(chain, i, n, digest, chars)``: turns in order, null first; equal turn numbers stand in the order of their digests.

    Null roles and texts count as empty.  Rows without ``conv_id`` form one conversation, named ``NO_ID``.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = talks.select(F.coalesce(F.col("conv_id").cast("bigint"), F.lit(NO_ID)).alias("chain"), "turn", turn_digest(role, text).alias("digest"),
                        F.char_length(text).cast("bigint").alias("chars"), F.lit(1).cast("bigint").alias("one"))
    return running(stage(rows, "turns"), ["chain"], [F.col("turn"), F.col("digest")], ["one"]).select(
        "chain", F.col("before_one").alias("i"), F.col("all_one").alias("n"), "digest", "chars")


def rebuilt_turns(turns: DataFrame) -> DataFrame:
    """Every conversation with the head of its base: ``(chain, i, digest, load)``, place 0 being the textless root.

    The first ``h`` turns come from the conversation ``id - id % 100`` (as many as it has, none if there is no such one),
    then the own turns after the first ``h``; ``h`` is the CRC-32 of the decimal id modulo 6, and 0 without an id.  ``load`` has
    the code points of the turn and whether it is the last one.
    """
    h = F.when(F.col("chain") == NO_ID, 0).otherwise(F.crc32(F.col("chain").cast("string")) % HEADS).cast("bigint")
    base = F.when(F.col("chain") != NO_ID, F.col("chain") - F.col("chain") % SPAN)
    heads = turns.filter((F.col("i") < HEADS - 1) & (F.col("chain") % SPAN == 0)).groupBy(F.col("chain").alias("base")).agg(
        F.array_sort(F.collect_list(F.struct("i", "digest", "chars"))).alias("head"))
    talks = turns.filter("i = 0").select("chain", "n", h.alias("h"), base.alias("base")).join(heads, "base", "left")
    talks = stage(talks.select(
        "chain", "h", F.slice(F.coalesce("head", F.array().cast(heads.schema["head"].dataType)), F.lit(1), F.col("h").cast("int")).alias("head"),
        F.greatest(F.lit(0), F.col("n") - F.col("h")).alias("rest")), "talks")
    last = F.size("head") + F.col("rest")
    root = F.struct(F.lit(0).cast("bigint").alias("i"), F.unhex(F.md5(F.lit("root"))).alias("digest"), F.lit(0).cast("bigint").alias("chars"))
    first = talks.select("chain", last.alias("last"), F.inline(F.concat(F.array(root), F.transform(
        "head", lambda x: F.struct((x["i"] + 1).alias("i"), x["digest"].alias("digest"), x["chars"].alias("chars"))))))
    own = lookup_join(turns, talks.select("chain", "h", F.size("head").alias("taken"), last.alias("last")), ["chain"])
    own = own.filter(F.col("i") >= F.col("h")).select("chain", "last", (F.col("i") - F.col("h") + F.col("taken") + 1).alias("i"), "digest", "chars")
    return first.unionByName(own).select("chain", "i", "digest", F.struct("chars", (F.col("i") == F.col("last")).alias("ends")).alias("load"))


def id_digests(ends: DataFrame) -> DataFrame:
    """``(key, ends_sha256)``: SHA-256 of each node's ids in decimal, ascending and joined by commas.

    A piece holds the ids of one block of 4,096 numbers, so it is bounded; the pieces of a node then pass a
    hash one after another, and only that hash is kept.  A missing id is written as nothing.
    """
    shown = F.transform(F.array_sort(F.collect_list("chain")), lambda c: F.when(c == NO_ID, "").otherwise(c.cast("string")))
    pieces = ends.groupBy("key", F.shiftright("chain", PIECE_BITS).alias("block")).agg(F.array_join(shown, ",").alias("ids"))
    dealt = pieces.repartition("key").sortWithinPartitions("key", "block").select("key", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            keys, out = [], []
            for k, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if k != key:
                    if state is not None:
                        keys.append(key)
                        out.append(state.hexdigest())
                    key, state = k, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(out, pa.string())], ["key", "ends_sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()], pa.string())], ["key", "ends_sha256"])

    return dealt.mapInArrow(run, "key binary, ends_sha256 string")


def prefix_trie(turns: DataFrame, height: int = HEIGHT) -> DataFrame:
    """One row per node of the trie over ``turns`` (see :func:`rebuilt_turns`).

    Columns: ``conv_id`` (smallest member, null for the conversation without id), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``.  An empty table has no node.
    """
    turns = stage(turns, "rebuilt")
    most = turns.agg(F.max("i")).first()[0] or 0
    walk = stage(walks(turns, most, height), "walks")
    nodes = stage(walk.groupBy("key", "parent", "i", F.col("load.chars").alias("chars")).agg(
        F.min("chain").alias("chain"), F.count(F.lit(1)).alias("n_convs")), "nodes")
    children = nodes.filter("parent is not null").groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    known = stage(nodes.join(children, "key", "left").fillna(0, ["n_children"]).withColumns({
        "n_leaves": (F.col("n_children") == 0).cast("bigint"), "saved_tokens": (F.col("n_convs") - 1) * F.col("chars")}), "known")
    sums = subtree_sums(walk.select("chain", "i", "key"), known.select("key", "chain", "i", "n_leaves", "saved_tokens"),
                        ["n_leaves", "saved_tokens"], most, height)
    done = known.drop("n_leaves", "saved_tokens").join(sums, "key").join(
        id_digests(walk.filter("load.ends").select("key", "chain")), "key", "left")
    parents = known.filter("n_children > 0").select(F.col("key").alias("parent"), F.col("chain").alias("above"))
    shown = lookup_join(done, parents, ["parent"], "left")
    return shown.select(
        _id("chain").alias("conv_id"), F.col("i").alias("depth"), _id("above").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def _id(name: str):
    return F.when(F.col(name) != NO_ID, F.col(name))
