"""Merkle manifest of a table: leaves, roots and inclusion proofs in SQL functions.

A level of the tree is kept as hex text, one string for each aligned block of 512 nodes.  Parents are
digests of fixed-width substrings, the siblings of a node are the substrings beside it, and the block tops
are the nodes of the next round.  A block holds three levels, so the rounds are log512 of the largest group,
and nothing wider than a block comes together in one task, whatever a group's share of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.groups import stage
from weftline.llm.running import running
from weftline.llm.words import column
from weftline.operators.lookup import lookup_join

HEX = 64
FAN = 8
STEPS = 3
BLOCK = FAN ** STEPS
_PATH = "array<struct<left:string,right:string>>"


def digest(values: list[Column]) -> Column:
    """SHA-256 of the joined fields: ``-`` for null, else byte count, ``:`` and the value."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def fold(leaf: Column, path: Column) -> Column:
    """Root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda node, side: F.sha2(F.concat(side["left"], node, side["right"]), 256))


def proof_digest(path: Column) -> Column:
    """SHA-256 of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def _parents(level: Column) -> Column:
    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(level), F.lit(FAN * HEX)),
                                    lambda at: F.sha2(F.substring(level, at, FAN * HEX), 256)), "")


def _ascend(nodes: DataFrame, most: int) -> tuple[list[DataFrame], DataFrame]:
    """Stored blocks of every round, and ``(tree, top)`` of each tree.

    ``nodes(tree, n, pos, digest, load)`` has ``n`` nodes in its tree, numbered from 0; ``most`` is the largest ``n``.
    """
    rounds, tops = [], None
    while True:
        made = nodes.groupBy("tree", "n", F.floor(F.col("pos") / BLOCK).alias("block")).agg(
            F.array_sort(F.collect_list(F.struct("pos", "digest", "load"))).alias("items"))
        made = made.withColumn("level0", F.array_join(F.transform("items", lambda x: x["digest"]), ""))
        for k in range(STEPS):  # a node alone in its tree is the top; alone in its run it still has a parent
            made = made.withColumn(f"level{k + 1}", F.when((F.col("n") > BLOCK) | (F.col("n") > FAN ** k), _parents(F.col(f"level{k}"))))
        made = stage(made.withColumn("top", F.coalesce(*[F.col(f"level{k}") for k in range(STEPS, -1, -1)])), "merkle")
        rounds.append(made)
        done = made.filter(F.col("n") <= BLOCK).select("tree", "top")
        tops = done if tops is None else tops.union(done)
        if most <= BLOCK:
            return rounds, tops
        most = -(-most // BLOCK)
        nodes = made.filter(F.col("n") > BLOCK).select(
            "tree", F.ceil(F.col("n") / BLOCK).alias("n"), F.col("block").alias("pos"), F.col("top").alias("digest"), F.lit(None).cast("int").alias("load"))


def _side(k: int) -> Column:
    """Siblings at level ``k`` of the item at place ``at`` of its block, null above the top."""
    level = F.substring(f"level{k}", F.floor(F.col("at") / FAN ** (k + 1)).cast("int") * (FAN * HEX) + 1, F.lit(FAN * HEX))
    own = F.floor(F.col("at") / FAN ** k).cast("int") % FAN
    side = F.struct(F.substring(level, F.lit(1), own * HEX).alias("left"), F.substring(level, (own + 1) * HEX + 1, F.lit(FAN * HEX)).alias("right"))
    return F.when(F.col(f"level{k + 1}").isNotNull(), side)


def _descend(rounds: list[DataFrame], trees: DataFrame) -> DataFrame:
    """Nodes of the first round with their ``path`` up to the top of ``trees(tree, above, known)``."""
    trees, higher = stage(trees, "merkle-trees"), None
    for made in reversed(rounds):
        found = lookup_join(made.filter(F.col("n") <= BLOCK), trees, ["tree"])
        if higher is not None:
            found = found.unionByName(lookup_join(made.filter(F.col("n") > BLOCK), stage(higher, "merkle-paths"), ["tree", "block"]))
        nodes = found.select("*", F.posexplode("items").alias("at", "item"))
        sides = F.filter(F.array(*[_side(k) for k in range(STEPS)]), lambda s: s.isNotNull())
        nodes = nodes.select("tree", "known", F.col("item.pos").alias("pos"), F.col("item.digest").alias("digest"), F.col("item.load").alias("load"),
                             F.concat(sides, F.col("above")).cast(_PATH).alias("path"))
        higher = nodes.select("tree", F.col("pos").alias("block"), F.col("path").alias("above"), "known")
    return nodes


def manifest(docs: DataFrame, fields: list[str], by: str, key: str, extra: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: ``key``, ``leaf``, ``subroot``, ``root``, ``path`` and the ``extra`` columns.

    Leaves are digests of ``fields``.  For each value of ``by`` (null is a group of its own, the first one) they ascend by
    ``key``, null keys first; rows with one key stand in the order of their leaves, so repeated rows are leaves
    side by side.  Eight consecutive nodes have a parent, fewer at a level's end as well, until one node is left.
    Group roots, in bytewise order of ``by``, form the last tree the same way.  ``path`` holds the siblings as
    ``left`` and ``right`` hex strings from the leaf's level to the root's (see :func:`fold`).  An empty table gives none.
    Columns that are not named travel nowhere, so their names cannot clash.
    """
    group = column(by).cast("string")
    load = F.struct(column(key).alias("key"), *[c.alias(f"x{k}") for k, c in enumerate((extra or {}).values())])
    rows = stage(docs.select(F.coalesce(F.concat(F.lit("="), group), F.lit("-")).alias("tree"), load.alias("load"),
                       digest([column(f) for f in fields]).alias("digest"), F.lit(1).cast("bigint").alias("one")), "leaves")
    nodes = running(rows, ["tree"], [F.col("load.key"), F.col("digest")], ["one"]).select(
        "tree", F.col("all_one").alias("n"), F.col("before_one").alias("pos"), "digest", "load")
    rounds, tops = _ascend(nodes, _most(rows.groupBy("tree").count()))
    numbered = running(tops.select(F.lit("").alias("forest"), "tree", "top", F.lit(1).cast("bigint").alias("one")), ["forest"], [F.col("tree")], ["one"])
    upper = stage(numbered.select(F.col("forest").alias("tree"), F.col("all_one").alias("n"), F.col("before_one").alias("pos"),
                                  F.col("top").alias("digest"), F.col("tree").alias("load")), "merkle-forest")
    upper_rounds, roots = _ascend(upper, _most(upper.groupBy("tree").count()))
    trees = _descend(upper_rounds, roots.select("tree", F.array().cast(_PATH).alias("above"), F.col("top").alias("known")))
    trees = trees.select(F.col("load").alias("tree"), F.col("path").alias("above"), F.struct(F.col("digest").alias("subroot"), F.col("known").alias("root")).alias("known"))
    done = _descend(rounds, trees)
    return done.select(F.col("load.key").alias(key), F.col("digest").alias("leaf"), "known.subroot", "known.root", "path",
                       *[F.col(f"load.x{k}").alias(name) for k, name in enumerate(extra or {})])


def _most(counts: DataFrame) -> int:
    return counts.agg(F.max("count")).first()[0] or 0
