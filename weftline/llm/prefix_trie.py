"""Tries of turn sequences, built and summed in depth bands.

A chain is the numbered turn sequence of one conversation.  Its turns are kept in bands of at most ``HEIGHT``
turns, so a row never holds more than a band, and whole bands are the items of the next round.  Rounds are the
logarithm of the longest chain to the base ``HEIGHT``.  Chains and turns only travel as numbers and digests.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.groups import stage

HEIGHT = 32
#: stands for a null id inside a trie
NO_ID = -(1 << 63)


def _band(i: Column, height: int) -> Column:
    return F.floor(i / height).cast("bigint")


def _spread(blocks: DataFrame, chain: str = "chain") -> DataFrame:
    return blocks.select(chain, F.inline("run"))


def chain_scan(items: DataFrame, combine: Callable[[Column, Column], Column], most: int, height: int = HEIGHT) -> DataFrame:
    """Running ``combine`` along each chain: ``(chain, i, load, before, after)`` from ``items(chain, i, v, load)``.

    ``i`` counts from 0 without gaps and is at most ``most``; ``before`` is the ``after`` of ``i - 1`` (null at 0).  The
    value at the end of a whole band is the value that the next round gives for it, so ``combine`` may also be a
    digest, whose result depends on how the steps are put together: equal beginnings have equal values in one run.
    """
    kind = items.schema["v"].dataType

    def step(state: Column, x: Column) -> Column:
        return F.when(state.isNull(), x).otherwise(combine(state, x).cast(kind))

    blocks = items.groupBy("chain", _band(F.col("i"), height).alias("band")).agg(
        F.array_sort(F.collect_list(F.struct("i", "v", "load"))).alias("run"))
    pre, whole = F.lit(None).cast(kind), F.lit(None).cast(kind)
    if most >= height:
        blocks = stage(blocks, "bands")
        vs = F.transform("run", lambda x: x["v"])
        total = F.aggregate(F.slice(vs, 2, height), F.element_at(vs, 1), lambda a, x: combine(a, x).cast(kind))
        above = blocks.filter((F.size("run") == height) | (F.col("band") > 0)).select(
            "chain", F.col("band").alias("i"), total.alias("v"), F.lit(None).cast("int").alias("load"))
        above = chain_scan(above, combine, most // height, height).select(
            "chain", F.col("i").alias("band"), F.col("before").alias("pre"), F.col("after").alias("whole"))
        blocks, pre, whole = blocks.join(above, ["chain", "band"], "left"), F.col("pre"), F.col("whole")
    states = F.aggregate("run", F.array(pre), lambda acc, x: F.concat(acc, F.array(step(F.element_at(acc, -1), x["v"]).cast(kind))))
    rows = blocks.select("chain", states.alias("states"), whole.alias("whole"), F.posexplode("run").alias("k", "x"))
    after = F.get("states", F.col("k") + 1)
    ends = (F.col("k") == height - 1) & F.col("whole").isNotNull()
    return rows.select("chain", "x.i", "x.load", F.get("states", F.col("k")).alias("before"), F.when(ends, F.col("whole")).otherwise(after).alias("after"))


def walks(turns: DataFrame, most: int, height: int = HEIGHT) -> DataFrame:
    """Node of every place of every chain: ``(chain, i, load, parent, key)`` from ``turns(chain, i, digest, load)``.

    ``key`` is a 128-bit name of the turns 0..i; ``parent`` is the key of the turns before (null at 0).
    """
    items = turns.select("chain", "i", F.col("digest").alias("v"), "load")
    found = chain_scan(items, lambda a, x: F.unhex(F.md5(F.concat(a, x))), most, height)
    return found.select("chain", "i", "load", F.col("before").alias("parent"), F.col("after").alias("key"))


def subtree_sums(paths: DataFrame, nodes: DataFrame, values: list[str], most: int, height: int = HEIGHT) -> DataFrame:
    """``(key, *values)`` with each value summed over the node and all below it.

    ``nodes(key, chain, i, *values)`` names for each node one chain that runs through it, and ``paths(chain, i, key)``
    has the places of those chains.  A node adds to its ancestors inside its band only; the nodes one chain stands
    for are summed before they are sent, so a band sends at most ``height`` rows per chain.  The totals of band roots
    are the same problem, ``height`` times less deep; once complete, each goes to the one band above its root.
    """
    spots = paths.groupBy("chain", _band(F.col("i"), height).alias("band")).agg(
        F.array_sort(F.collect_list(F.struct("i", "key"))).alias("run"))
    if most >= height:
        spots = stage(spots, "spots")
    own = nodes.groupBy("chain", _band(F.col("i"), height).alias("band")).agg(F.collect_list(F.struct("i", *values)).alias("own"))

    def onward(x: Column, name: str) -> Column:
        return F.aggregate(F.filter("own", lambda o: o["i"] >= x["i"]), F.lit(0).cast("bigint"), lambda s, o: s + o[name]).alias(name)

    sums = F.transform("run", lambda x: F.struct(x["key"].alias("key"), *[onward(x, v) for v in values]))
    near = _summed(spots.join(own, ["chain", "band"]).select(F.inline(sums)), values)
    if most < height:
        return near
    near = stage(near, "near")
    tops = stage(nodes.filter(F.col("i") % height == 0).select("key", "chain", _band(F.col("i"), height).alias("i")).join(near, "key"), "tops")
    upper = spots.select("chain", F.col("band").alias("i"), F.col("run")[0]["key"].alias("key"))
    full = subtree_sums(upper, tops, values, most // height, height)
    below = tops.filter(F.col("i") > 0).select("key", "chain", (F.col("i") - 1).alias("band")).join(full, "key")
    passed = below.drop("key").join(spots, ["chain", "band"]).select(
        F.explode("run.key").alias("key"), *values)
    return _summed(near.unionByName(passed), values)


def _summed(rows: DataFrame, values: list[str]) -> DataFrame:
    return rows.groupBy("key").agg(*[F.sum(v).alias(v) for v in values])


def turn_digest(role: Column, text: Column) -> Column:
    """128-bit name of a turn."""
    return F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
