"""Order-dependent building blocks that never gather all rows in one task.

A window without ``partitionBy`` would send the whole table to a single task.  Everything
here range-partitions on a unique key instead, numbers the rows inside each partition and
adds the offset of the partition, which is a table of one row per partition.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weftline.session import cut_lineage

_SLOT_MASK = (1 << 33) - 1  # monotonically_increasing_id keeps the row number in the low 33 bits


def _cols(keys: Sequence[Column | str] | Column | str) -> list[Column]:
    if isinstance(keys, (str, Column)):
        keys = [keys]
    return [F.col(k) if isinstance(k, str) else k for k in keys]


def _placed(df: DataFrame, order) -> DataFrame:
    """Rows laid out in total order, with partition number and slot, materialised once.

    Both later passes (offsets and rows) must see one layout, hence the checkpoint.
    """
    order = _cols(order)
    return cut_lineage(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_slot", F.monotonically_increasing_id().bitwiseAND(F.lit(_SLOT_MASK)))
    )


def dense_index(df: DataFrame, order, name: str = "idx", start: int = 0) -> DataFrame:
    """Add 0..n-1 (plus ``start``) in the given order; ``order`` must identify a row."""
    placed = _placed(df, order)
    per_part = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: the only place where an unpartitioned window is used
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")
    )
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, (F.col("_base") + F.col("_slot") + F.lit(start)).cast("bigint"))
        .drop("_part", "_slot", "_base")
    )


def running_total(df: DataFrame, order, value: str, name: str = "running") -> DataFrame:
    """Add the inclusive running sum of ``value`` in the given (unique) order."""
    placed = _placed(df, order)
    per_part = placed.groupBy("_part").agg(F.sum(value).alias("_s"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select(
        "_part", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_base")
    )
    inside = Window.partitionBy("_part").orderBy("_slot").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        placed.withColumn("_local", F.sum(value).over(inside))
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_base") + F.col("_local"))
        .drop("_part", "_slot", "_base", "_local")
    )


def first_per_key(df: DataFrame, keys, order) -> DataFrame:
    """Whole first row per key; an aggregate, so each task combines before the shuffle."""
    return _edge_per_key(df, keys, order, F.min_by)


def last_per_key(df: DataFrame, keys, order) -> DataFrame:
    """Whole last row per key (see :func:`first_per_key`)."""
    return _edge_per_key(df, keys, order, F.max_by)


def _edge_per_key(df: DataFrame, keys, order, pick) -> DataFrame:
    keys, order = _cols(keys), _cols(order)
    row = F.struct(*[F.col(c) for c in df.columns])
    grouped = df.groupBy(*[k.alias(f"_k{i}") for i, k in enumerate(keys)])
    return grouped.agg(pick(row, F.struct(*order)).alias("_row")).select("_row.*")


def seeded_hash(seed: int | str, *keys: Column | str) -> Column:
    """Repeatable pseudo-random order: md5 of ``seed:key[:key...]``."""
    parts = [c.cast("string") for c in _cols(keys)]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))


def smallest_by_hash(df: DataFrame, seed, keys, n: int) -> DataFrame:
    """At most ``n`` rows by seeded order (a top-n, each task keeps n rows at most)."""
    keys = _cols(keys)
    return df.orderBy(seeded_hash(seed, *keys), *keys).limit(n)


def flag_first_by_hash(df: DataFrame, seed, keys, n: int | Callable[[int], int], name: str = "taken") -> DataFrame:
    """Flag exactly the first ``n`` rows in seeded order, without sorting the table; ``n`` may depend on the row count.

    Only keys and hashes are stored and looked at: the leading hash digits form a histogram, whole bars
    below the cut are in, and only the bar holding the cut is ranked.  The bar count follows the row
    count, so that bar stays small.  Keys may repeat or be null: of the rows that share the key at the cut some are in, so that
    the number is met.  The result is a comparison with the cut, so ``df`` itself
    runs once for the keys and once for the rows.
    """
    keys = _cols(keys)
    h = seeded_hash(seed, *keys)
    narrow = cut_lineage(df.select(F.struct(h.alias("_h"), *[k.alias(f"_k{i}") for i, k in enumerate(keys)]).alias("_s")))
    total = narrow.count()
    n = n(total) if callable(n) else n
    digits = max(1, min(8, math.ceil(math.log(max(total, 2) / 50_000, 16)) if total > 50_000 else 1))
    marked = narrow.withColumn("_bar", F.substring("_s._h", 1, digits))
    bars = marked.groupBy("_bar").agg(F.count(F.lit(1)).alias("_n"))
    totals = running_total(bars, "_bar", "_n", "_upto")
    cut = (
        totals.filter((F.col("_upto") - F.col("_n") < n) & (F.col("_upto") >= n))
        .select(F.col("_bar").alias("_cut"), (F.lit(n) - (F.col("_upto") - F.col("_n"))).alias("_room"))
        .first()
    )
    if cut is None:  # n is 0, or not smaller than the table
        return df.withColumn(name, F.lit(n > 0))
    last = marked.filter(F.col("_bar") == cut["_cut"]).select("_s").orderBy("_s").limit(cut["_room"])
    bound = last.agg(F.max("_s").alias("_s")).first()["_s"]
    kind = narrow.schema["_s"].dataType
    own, edge = F.struct(h, *keys).cast(kind), F.struct(*[F.lit(v) for v in bound]).cast(kind)
    room, tied = last.filter(F.col("_s") == edge).count(), narrow.filter(F.col("_s") == edge).count()
    if room == tied:
        return df.withColumn(name, own <= edge)
    # rows that share the key at the cut: any of them will do, but exactly as many as there is room for
    ties = cut_lineage(df.filter(own == edge).withColumns({
        "_tie_part": F.spark_partition_id(), "_tie_slot": F.monotonically_increasing_id().bitwiseAND(F.lit(_SLOT_MASK))}))
    sizes = running_total(ties.groupBy("_tie_part").agg(F.count(F.lit(1)).alias("_n")), "_tie_part", "_n", "_upto")  # one row per partition
    at = sizes.filter(F.col("_upto") >= room).orderBy("_tie_part").select("_tie_part", (F.lit(room) - F.col("_upto") + F.col("_n")).alias("_left")).first()
    among = (F.col("_tie_part") < at["_tie_part"]) | ((F.col("_tie_part") == at["_tie_part"]) & (F.col("_tie_slot") < at["_left"]))
    return df.filter(own != edge).withColumn(name, own < edge).unionByName(ties.withColumn(name, among).drop("_tie_part", "_tie_slot"))


def order_statistics(df: DataFrame, column: str, ranks: dict[str, int]) -> dict[str, object]:
    """Exact values at 0-based ranks (nulls ignored).

    Equal values are combined first, so the running total covers distinct values only.
    """
    counts = (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    upto = running_total(counts, "_v", "_n", "_upto")
    picks = [
        F.min(F.when(F.col("_upto") > r, F.col("_v"))).alias(name) for name, r in ranks.items()
    ]
    return upto.agg(*picks).first().asDict()


def linear_quantiles(df: DataFrame, column: str, probs: dict[str, float]) -> dict[str, float | None]:
    """Exact linearly interpolated quantiles."""
    n = df.filter(F.col(column).isNotNull()).count()
    if n == 0:
        return dict.fromkeys(probs)
    ranks, spots = {}, {}
    for name, p in probs.items():
        pos = (n - 1) * p
        lo = math.floor(pos)
        spots[name] = pos - lo
        ranks[f"{name}_lo"], ranks[f"{name}_hi"] = lo, min(lo + 1, n - 1)
    found = order_statistics(df, column, ranks)
    return {
        name: float(found[f"{name}_lo"])
        + (float(found[f"{name}_hi"]) - float(found[f"{name}_lo"])) * frac
        for name, frac in spots.items()
    }


def positional_join(left: DataFrame, left_order, right: DataFrame, right_order) -> DataFrame:
    """Match rows by their place in each order; the shorter side is padded with nulls."""
    a = dense_index(left, left_order, "idx")
    b = dense_index(right, right_order, "idx")
    return a.join(b, "idx", "full_outer")
