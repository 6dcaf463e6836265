"""Running sums inside groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weftline.llm.groups import stage
from weftline.operators.lookup import lookup_join

_SLOT_MASK = (1 << 33) - 1  # monotonically_increasing_id keeps the row number in the low 33 bits


def running(df: DataFrame, group: list[str], order: list[Column], values: list[str]) -> DataFrame:
    """Add ``before_<v>`` (sum of the earlier rows of the group) and ``all_<v>`` (sum of the group) for each column ``v``.

    ``group`` columns must not be null.  Rows with equal group and order may change places, so ``order``
    should identify a row or leave only rows that are alike.  The table is laid out in ranges and stored
    once; a window never holds more of a group than one range, and a group has one row of sums per range.
    An empty table stays empty.
    """
    order = [*[F.col(g) for g in group], *order]
    placed = stage(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({
        "_part": F.spark_partition_id(), "_slot": F.monotonically_increasing_id().bitwiseAND(F.lit(_SLOT_MASK))}), "ranges")
    within = Window.partitionBy(*group, "_part").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    sums = placed.groupBy(*group, "_part").agg(*[F.sum(v).alias(f"_s{k}") for k, v in enumerate(values)])
    sums = stage(sums.select(
        *group, "_part", *[F.coalesce(F.sum(f"_s{k}").over(earlier), F.lit(0)).alias(f"_b{k}") for k, _ in enumerate(values)],
        *[F.sum(f"_s{k}").over(whole).alias(f"all_{v}") for k, v in enumerate(values)]), "range-sums")
    local = placed.withColumns({f"_l{k}": F.coalesce(F.sum(v).over(within), F.lit(0)) for k, v in enumerate(values)})
    return lookup_join(local, sums, [*group, "_part"]).select(
        *df.columns, *[(F.col(f"_b{k}") + F.col(f"_l{k}")).alias(f"before_{v}") for k, v in enumerate(values)],
        *[f"all_{v}" for v in values])
