"""Tabular preparation: splits, labels, scaling, positions, moving averages, joins."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weftline.functions import text as X
from weftline.operators.lookup import lookup_join
from weftline.operators.ordering import (
    dense_index, first_per_key, flag_first_by_hash, linear_quantiles, running_total, smallest_by_hash,
)


def split_by_null(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """(rows with a value, rows without)."""
    return df.filter(F.col(column).isNotNull()), df.filter(F.col(column).isNull())


def exact_sample(df: DataFrame, keys: list[str], n: int, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows by seeded order; fewer rows are an error."""
    found = df.limit(n).count()
    if found < n:
        raise ValueError(f"asked for {n} rows, table has {found}")
    return smallest_by_hash(df, seed, keys, n)


def exact_split(df: DataFrame, keys: list[str], test_size: float, seed: int = 42, name: str = "is_test") -> DataFrame:
    """Flag exactly ceil(n * test_size) rows."""
    return flag_first_by_hash(df, seed, keys, lambda n: math.ceil(n * test_size), name)


def low_score_label(score: Column) -> Column:
    return (score < 3).cast("int")


def clipped_label(score: Column, low: int = 0, high: int = 4) -> Column:
    return F.greatest(F.least(score - 1, F.lit(high)), F.lit(low))


def yes_no(value: Column) -> Column:
    return F.when(value == "Y", 1).when(value == "N", 0)


def named_prices(df: DataFrame, name: str, price: str) -> DataFrame:
    """Rows with a name; the price as a number."""
    return df.filter(F.col(name).isNotNull()).withColumn(price, F.col(price).cast("double"))


@dataclass(frozen=True)
class Scaling:
    """Division by the interquartile range, then min-max to [-1, 1]; zero ranges count as one."""

    iqr: float
    low: float
    high: float

    def apply(self, x: Column) -> Column:
        return (x / self.iqr - self.low) / self.span * 2 - 1

    def invert(self, y: Column) -> Column:
        return ((y + 1) / 2 * self.span + self.low) * self.iqr

    @property
    def span(self) -> float:
        return (self.high - self.low) or 1.0


def fit_scaling(df: DataFrame, column: str) -> Scaling:
    """Exact quartiles and range: three numbers reach the driver."""
    q = linear_quantiles(df, column, {"q25": 0.25, "q75": 0.75})
    iqr = (q["q75"] - q["q25"]) or 1.0
    edge = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi")).first()
    return Scaling(iqr, edge["lo"] / iqr, edge["hi"] / iqr)


def credit_score(probability: Column) -> Column:
    """-350 * logit(p - 0.5), rounded half to even; null where the logit does not exist."""
    x = probability - 0.5
    return F.bround(F.when((x > 0) & (x < 1), -350 * F.ln(x / (1 - x))), 0)


def first_seen_ids(df: DataFrame, column: str, order: list[str], name: str = "category_id") -> DataFrame:
    """Dense id per value by first appearance, joined back to the rows."""
    first = first_per_key(df.select(column, *order), column, order)
    ids = dense_index(first, order, name).select(column, name)
    return lookup_join(df, ids, [column])


def moving_average(df: DataFrame, group: str, order: list[str], value: str, width: int = 3,
                   name: str = "smooth") -> DataFrame:
    """Mean over ``width`` consecutive rows of a group, full windows only.

    Groups shorter than ``width`` keep their values.  Each row is added to the windows it
    belongs to, by global position, so a group of any size is spread over all tasks.
    """
    keys = [group, *order]
    placed = dense_index(df.select(*keys, value), keys, "_at")
    parts = placed.withColumn("_end", F.explode(F.sequence(F.col("_at"), F.col("_at") + width - 1)))
    windows = parts.groupBy(group, "_end").agg(
        F.count(F.lit(1)).alias("_n"), F.sum(value).alias("_s"), F.max_by(F.struct(*order), "_at").alias("_o"))
    full = windows.filter(F.col("_n") == width).select(group, "_o.*", (F.col("_s") / width).alias(name))
    short = df.groupBy(group).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") < width).select(group)
    kept = lookup_join(df, short, [group], "left_semi").select(*keys, F.col(value).cast("double").alias(name))
    return full.unionByName(kept)


def offsets(df: DataFrame, order: list[str], length: str) -> DataFrame:
    """Add ``start`` and ``end`` of each row on the common axis of all lengths."""
    total = running_total(df, order, length, "end")
    return total.withColumn("start", F.col("end") - F.col(length))


def locate(points: DataFrame, point: str, spans: DataFrame, bucket: int = 4096) -> DataFrame:
    """Find the span [start, end) of each point, and the place inside it.

    A range join by equal buckets: a span is listed once in every bucket it touches, so
    neither side is compared with all of the other.
    """
    touched = F.sequence(F.expr(f"start div {bucket}"), F.expr(f"(end - 1) div {bucket}"))
    listed = spans.filter("end > start").withColumn("_b", F.explode(touched))
    asked = points.withColumn("_b", F.expr(f"`{point}` div {bucket}"))
    inside = (F.col(point) >= F.col("start")) & (F.col(point) < F.col("end"))
    return asked.join(listed, "_b").filter(inside).withColumn("place", F.col(point) - F.col("start")).drop("_b")


def prefix_scores(docs: DataFrame, keys: list[str], text_col: str, lexicon: dict[str, float]) -> DataFrame:
    """Score of every word prefix (the result has a row per word): mean weight of the lexicon words so far, 0 before the first.

    Running sums over the words of one text replace the prefixes themselves.
    """
    spark = docs.sparkSession
    table = spark.createDataFrame([(k, float(v)) for k, v in lexicon.items()], "_w string, _x double")
    words = docs.select(*keys, F.posexplode(X.split_words(F.lower(text_col))).alias("_p", "_w"))
    weighed = lookup_join(words, table, ["_w"], "left")
    so_far = Window.partitionBy(*keys).orderBy("_p").rowsBetween(Window.unboundedPreceding, 0)
    return weighed.select(*keys, (F.col("_p") + 1).alias("n_words"),
                          F.coalesce(F.avg("_x").over(so_far), F.lit(0.0)).alias("score"))


def join_with_suffixes(left: DataFrame, right: DataFrame, key: str, suffixes: tuple[str, str]) -> DataFrame:
    """Inner join on ``key``; columns of both sides get a suffix."""
    shared = set(left.columns) & set(right.columns) - {key}
    a = left.select(key, *[F.col(c).alias(c + suffixes[0] if c in shared else c) for c in left.columns if c != key])
    b = right.select(key, *[F.col(c).alias(c + suffixes[1] if c in shared else c) for c in right.columns if c != key])
    return a.join(b, key)
