"""Classification, ranking and regression metrics as aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.operators.ordering import running_total


def rmse_mae(df: DataFrame, actual: str, predicted: str, digits: int = 2) -> DataFrame:
    gap = F.col(actual) - F.col(predicted)
    return df.agg(F.round(F.sqrt(F.avg(gap * gap)), digits).alias("rmse"), F.round(F.avg(F.abs(gap)), digits).alias("mae"))


def _ratio(a: Column, b: Column, empty: float) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(empty))


def binary_metrics(df: DataFrame, label: str, predicted: str, empty: float = 1.0) -> DataFrame:
    """Accuracy, precision, recall and F1 of class 1; 0/0 counts as ``empty``."""
    y, p = F.col(label) == 1, F.col(predicted) == 1
    counts = df.agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"), F.count_if(y & ~p).alias("fn"),
                    F.count_if(~y & ~p).alias("tn"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select(
        "tp", "fp", "fn", "tn",
        _ratio(tp + tn, tp + fp + fn + tn, empty).alias("accuracy"),
        _ratio(tp, tp + fp, empty).alias("precision"), _ratio(tp, tp + fn, empty).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn, empty).alias("f1"))


def class_report(df: DataFrame, label: str, predicted: str, empty: float = 0.0) -> DataFrame:
    """Precision, recall, F1 and support per class.

    One aggregate over (label, predicted) pairs; the rest works on that small matrix.
    """
    pairs = df.groupBy(F.col(label).alias("y"), F.col(predicted).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    sides = pairs.select(F.explode(F.array(
        F.struct(F.col("y").alias("class"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("claimed"),
                 F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0).alias("hit")),
        F.struct(F.col("p").alias("class"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("claimed"),
                 F.lit(0).cast("bigint").alias("hit")))).alias("s")).select("s.*")
    per = sides.groupBy("class").agg(F.sum("support").alias("support"), F.sum("claimed").alias("claimed"),
                                     F.sum("hit").alias("hit"))
    hit, claimed, support = F.col("hit"), F.col("claimed"), F.col("support")
    return per.select("class", _ratio(hit, claimed, empty).alias("precision"), _ratio(hit, support, empty).alias("recall"),
                      _ratio(2 * hit, claimed + support, empty).alias("f1"), "support")


def weighted_metrics(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Accuracy and support-weighted precision, recall, F1."""
    report = class_report(df, label, predicted)
    n = F.sum("support")

    def mean(c: str) -> Column:
        return (F.sum(F.col(c) * F.col("support")) / n).alias(c)

    accuracy = (F.sum(F.col("recall") * F.col("support")) / n).alias("accuracy")
    return report.agg(accuracy, mean("precision"), mean("recall"), mean("f1"))


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the ROC curve with half credit for ties, and the Gini coefficient."""
    levels = df.groupBy(F.col(score).alias("s")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))
    below = running_total(levels, "s", "neg", "upto")
    won = F.sum(F.col("pos") * (F.col("upto") - F.col("neg") + F.col("neg") / 2))
    total = below.agg(won.alias("won"), F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    auc = F.try_divide(F.col("won"), (F.col("p") * F.col("n")).cast("double"))
    return total.select(auc.alias("auc"), (2 * auc - 1).alias("gini"))


def confusion_shares(df: DataFrame, label: str, predicted: str, classes: list) -> DataFrame:
    """Share of all rows per (label, predicted) cell, predicted classes as columns."""
    n = df.count()
    counts = df.groupBy(label).pivot(predicted, classes).count().na.fill(0)
    return counts.select(label, *[(F.col(f"`{c}`") / n).alias(f"predicted_{c}") for c in classes])


def approval_rates(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Approval rate on both sides and share of rows approved by both."""
    y, p = F.col(label), F.col(predicted)
    return df.agg(F.avg(y).alias("actual_rate"), F.avg(p).alias("predicted_rate"),
                  F.avg(((y == 1) & (p == 1)).cast("double")).alias("matched_rate"))


def value_shares(df: DataFrame, column: str) -> DataFrame:
    n = df.count()
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).withColumn("share", F.col("n") / n)
