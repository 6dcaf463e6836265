"""Images as tables: one row per pixel (img, c, y, x, value) or per patch (img, patch, values)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def checkerboard(spark: SparkSession, batch: int, size: int) -> DataFrame:
    """``batch`` one-channel boards with value (x + y) mod 2."""
    area = size * size
    cells = spark.range(batch * area)
    return cells.select(
        F.expr(f"id div {area}").alias("img"), F.lit(0).cast("bigint").alias("c"),
        F.expr(f"id % {area} div {size}").alias("y"), F.expr(f"id % {size}").alias("x"),
    ).withColumn("value", ((F.col("x") + F.col("y")) % 2).cast("double"))


def patchify(pixels: DataFrame, patch: int, width: int) -> DataFrame:
    """Row-major patches; inside a patch values run by channel, row and column."""
    if width % patch:
        raise ValueError("image width must be a multiple of the patch size")
    place = F.expr(f"(y div {patch}) * {width // patch} + x div {patch}")
    value = F.struct("c", "y", "x", "value")
    ordered = F.sort_array(F.collect_list(value))  # channels * patch * patch values
    return pixels.groupBy("img", place.alias("patch")).agg(F.transform(ordered, lambda s: s["value"]).alias("values"))


def unpatchify(patches: DataFrame, patch: int, width: int) -> DataFrame:
    """Pixels from patches."""
    per_row, area = width // patch, patch * patch
    return patches.select("img", "patch", F.posexplode("values").alias("i", "value")).select(
        "img", F.expr(f"cast(i div {area} as bigint)").alias("c"),
        F.expr(f"(patch div {per_row}) * {patch} + (i % {area}) div {patch}").alias("y"),
        F.expr(f"(patch % {per_row}) * {patch} + i % {patch}").alias("x"), "value")


def shifted(patches: DataFrame) -> DataFrame:
    """Each patch but the last with its successor."""
    order = Window.partitionBy("img").orderBy("patch")  # the patches of one image
    return patches.withColumn("next_values", F.lead("values").over(order)).filter("next_values IS NOT NULL")
