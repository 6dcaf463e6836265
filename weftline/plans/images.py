"""Vectors of 64 numbers read as 8 x 8 images."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.operators import images as I
from weftline.plans import Catalog, Tables

catalog = Catalog()


def pixels(t: Tables):
    return t.embeddings.select(
        F.col("vec_id").alias("img"), F.posexplode(F.col("embedding").cast("array<double>")).alias("i", "value")).select(
        "img", F.lit(0).cast("bigint").alias("c"), F.expr("i div 8").alias("y"),
        F.expr("cast(i % 8 as bigint)").alias("x"), "value")


SQL_PIXELS = """px as (select vec_id as img, i // 8 as y, i % 8 as x, v as value from (
  select vec_id, unnest(range(64)) as i, unnest(embedding::DOUBLE[]) as v from embeddings)),
 pt as (select img, (y // 4) * 2 + x // 4 as patch, list(round(value, 6) order by y, x) as vs from px group by all)"""




@catalog.add("im_01_patches", f"with {SQL_PIXELS} select img, patch::BIGINT as patch, vs[1] as first_value, len(vs)::BIGINT as n, "
             "round(list_sum(list_transform(vs, lambda v, i: v * i)), 6) as checksum from pt")
def _(t):
    p = I.patchify(pixels(t), 4, 8).withColumn("values", F.transform("values", lambda v: F.round(v, 6)))
    weighed = F.aggregate(F.transform("values", lambda v, i: v * (i + 1)), F.lit(0.0), lambda a, x: a + x)
    return p.select("img", "patch", F.col("values")[0].alias("first_value"), F.size("values").cast("bigint").alias("n"),
                    F.round(weighed, 6).alias("checksum"))


@catalog.add("im_02_restored_pixels", f"with {SQL_PIXELS} select img, 0::BIGINT as c, y::BIGINT as y, x::BIGINT as x, value from px")
def _(t):
    return I.unpatchify(I.patchify(pixels(t), 4, 8), 4, 8)


@catalog.add("im_03_shifted_patches", f"""
with {SQL_PIXELS} select a.img, a.patch::BIGINT as patch, a.vs[1] as value, b.vs[1] as next_value
from pt a join pt b on a.img = b.img and b.patch = a.patch + 1""")
def _(t):
    pairs = I.shifted(I.patchify(pixels(t), 4, 8))
    return pairs.select("img", "patch", F.round(F.col("values")[0], 6).alias("value"),
                        F.round(F.col("next_values")[0], 6).alias("next_value"))


@catalog.add("src_16_checkerboards", """
select vec_id as img, 0::BIGINT as c, y, x, ((x + y) % 2)::DOUBLE * embedding[y * 8 + x + 1]::DOUBLE as value
from embeddings, range(8) r1(y), range(8) r2(x)""")
def _(t):
    """Every vector of the table as an image of 8 by 8, seen through a checkerboard."""
    pixels = t.embeddings.select(F.col("vec_id").alias("img"), F.posexplode("embedding").alias("_i", "_v"))
    pixels = pixels.select("img", F.expr("cast(_i div 8 as bigint)").alias("y"), F.expr("cast(_i % 8 as bigint)").alias("x"), "_v")
    board = I.checkerboard(t.spark, 1, 8).drop("img")
    return pixels.join(F.broadcast(board), ["y", "x"]).select("img", "c", "y", "x", (F.col("value") * F.col("_v").cast("double")).alias("value"))
