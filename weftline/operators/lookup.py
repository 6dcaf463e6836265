"""Joins against a table that is unique on its key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 << 20
HOT_ROWS = 1_000_000
NULL_SALTS = 64


def _width(name: str, kind: T.DataType) -> Column:
    """Rough bytes of one value, without rendering the row."""
    c = F.col("`" + name.replace("`", "``") + "`")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)).cast("bigint")
    if isinstance(kind, T.ArrayType) and not isinstance(kind.elementType, (T.StringType, T.ArrayType, T.StructType, T.MapType)):
        return F.greatest(F.size(c), F.lit(0)).cast("bigint") * 8
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.length(F.to_json(F.struct(c))), F.lit(0)).cast("bigint")
    return F.lit(8).cast("bigint")


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measured, not estimated: row count and bytes of the side to copy.

    Counting stops one row beyond the bound, so a large side is not read to its end.
    """
    width = sum((_width(f.name, f.dataType) for f in df.schema.fields), F.lit(0).cast("bigint"))
    size = df.select(width.alias("w")).limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.sum("w").alias("b")).first()
    return size["n"] <= max_rows and (size["b"] or 0) <= max_bytes


def lookup_join(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner",
                max_rows: int = BROADCAST_ROWS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Join to a key-unique table: copied to every task while it is small, shuffled beyond.

    In the shuffled form the keys with more than ``hot_rows`` rows of ``big`` are found first, and a
    key is spread over as many salts as it has multiples of that; the key-unique side is
    repeated for those keys alone.  Rows with a null key match nothing and are spread too.  The
    salt is a hash of the row, so a task that runs again deals its rows as before.  ``small`` should
    be cheap to read twice (a stored table), because it is measured first.
    """
    if fits_broadcast(small, max_rows):
        return big.join(F.broadcast(small), on, how)
    hot = big.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_rows)
    # fewer than rows / hot_rows keys
    hot = hot.dropna(subset=on).select(*on, F.ceil(F.col("_n") / hot_rows).cast("int").alias("_salts"))
    hashable = [f.name for f in big.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    row = F.xxhash64(*["`" + c.replace("`", "``") + "`" for c in hashable])
    no_key = F.coalesce(*[F.when(F.col(k).isNull(), F.lit(True)) for k in on], F.lit(False))
    left = big.join(F.broadcast(hot), on, "left").withColumn(
        "_salt", F.pmod(row, F.when(no_key, NULL_SALTS).otherwise(F.coalesce("_salts", F.lit(1)))).cast("int")).drop("_salts")
    right = small.join(F.broadcast(hot), on, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts")
    return left.join(right, [*on, "_salt"], how).drop("_salt")
