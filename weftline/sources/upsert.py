"""Keyed upsert into parquet tables partitioned by tenant."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.operators.ordering import last_per_key
from weftline.session import shared_dir

LISTED_TENANTS = 1_000  # beyond, tenants are matched by a join


def merge_latest(existing: DataFrame, incoming: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Newest row per key of both tables; ``version`` orders the writes."""
    return last_per_key(existing.unionByName(incoming, allowMissingColumns=True), keys, [version])


def upsert(spark: SparkSession, path: str, incoming: DataFrame, keys: list[str], version: str,
           partition: str = "user_id") -> None:
    """Rewrite only the tenants that occur in ``incoming``.

    Columns that only the stored table or only the batch has are kept and null elsewhere.  The
    merged rows are staged in the shared folder first, because a job must not overwrite
    what it is still reading; the swap then replaces whole partitions, and only after that the staged copy goes.
    If the swap fails the merged rows stay where the error says, and :func:`finish_swap` replaces the partitions again.
    """
    try:
        existing = spark.read.option("mergeSchema", True).parquet(path)
    except Exception as e:  # first write: no table yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        existing = None
    if existing is None:
        merged = last_per_key(incoming, keys, [version])
    else:
        # a folder value is read back as a guessed type, so it gets the batch's type again
        existing = existing.withColumn(partition, F.col(partition).cast(incoming.schema[partition].dataType))
        merged = merge_latest(_of_tenants(existing, incoming, partition), incoming, keys, version)
    staged_at = f"{shared_dir(spark)}/weftline-staged/{uuid.uuid4().hex}"
    merged.write.parquet(staged_at)
    finish_swap(spark, staged_at, path, partition)


class SwapFailed(RuntimeError):
    """The swap ended half way; ``staged_at`` holds all merged rows of the tenants it was to replace."""

    def __init__(self, staged_at: str, path: str):
        super().__init__(f"partitions of {path} were not all replaced; the merged rows are kept in {staged_at}")
        self.staged_at, self.path = staged_at, path


def finish_swap(spark: SparkSession, staged_at: str, path: str, partition: str = "user_id") -> None:
    """Replace the partitions of the staged rows, then drop the staged copy; may be repeated after a failure."""
    staged = spark.read.parquet(staged_at)
    try:
        _replace(staged, path, partition)
    except Exception as e:
        raise SwapFailed(staged_at, path) from e
    where = spark._jvm.org.apache.hadoop.fs.Path(staged_at)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def _replace(staged: DataFrame, path: str, partition: str) -> None:
    # partitions of a tenant are cut by size, so a big tenant becomes several files
    staged.hint("rebalance", partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def _of_tenants(stored: DataFrame, incoming: DataFrame, partition: str) -> DataFrame:
    """Stored rows of the tenants in ``incoming``: other folders are not read while the list is short."""
    touched = incoming.select(partition).distinct()
    some = [r[0] for r in touched.limit(LISTED_TENANTS + 1).collect()]
    if len(some) <= LISTED_TENANTS and None not in some:
        return stored.filter(F.col(partition).isin(some))
    return stored.join(touched, stored[partition].eqNullSafe(touched[partition]), "left_semi")
