"""Registered queries over the driver tables, each with its reference SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from weftline.session import ship_package
from weftline.sources.readers import parquet_table

TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


HEAVY = ("documents", "conversations", "pages")  # work per row is large


class Tables:
    """Attribute access to the parquet tables of one data directory."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLE_NAMES:
            raise AttributeError(name)
        where = f"{self.path}/{name}.parquet"
        return parquet_table(self.spark, where) if name in HEAVY else self.spark.read.parquet(where)


class Catalog:
    """Collects queries and their reference SQL under one key."""

    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def add(self, key: str, sql: str | None = None):
        def keep(fn: Callable[[Tables], DataFrame]):
            def query(spark: SparkSession, path: str) -> DataFrame:
                ship_package(spark)
                return fn(Tables(spark, path))

            self.queries[key] = query
            if sql is not None:
                self.sql[key] = sql
            return fn

        return keep


def everything() -> Catalog:
    """All plan modules merged."""
    from weftline.plans import (
        chat, images, model_outputs, requests, retrieval, tabular, text, threads, training,
    )

    merged = Catalog()
    for module in (retrieval, chat, threads, training, requests, text, model_outputs, tabular, images):
        merged.queries.update(module.catalog.queries)
        merged.sql.update(module.catalog.sql)
    return merged
