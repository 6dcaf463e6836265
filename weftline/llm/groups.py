"""Groups that are too large for one task, staged tables, and connected components."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.session import cut_lineage, shared_dir


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back; it goes when the driver's JVM ends.

    Unlike a checkpoint it is columnar and compressed, so later passes read only the columns they use.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/staged-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path)


def with_cells(df: DataFrame, size: Column, key: Column, cap: int) -> DataFrame:
    """Add the cell (``cell_a``, ``cell_b``), ``block`` and ``blocks`` so that every two rows of a group meet in exactly one cell.

    A group of ``size`` rows is dealt by a hash of ``key`` into blocks of about ``cap`` rows.
    A cell holds two blocks (or one, for pairs inside a block), hence at most about twice
    ``cap`` rows.  Groups within the cap have one cell.
    """
    blocks = F.greatest(F.lit(1), F.ceil(size / F.lit(cap))).cast("int")
    df = df.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64(key), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return df.withColumn("other", other).withColumns({
        "cell_a": F.least("block", "other"), "cell_b": F.greatest("block", "other")}).drop("other")


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str], decode: Callable[[pa.RecordBatch], list[np.ndarray]]
                  ) -> Iterator[tuple[tuple, list[np.ndarray]]]:
    """(key, columns) of each group of a stream that is sorted by ``keys``.

    ``decode`` makes arrays of a whole batch at once, and groups are slices of them, so that many small
    groups cost little; only a group across batches is put together.
    """
    key, parts = None, []

    def joined() -> list[np.ndarray]:
        return parts[0] if len(parts) == 1 else [np.concatenate(c) for c in zip(*parts)]

    for batch in batches:
        if not batch.num_rows:
            continue
        columns = decode(batch)
        values = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(batch.num_rows - 1, bool)
        for v in values:
            new |= v[1:] != v[:-1]
        edges = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
        for begin, end in zip(edges, edges[1:]):
            here = tuple(v[begin] for v in values)
            if parts and here != key:
                yield key, joined()
                parts = []
            key = here
            parts.append([c[begin:end] for c in columns])
    if parts:
        yield key, joined()


class Forest:
    """Union-find over 0..n-1; the smallest member is the root."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def union(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        if a < b:
            self.up[b] = a
        elif b < a:
            self.up[a] = b

    def add_matrix(self, linked: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> None:
        """Union ``rows[i]`` with ``cols[j]`` where ``linked[i, j]``."""
        for i in np.flatnonzero(linked.any(1)):
            a = int(rows[i])
            hits = cols[linked[i]]
            for j in hits[self.up[hits] != self.root(a)]:
                self.union(a, int(j))

    def roots(self) -> np.ndarray:
        up = self.up
        while True:
            nxt = up[up]
            if (nxt == up).all():
                return nxt
            up = nxt


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(src, dst)``: rows ``(node, component)``, the smallest node names it.

    Each round takes the smallest label among a node's neighbours and then follows the
    label of that label, so paths shorten by powers of two.  Only numbers move; a hub is a
    hot key of one join only, where its other side is a single row.  Null ends are ignored.
    Empty edges give an empty table.
    """
    both = edges.filter("src is not null and dst is not null and src <> dst").select("src", "dst")
    both = cut_lineage(both.union(both.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct())
    labels = cut_lineage(both.groupBy(F.col("src").alias("node")).agg(F.least(F.min("src"), F.min("dst")).alias("component")))
    while True:
        heard = both.join(labels, both.src == labels.node).groupBy(F.col("dst").alias("node")).agg(F.min("component").alias("least"))
        own = labels.join(heard, "node").select(
            "node", F.col("component").alias("was"), F.least("component", "least").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("component").alias("further"))
        nxt = cut_lineage(own.join(jump, "low").select(
            "node", "was", F.least("low", "further").alias("component")))
        if nxt.filter("was <> component").isEmpty():
            return nxt.select("node", "component")
        labels = nxt.select("node", "component")
