"""Session settings and lineage cutting."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # list state of streams needs it; the change log makes a batch write what it changed only
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app: str = "weftline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect; a cluster's own settings win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints and staged tables.

    A cluster names it in ``spark.checkpoint.dir``.  Only a local session may fall back to
    a temporary folder, because there driver and executors share one disk.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if named:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(named)
        return named
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="weftline-ckpt-"))
    return os.path.dirname(sc.getCheckpointDir())


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise reliably, so that a lost executor does not replay the whole history."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_table(df: DataFrame, name: str, where: str | None = None) -> DataFrame:
    """Store a table as Parquet and read it back: as ``where/name``, or in the shared folder until the driver's JVM ends."""
    spark = df.sparkSession
    path = f"{where}/{name}" if where else f"{shared_dir(spark)}/table-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    if not where:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return spark.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per context, so that they need no installation of it."""
    sc = spark.sparkContext
    if getattr(sc, "_weftline_shipped", False):
        return
    root = Path(__file__).resolve().parent
    if not root.is_dir():  # already runs from an archive that was sent
        return
    archive = Path(tempfile.mkdtemp(prefix="weftline-package-")) / "weftline_package.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(archive))
    sc._weftline_shipped = True
