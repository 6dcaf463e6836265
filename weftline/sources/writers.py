"""Writers."""

from __future__ import annotations

import logging
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from weftline.operators import export, requests
from weftline.operators.ordering import dense_index, last_per_key
from weftline.session import cut_lineage


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", True).json(path)


def write_titles(exports: DataFrame, text_path: str, json_path: str, order: str = "ord") -> None:
    """The title list as text and as JSON, both in title order."""
    listed = export.titles(exports, order).orderBy(F.lower("title"), order)
    listed.select("title").write.mode("overwrite").text(text_path)
    listed.select("id", "title").write.mode("overwrite").json(json_path)


def _put_files(folder: str, rows: Iterator[Row]) -> None:
    """Write rows sorted by ``file_name``; lines of one file follow each other.

    A file gets its name only when it is complete, so a lost task leaves no half file and
    its repetition writes the same name again.  Attempts of one task write under names of their own.
    """
    import posixpath

    from pyarrow import fs
    from pyspark import TaskContext

    context = TaskContext.get()
    attempt = context.taskAttemptId() if context else 0

    system, base = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
    system.create_dir(base, recursive=True)
    name = stream = None

    def finish() -> None:
        stream.close()
        system.move(posixpath.join(base, f".{name}.{attempt}.part"), posixpath.join(base, name))

    for row in rows:
        if row["file_name"] != name:
            if stream is not None:
                finish()
            name = row["file_name"]
            stream = system.open_output_stream(posixpath.join(base, f".{name}.{attempt}.part"))
        stream.write(row["content"].encode())
    if stream is not None:
        finish()


def write_files(df: DataFrame, folder: str, order: list[str] | None = None) -> None:
    """Named files from (file_name, content) rows; rows of one name are appended in ``order``."""
    placed = df.repartition("file_name").sortWithinPartitions("file_name", *(order or []))
    placed.select("file_name", "content").foreachPartition(lambda rows: _put_files(folder, rows))


def write_markdown(exports: DataFrame, folder: str, order: str = "ord", sanitize: bool = True) -> None:
    """One Markdown file per conversation; of two with one name the later one stays."""
    rendered = export.render(exports, order, sanitize)
    write_files(last_per_key(rendered, "file_name", [order]), folder)


def write_request_shards(rows: DataFrame, task: str, order: list[str], folder: str, base: str,
                         target_mb: int = requests.TARGET_FILE_MB, stamp: int | None = None,
                         job_bytes: int = requests.JOB_MAX_BYTES - requests.JOB_PAD_BYTES) -> requests.ShardPlan:
    """Request files of bounded size, all jobs; refuses a shard over the hard limit before writing.

    The plan that is returned tells the number of jobs; more than one is logged as a warning.
    """
    table = requests.request_table(rows, task, order)
    sizes = cut_lineage(table.select("idx", "bytes"))
    plan = requests.shard_plan(sizes, target_mb, job_bytes)
    requests.check_shards(requests.shard_sizes(requests.assign_shards(sizes, plan)))
    if plan.jobs > 1:
        logging.getLogger(__name__).warning("%d rows need %d jobs of at most %d rows", plan.rows, plan.jobs, plan.max_rows)
    sharded = requests.assign_shards(table, plan)
    lines = sharded.select(requests.shard_names(base, F.col("shard_id"), stamp).alias("file_name"), "idx",
                           F.concat("record", F.lit("\n")).alias("content"))
    write_files(lines, folder, ["idx"])
    return plan


def append_chunks(chunks: DataFrame, path: str, partition: str | None = "user_id") -> None:
    """Append without looking at keys: a second ingest of a document is stored twice."""
    writer = chunks.write.mode("append")
    (writer.partitionBy(partition) if partition else writer).parquet(path)


def append_numbered(spark: SparkSession, rows: DataFrame, order: list[str], path: str) -> None:
    """Append rows with ids that continue after the largest stored one."""
    try:
        last = spark.read.parquet(path).agg(F.max("id")).first()[0]
    except Exception as e:  # first write
        if "PATH_NOT_FOUND" not in str(e):
            raise
        last = None
    start = 0 if last is None else last + 1
    dense_index(rows, order, "id", start).write.mode("append").parquet(path)


def rebuild(df: DataFrame, path: str, partition: str | None = None) -> None:
    """Replace a stored table."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition) if partition else writer).parquet(path)


def write_twice(chunks: DataFrame, first, second) -> None:
    """The same rows to two stores, computed once."""
    chunks.persist()
    try:
        first(chunks)
        second(chunks)
    finally:
        chunks.unpersist()
