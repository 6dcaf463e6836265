"""Continuous ingest: documents to chunks to two stores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from weftline.functions import plugs
from weftline.operators.answers import DEFAULT_USER
from weftline.operators.chunking import chunk_table
from weftline.operators.ordering import last_per_key
from weftline.sources.upsert import upsert

DOCUMENT_SCHEMA = "user_id string, document_id string, text string"
KEYS = ["user_id", "document_chunk"]


def ingest_rows(documents: DataFrame, embedder=None, size: int = 256, overlap: int = 32) -> DataFrame:
    """Valid documents as chunk rows; a document needs an id and a text."""
    valid = documents.filter((F.coalesce("document_id", F.lit("")) != "") & (F.coalesce("text", F.lit("")) != ""))
    chunks = chunk_table(valid.withColumn("user_id", F.coalesce("user_id", F.lit(DEFAULT_USER))), "text", size, overlap)
    return chunks.withColumns({
        "document_chunk": F.concat("document_id", F.lit("#"), F.col("chunk_index").cast("string")),
        "embedding": plugs.embed("chunk_text", embedder)})


def write_batch(batch: DataFrame, batch_id: int, append_path: str, keyed_path: str, embedder=None) -> None:
    """Store one micro-batch in both stores; running it again changes nothing.

    The append store keeps a folder per batch, so a replay replaces its own rows, while a
    document that comes again in a later batch is stored twice, as appending means.
    """
    rows = ingest_rows(batch.withColumn("_seq", F.monotonically_increasing_id()), embedder).withColumn(
        "version", F.lit(batch_id).cast("bigint")).persist()
    try:
        rows.drop("_seq").write.mode("overwrite").parquet(f"{append_path}/batch_id={batch_id}")
        newest = last_per_key(rows, KEYS, ["_seq"]).drop("_seq")
        upsert(batch.sparkSession, keyed_path, newest, KEYS, "version")
    finally:
        rows.unpersist()


def ingest_stream(spark: SparkSession, source: str, append_path: str, keyed_path: str, checkpoint: str,
                  embedder=None, max_files: int = 1000) -> StreamingQuery:
    """Read document files as they arrive, until none is left; start it again for more."""
    documents = (
        spark.readStream.schema(DOCUMENT_SCHEMA).option("maxFilesPerTrigger", max_files).json(source)
    )
    return (
        documents.writeStream
        .foreachBatch(lambda df, i: write_batch(df, i, append_path, keyed_path, embedder))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
