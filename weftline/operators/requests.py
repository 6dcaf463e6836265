"""Batch-inference files: request records, size-bounded shards, response parsing."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions import text as X
from weftline.operators.ordering import dense_index, first_per_key

MIB, GIB = 1 << 20, 1 << 30

# Request parameters and file limits.
API_VERSION = "bedrock-2023-05-31"
MAX_TOKENS, TEMPERATURE, TOP_P = 64, 0.1, 0.9
MAX_FILE_BYTES = GIB
FILE_PAD_BYTES = 16 * MIB
TARGET_FILE_MB = 700
JOB_MAX_BYTES = 5 * GIB
JOB_PAD_BYTES = 128 * MIB
MIN_ROWS_PER_FILE = 100
SAMPLE_ROWS = 200

RESPONSE_SCHEMA = """
    recordId string,
    modelOutput struct<content: array<struct<type: string, text: string>>,
                       usage: struct<input_tokens: bigint, output_tokens: bigint>>
"""


def prompt(task: str, record_id: Column, text: Column) -> Column:
    return F.concat(F.lit(f"{task}\n\nInput:\nid="), record_id.cast("string"), F.lit(" | "), text)


def request_record(task: str, record_id: Column | str = "id", text: Column | str = "text") -> Column:
    """One request as JSON text."""
    rid, body = X.col(record_id), X.col(text)
    block = F.struct(F.lit("text").alias("type"), prompt(task, rid, body).alias("text"))
    message = F.struct(F.lit("user").alias("role"), F.array(block).alias("content"))
    model_input = F.struct(
        F.lit(API_VERSION).alias("anthropic_version"), F.array(message).alias("messages"),
        F.lit(MAX_TOKENS).alias("max_tokens"), F.lit(TEMPERATURE).alias("temperature"), F.lit(TOP_P).alias("top_p"))
    return F.to_json(F.struct(rid.cast("string").alias("recordId"), model_input.alias("modelInput")))


@dataclass(frozen=True)
class ShardPlan:
    """How many rows go in a file and how many a job may hold."""

    mean_bytes: int
    rows_per_file: int
    max_rows: int
    rows: int

    @property
    def jobs(self) -> int:
        return -(-self.rows // self.max_rows)

    @property
    def files_per_job(self) -> int:
        return -(-self.max_rows // self.rows_per_file)


def request_table(rows: DataFrame, task: str, order: list[str]) -> DataFrame:
    """Requests numbered in order, with their size in UTF-8 bytes including the line break."""
    # only the keys are sorted and materialised; the texts are shuffled once, to meet their number
    numbers = dense_index(rows.select(*order), order)
    return rows.select(*dict.fromkeys([*order, "id", "text"])).join(numbers, order).withColumn("record", request_record(task)).withColumn(
        "bytes", (F.octet_length("record") + 1).cast("bigint"))


def shard_plan(requests: DataFrame, target_mb: int = TARGET_FILE_MB, job_bytes: int = JOB_MAX_BYTES - JOB_PAD_BYTES) -> ShardPlan:
    """Mean record size over the first rows decides the file size; empty input is an error.

    Only ``idx`` and ``bytes`` are read; pass them stored, so that the records are not built again.
    """
    head = requests.filter(F.col("idx") < SAMPLE_ROWS).agg(
        F.sum("bytes").alias("s"), F.count(F.lit(1)).alias("n")).first()
    if not head["n"]:
        raise ValueError("no rows to write")
    mean = max(1, head["s"] // head["n"])
    target = min(MAX_FILE_BYTES - FILE_PAD_BYTES, target_mb * MIB)
    return ShardPlan(mean, max(MIN_ROWS_PER_FILE, target // mean), max(1, job_bytes // mean),
                     requests.count())


def assign_shards(requests: DataFrame, plan: ShardPlan, first_job_only: bool = False) -> DataFrame:
    """Rows with ``job_id`` and ``shard_id``; a job holds ``max_rows`` rows, and no file spans two jobs.

    ``first_job_only`` keeps one job; ``plan.rows - plan.max_rows`` rows are then left for later.
    """
    rows = requests.filter(F.col("idx") < plan.max_rows) if first_job_only else requests
    return rows.withColumn("job_id", F.expr(f"idx div {plan.max_rows}")).withColumn(
        "shard_id", F.expr(f"job_id * {plan.files_per_job} + (idx % {plan.max_rows}) div {plan.rows_per_file}"))


def shard_sizes(sharded: DataFrame) -> DataFrame:
    return sharded.groupBy("shard_id").agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("rows"))


def check_shards(sizes: DataFrame, limit: int = MAX_FILE_BYTES) -> None:
    """Refuse a plan with a file at or over the hard limit."""
    over = sizes.filter(F.col("bytes") >= limit).orderBy("shard_id").limit(1).collect()
    if over:
        raise ValueError(f"shard {over[0]['shard_id']} holds {over[0]['bytes']} bytes, limit {limit}")


def shard_names(base: str, shard_id: Column, stamp: int | None = None) -> Column:
    stamp = int(time.time()) if stamp is None else stamp
    return F.format_string(f"{base}-{stamp}-part-%05d.jsonl", shard_id)


def parse_responses(responses: DataFrame) -> DataFrame:
    """Answer text, parsed object and token counts per response."""
    content = F.coalesce(F.col("modelOutput.content"), F.array().cast("array<struct<type: string, text: string>>"))
    texts = F.transform(content, lambda b: F.coalesce(b["text"], F.lit("")))
    raw = X.strip(F.array_join(texts, ""))
    others = [c for c in responses.columns if c not in ("recordId", "modelOutput")]
    return responses.select(
        *others, F.col("recordId").alias("record_id"), raw.alias("raw"),
        F.coalesce(F.try_parse_json(raw), F.parse_json(F.lit("{}"))).alias("parsed"),
        F.coalesce("modelOutput.usage.input_tokens", F.lit(0)).alias("input_tokens"),
        F.coalesce("modelOutput.usage.output_tokens", F.lit(0)).alias("output_tokens"))


def first_response(parsed: DataFrame, order: list[str]) -> DataFrame:
    """First response per record.  Variants cannot be compared, so they travel as JSON text."""
    as_text = parsed.withColumn("parsed", F.to_json("parsed"))
    return first_per_key(as_text, "record_id", order).withColumn("parsed", F.parse_json("parsed"))
