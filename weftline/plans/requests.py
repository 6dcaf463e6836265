"""Batch requests over documents, responses derived from events."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.operators import requests as R
from weftline.plans import Catalog, Tables
from weftline.session import cut_lineage

catalog = Catalog()
TASK = "Label the text."


def requests(t: Tables):
    return R.request_table(t.documents.select("doc_id", F.col("doc_id").alias("id"), "text"), TASK, ["doc_id"])


SQL_REQUESTS = """
 rq as (select doc_id, 'Label the text.' || chr(10) || chr(10) || 'Input:' || chr(10) || 'id=' || doc_id || ' | ' || text as prompt
   from documents),
 rr as (select doc_id, prompt, '{"recordId":"' || doc_id ||
   '","modelInput":{"anthropic_version":"bedrock-2023-05-31","messages":[{"role":"user","content":[{"type":"text","text":' ||
   to_json(prompt)::VARCHAR || '}]}],"max_tokens":64,"temperature":0.1,"top_p":0.9}}' as record from rq),
 rs as (select doc_id, record, strlen(record) + 1 as bytes, row_number() over (order by doc_id) - 1 as idx from rr),
 mean as (select greatest(1, sum(bytes) // count(*))::BIGINT as mean_bytes from rs where idx < 200),
 pl as (select mean_bytes, greatest(100, 734003200 // mean_bytes)::BIGINT as rows_per_file,
   (5368709120 - 134217728) // mean_bytes as max_rows from mean),
 small as (select mean_bytes, greatest(100, 1048576 // mean_bytes)::BIGINT as rows_per_file from mean)
"""


@catalog.add("br_01_request_records", f"""
with {SQL_REQUESTS} select idx::BIGINT as idx, record, bytes::BIGINT as bytes from rs""")
def _(t):
    return requests(t).select("idx", "record", "bytes")


@catalog.add("br_02_05_shard_plan", f"""
with {SQL_REQUESTS}
select mean_bytes, rows_per_file, max_rows::BIGINT as max_rows, (select count(*) from rs) as rows from pl""")
def _(t):
    p = R.shard_plan(cut_lineage(requests(t).select("idx", "bytes")))
    return t.spark.createDataFrame([(p.mean_bytes, p.rows_per_file, p.max_rows, p.rows)],
                                   "mean_bytes bigint, rows_per_file bigint, max_rows bigint, rows bigint")


@catalog.add("br_06_shard_sizes", f"""
with {SQL_REQUESTS}
select 'label-0-part-' || lpad((idx // rows_per_file)::VARCHAR, 5, '0') || '.jsonl' as file_name,
  sum(bytes)::BIGINT as bytes, count(*) as rows from rs, small group by 1""")
def _(t):
    req = cut_lineage(requests(t).select("idx", "bytes"))
    sizes = R.shard_sizes(R.assign_shards(req, R.shard_plan(req, target_mb=1)))
    R.check_shards(sizes)
    return sizes.select(R.shard_names("label", F.col("shard_id"), 0).alias("file_name"), "bytes", "rows")


@catalog.add("br_05_job_plan", f"""
with {SQL_REQUESTS}, cap as (select greatest(1, 100000 // mean_bytes)::BIGINT as job_rows, rows_per_file from small)
select (idx // job_rows)::BIGINT as job_id, count(*) as rows, sum(bytes)::BIGINT as bytes,
  count(distinct (idx % job_rows) // rows_per_file) as files from rs, cap group by 1""")
def _(t):
    """Every request lands in some job, however many jobs that takes."""
    req = cut_lineage(requests(t).select("idx", "bytes"))
    plan = R.shard_plan(req, target_mb=1, job_bytes=100_000)
    return R.assign_shards(req, plan).groupBy("job_id").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("bytes").alias("bytes"), F.countDistinct("shard_id").alias("files"))


def responses(t: Tables):
    return t.events.select(
        "event_id", F.concat(F.lit("r"), F.col("event_id") % 4000).alias("recordId"),
        F.expr("""named_struct(
            'content', if(event_id % 13 = 0, null, array(
                named_struct('type', 'text', 'text', if(event_id % 3 = 0, concat('  ', props), event_type)),
                named_struct('type', 'note', 'text', cast(null as string)),
                named_struct('type', 'text', 'text', ' '))),
            'usage', if(event_id % 5 = 0, null, named_struct('input_tokens', user_id, 'output_tokens', event_id % 17)))""")
        .alias("modelOutput"))


SQL_RESPONSES = """
 rp as (select event_id, 'r' || (event_id % 4000) as record_id,
   case when event_id % 13 = 0 then '' when event_id % 3 = 0 then props else event_type end as raw,
   case when event_id % 5 = 0 then 0 else user_id end as input_tokens,
   case when event_id % 5 = 0 then 0 else event_id % 17 end as output_tokens from events),
 rk as (select *, case when raw <> '' and json_valid(raw) then (raw::JSON ->> 'k')::BIGINT end as k from rp)
"""


@catalog.add("br_07_parsed_responses", f"""
with {SQL_RESPONSES} select event_id, record_id, raw, k, input_tokens, output_tokens from rk""")
def _(t):
    parsed = R.parse_responses(responses(t))
    return parsed.select("event_id", "record_id", "raw", F.try_variant_get("parsed", "$.k", "bigint").alias("k"),
                         "input_tokens", "output_tokens")


@catalog.add("br_08_first_response", f"""
with {SQL_RESPONSES}
select event_id, record_id, raw, k, input_tokens, output_tokens from rk
qualify row_number() over (partition by record_id order by event_id) = 1""")
def _(t):
    first = R.first_response(R.parse_responses(responses(t)), ["event_id"])
    return first.select("event_id", "record_id", "raw", F.try_variant_get("parsed", "$.k", "bigint").alias("k"),
                        "input_tokens", "output_tokens")


@catalog.add("snk_08_keyed_upsert", """
select user_id, event_type, event_id, value from events
qualify row_number() over (partition by user_id, event_type order by event_id desc) = 1""")
def _(t):
    """Events as successive writes to one key: the newest row per key stays."""
    from weftline.sources.upsert import merge_latest

    events = t.events.select("user_id", "event_type", "event_id", "value")
    half = t.events.agg(F.avg("event_id")).first()[0]
    old, new = events.filter(F.col("event_id") < half), events.filter(F.col("event_id") >= half)
    return merge_latest(old, new, ["user_id", "event_type"], "event_id")
