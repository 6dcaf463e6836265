"""Chunking, embedding, vector arithmetic and nearest neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.functions import plugs
from weftline.functions import text as X
from weftline.functions import vectors as V
from weftline.operators import answers, chunking, neighbours, pruned_search
from weftline.operators.lookup import lookup_join
from weftline.operators.ordering import first_per_key
from weftline.plans import Catalog, Tables
from weftline.session import cut_lineage
from weftline.sources.readers import spread

catalog = Catalog()

DIMS = plugs.HASH_DIMS
EMB = "embedding::DOUBLE[]"


def sql_tokens(expr: str, sep: str = "[,.:;?_!\"()'']|--|\\s") -> str:
    return (f"list_filter(string_split(regexp_replace({expr}, '({sep})', chr(1) || '\\1' || chr(1), 'g'), chr(1)), "
            "lambda t: regexp_matches(t, '\\S'))")


def sql_embedding_steps(source: str, text: str, name: str) -> str:
    """CTEs that add the unit hash embedding ``v`` of ``text`` to the rows of ``source``."""
    slots = f"list_transform({sql_tokens(f'lower({text})')}, lambda w: ('0x' || md5(w)[1:4])::INT % {DIMS})"
    counts = f"list_transform(range({DIMS}), lambda i: len(list_filter(slots, lambda s: s = i))::DOUBLE)"
    norm = "greatest(sqrt(list_sum(list_transform(raw, lambda y: y * y))), 1e-9)"
    return f"""
 {name}_s as materialized (select *, {slots} as slots from {source}),
 {name}_r as materialized (select * exclude (slots), {counts} as raw from {name}_s),
 {name}_n as materialized (select *, {norm} as norm from {name}_r),
 {name} as materialized (select * exclude (raw, norm), list_transform(raw, lambda x: x / norm) as v from {name}_n)"""



SQL_CHUNKS = """
  select doc_id, i // 224 as chunk_index, substr(text, (i + 1)::BIGINT, 256) as chunk_text
  from (select doc_id, text, unnest(range(0, length(text), 224)) as i from documents)
"""

SQL_LINES = """
  select doc_id, unnest(range(len(parts))) as line_no, unnest(parts) as line from (
    select doc_id, string_split(case when text like '%' || chr(10) then text[1:-2] else text end, chr(10)) as parts
    from documents where text <> '')
"""


def tenants(t: Tables) -> DataFrame:
    """The vectors as a tenant-keyed chunk table."""
    return t.embeddings.select(
        F.col("label").alias("user_id"),
        F.concat(F.lit("doc#"), F.col("vec_id")).alias("document_chunk"), "vec_id", "embedding")


def tenant_questions(t: Tables) -> DataFrame:
    """One question per tenant: its first vector."""
    first = first_per_key(t.embeddings.select("label", "vec_id", "embedding"), "label", ["vec_id"])
    return first.select(F.col("label").alias("question"), F.col("label").alias("user_id"), "embedding")


SQL_TENANT_SCORES = f"""
  q as (select label as question, arg_min({EMB}, vec_id) as qv from embeddings group by label),
  s as (select question, 'doc#' || vec_id as document_chunk, {EMB} as v, qv
        from embeddings join q on label = question)
"""


@catalog.add("src_06_document_lines", f"select doc_id, line_no::BIGINT as line_no, line from ({SQL_LINES})")
def _(t):
    return chunking.lines(t.documents, ["doc_id"]).withColumn("line_no", F.col("line_no").cast("bigint"))


@catalog.add("src_10_parquet_scan", """
  select doc_id, lang, source, n_chars from documents where n_chars > 1000""")
def _(t):
    return t.documents.select("doc_id", "lang", "source", "n_chars").filter("n_chars > 1000")


@catalog.add("src_13_vector_table_count", "select count(*) as n, count(distinct label) as tenants from embeddings")
def _(t):
    return t.embeddings.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("label").alias("tenants"))


@catalog.add("src_14_tenant_scan", """
  select label::BIGINT as user_id, 'doc#' || vec_id as document_chunk from embeddings where label = 3""")
def _(t):
    return tenants(t).filter("user_id = 3").select(F.col("user_id").cast("bigint").alias("user_id"), "document_chunk")


@catalog.add("vr_01_fixed_chunks", f"""
  select doc_id, chunk_index::BIGINT as chunk_index, chunk_text from ({SQL_CHUNKS})""")
def _(t):
    chunks = chunking.chunk_table(t.documents.select("doc_id", "text"))
    return chunks.withColumn("chunk_index", F.col("chunk_index").cast("bigint"))


@catalog.add("ud_08_chunk_table_function", f"""
  select doc_id, chunk_index::BIGINT as chunk_index, length(chunk_text)::BIGINT as n from ({SQL_CHUNKS})""")
def _(t):
    from weftline.functions.registry import register

    register(t.spark)
    t.documents.select("doc_id", "text").createOrReplaceTempView("weft_docs")
    return t.spark.sql("""
        SELECT doc_id, CAST(c.chunk_index AS BIGINT) AS chunk_index, CAST(length(c.chunk_text) AS BIGINT) AS n
        FROM weft_docs, LATERAL weft_chunks(text) AS c""")


SQL_PACK = """
with recursive p as (
  select doc_id, row_number() over (partition by doc_id order by i) as i, piece from (
    select doc_id, unnest(range(len(ps))) as i, unnest(ps) as piece
    from (select doc_id, string_split(text, {sep}) as ps from documents)) where piece <> ''),
w as (
  select doc_id, i, 0 as chunk_no, length(piece) as used, piece from p where i = 1
  union all
  select p.doc_id, p.i, case when w.used + {n} + length(p.piece) <= 1000 then w.chunk_no else w.chunk_no + 1 end,
    case when w.used + {n} + length(p.piece) <= 1000 then w.used + {n} + length(p.piece) else length(p.piece) end,
    p.piece
  from w join p on p.doc_id = w.doc_id and p.i = w.i + 1)
select doc_id, chunk_no::BIGINT as chunk_no,
  regexp_replace(string_agg(piece, {sep} order by i), '^\\s+|\\s+$', '', 'g') as chunk from w group by doc_id, chunk_no
"""


@catalog.add("vr_02_separator_chunks", SQL_PACK.format(sep="chr(10)", n=1))
def _(t):
    # the tables hold single line breaks only, so the line is the separator here
    chunks = chunking.separator_chunks("text", "\n", 1000)
    return t.documents.select("doc_id", F.posexplode(chunks).alias("chunk_no", "chunk")).withColumn(
        "chunk_no", F.col("chunk_no").cast("bigint"))


@catalog.add("vr_03_indexed_chunks", f"""
  select 'doc-' || (row_number() over (order by doc_id, chunk_index) - 1) as id, chunk_text as document,
    doc_id::VARCHAR as file_path, chunk_index::BIGINT as chunk from ({SQL_CHUNKS})""")
def _(t):
    return chunking.indexed_chunks(t.documents.select("doc_id", "text"), "doc_id").select(
        "id", "document", "metadata.file_path", "metadata.chunk")


@catalog.add("vr_04_checked_lines", f"""
with l as (select doc_id, line_no, regexp_replace(line, '^\\s+|\\s+$', '', 'g') as text from ({SQL_LINES})),
r as (select *, case when text = '' then 'Line cannot be empty.'
        when len(list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '')) < 2
          then 'Line must contain at least two words.' end as reason from l)
select doc_id, line_no::BIGINT as line_no, text, reason,
  case when reason is null then
    (row_number() over (partition by reason is null order by doc_id, line_no) - 1)::BIGINT end as line_id from r""")
def _(t):
    checked = chunking.checked_lines(t.documents, ["doc_id"])
    return checked.withColumn("line_no", F.col("line_no").cast("bigint"))


SQL_EMBEDDED = f"""
 c as (select doc_id, chunk_index, chunk_text from ({SQL_CHUNKS})),{sql_embedding_steps('c', 'chunk_text', 'e')}
"""


@catalog.add("vr_05_hash_embedding", f"""
with {SQL_EMBEDDED}
select doc_id, chunk_index::BIGINT as chunk_index, unnest(range({DIMS}))::BIGINT as dim, round(unnest(v), 6) as value
from e""")
def _(t):
    chunks = chunking.chunk_table(t.documents.select("doc_id", "text"))
    return chunks.select("doc_id", F.col("chunk_index").cast("bigint").alias("chunk_index"),
                         F.posexplode(plugs.embed("chunk_text")).alias("dim", "value")).select(
        "doc_id", "chunk_index", F.col("dim").cast("bigint").alias("dim"), F.round("value", 6).alias("value"))


@catalog.add("ud_01_plugged_embedder", r"""
select doc_id, [length(text)::DOUBLE, len(regexp_extract_all(text, '[\x09-\x0D\x1C-\x20\x{85}\x{A0}]'))::DOUBLE,
  len(regexp_extract_all(text, '\p{Lu}'))::DOUBLE] as embedding from documents""")
def _(t):
    """An embedder loaded once per worker; here a stand-in that counts character classes."""
    def factory():
        def run(texts):
            return [[float(len(x)), float(sum(ch.isspace() for ch in x)), float(sum(ch.isupper() for ch in x))]
                    for x in texts]
        return run

    return t.documents.select("doc_id", plugs.embed("text", factory).alias("embedding"))


SQL_PLACES = f"select vec_id, label, unnest(range(64)) as dim, unnest({EMB}) as x from embeddings"


@catalog.add("vr_06_masked_mean_pooling", f"""
select label::BIGINT as doc, dim::BIGINT as dim,
  round(sum(x * m) / greatest(sum(m), 1e-9), 6) as value
from (select *, case when vec_id % 3 = 0 then 0.0::DOUBLE else 1.0::DOUBLE end as m from ({SQL_PLACES}))
group by all""")
def _(t):
    tokens = t.embeddings.select(F.col("label").cast("bigint").alias("doc"),
                                 F.when(F.col("vec_id") % 3 == 0, 0.0).otherwise(1.0).alias("mask"), "embedding")
    return pool_masked(tokens).withColumn("value", F.round("value", 6))


def pool_masked(tokens: DataFrame) -> DataFrame:
    places = tokens.select("doc", "mask", F.posexplode(V.as_double("embedding")).alias("dim", "x"))
    return places.groupBy("doc", F.col("dim").cast("bigint").alias("dim")).agg(
        (F.sum(F.col("x") * F.col("mask")) / F.greatest(F.sum("mask"), F.lit(1e-9))).alias("value"))


@catalog.add("vr_07_mean_first_last_pooling", f"""
select label::BIGINT as doc, dim::BIGINT as dim, round(avg(x), 6) as mean_value,
  round(arg_min(x, vec_id), 6) as first_value, round(arg_max(x, vec_id), 6) as last_value
from ({SQL_PLACES}) group by all""")
def _(t):
    places = t.embeddings.select(F.col("label").cast("bigint").alias("doc"), "vec_id",
                                 F.posexplode(V.as_double("embedding")).alias("dim", "x"))
    return places.groupBy("doc", F.col("dim").cast("bigint").alias("dim")).agg(
        F.round(F.avg("x"), 6).alias("mean_value"),
        F.round(F.min_by("x", "vec_id"), 6).alias("first_value"),
        F.round(F.max_by("x", "vec_id"), 6).alias("last_value"))


@catalog.add("vr_08_unit_vectors", f"""
with a as (select vec_id, list_transform({EMB}, lambda x: x * (vec_id % 7)) as raw from embeddings),
b as (select *, greatest(sqrt(list_sum(list_transform(raw, lambda y: y * y))), 1e-9) as norm from a)
select vec_id, unnest(range(64))::BIGINT as dim, round(unnest(raw) / norm, 6) as value from b""")
def _(t):
    scaled = t.embeddings.withColumn("v", F.transform(V.as_double("embedding"), lambda x: x * (F.col("vec_id") % 7)))
    return scaled.select("vec_id", F.posexplode(V.unit("v")).alias("dim", "x")).select(
        "vec_id", F.col("dim").cast("bigint").alias("dim"), F.round("x", 6).alias("value"))


@catalog.add("vr_09_11_pair_metrics", f"""
with {SQL_TENANT_SCORES}
select question::BIGINT as question, document_chunk, round(list_cosine_similarity(v, qv), 6) as cosine,
  round(1 - list_cosine_similarity(v, qv), 6) as cosine_distance, round(list_distance(v, qv), 6) as l2,
  round(list_sum(list_transform(list_zip(v, qv), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), 6) as squared_l2
from s""")
def _(t):
    pairs = lookup_join(tenants(t), tenant_questions(t).withColumnRenamed("embedding", "qv"), ["user_id"])
    return pairs.select(
        F.col("question").cast("bigint").alias("question"), "document_chunk",
        F.round(V.cosine("embedding", "qv"), 6).alias("cosine"),
        F.round(V.cosine_distance("embedding", "qv"), 6).alias("cosine_distance"),
        F.round(V.l2("embedding", "qv"), 6).alias("l2"),
        F.round(V.squared_l2("embedding", "qv"), 6).alias("squared_l2"))


def ranked_sql(score: str, direction: str, k: int, digits: int, first_round: bool) -> str:
    inner = f"round({score}, {digits})" if first_round else score
    return f"""
with {SQL_TENANT_SCORES},
r as (select question, document_chunk, {inner} as score from s),
n as (select *, row_number() over (partition by question order by score {direction}, document_chunk) as rank from r)
select question::BIGINT as question, rank::BIGINT as rank, document_chunk as key, round(score, {digits}) as score
from n where rank <= {k}"""


def tenant_topk(t: Tables, metric: str, k: int, digits: int, first: bool) -> DataFrame:
    found = neighbours.knn_join(tenants(t), tenant_questions(t), k, metric=metric, scope="user_id",
                                key_col="document_chunk", round_first=digits if first else None)
    return found.select(F.col("question").cast("bigint").alias("question"), "rank", "key",
                        F.round("score", digits).alias("score"))


@catalog.add("vr_12_tenant_topk_rounded", ranked_sql("list_cosine_similarity(v, qv)", "desc", 5, 4, True))
def _(t):
    return tenant_topk(t, "cosine", 5, 4, True)


@catalog.add("vr_13_tenant_topk_raw", ranked_sql("list_cosine_similarity(v, qv)", "desc", 5, 4, False))
def _(t):
    return tenant_topk(t, "cosine", 5, 4, False)


@catalog.add("vr_14_tenant_topk_l2", ranked_sql("list_distance(v, qv)", "asc", 3, 6, False))
def _(t):
    return tenant_topk(t, "l2", 3, 6, False)


@catalog.add("vr_14_nearest_context", ranked_sql("list_distance(v, qv)", "asc", 1, 6, False))
def _(t):
    return tenant_topk(t, "l2", 1, 6, False)


def keyed(t: Tables) -> tuple[DataFrame, DataFrame]:
    e = t.embeddings
    return (e.select(F.col("vec_id").alias("key"), "label", "embedding"),
            e.select(F.col("vec_id").alias("question"), "embedding"))


SQL_BATCH_KNN = f"""
with s as (select a.vec_id as question, b.vec_id as key,
    list_cosine_similarity(a.{EMB}, b.{EMB}) as score from embeddings a, embeddings b),
n as (select *, row_number() over (partition by question order by score desc, key) as rank from s)
select question, rank::BIGINT as rank, key, round(score, 6) as score from n where rank <= 5"""


@catalog.add("vr_15_batch_knn", SQL_BATCH_KNN)
def _(t):
    corpus, questions = keyed(t)
    return neighbours.knn_join(spread(corpus), questions, 5).withColumn("score", F.round("score", 6))


@catalog.add("vr_15_pruned_knn", SQL_BATCH_KNN)
def _(t):
    corpus, questions = keyed(t)
    answer = pruned_search.pruned_knn(pruned_search.store_lists(corpus), questions, 5)
    return answer.result.withColumn("score", F.round("score", 6))


SQL_LISTS = f"""
 m as (select label, dim, avg(x) as x from ({SQL_PLACES}) group by label, dim),
 c as (select label as list_id, list(x order by dim) as cv from m group by label),
 near as (select vec_id, {EMB} as v, list_id,
     row_number() over (partition by vec_id order by list_cosine_similarity({EMB}, cv) desc, list_id) as r,
     list_cosine_similarity({EMB}, cv) as sim from embeddings, c),
 ivf as (select vec_id, v, list_id from near where r = 1)
"""


def lists(t: Tables) -> DataFrame:
    means = neighbours.mean_vectors(t.embeddings, "label")
    return means.select(F.col("label").alias("list_id"), "centroid")


@catalog.add("vr_16_inverted_file_search", f"""
with {SQL_LISTS},
s as (select q.vec_id as question, i.vec_id as key, list_cosine_similarity(q.v, i.v) as score
      from near q join ivf i on i.list_id = q.list_id where q.r <= 2),
n as (select *, row_number() over (partition by question order by score desc, key) as rank from s)
select question, rank::BIGINT as rank, key, round(score, 6) as score from n where rank <= 5""")
def _(t):
    corpus, questions = keyed(t)
    centroids = lists(t)
    ivf = neighbours.build_inverted_file(spread(corpus), centroids)
    return neighbours.ivf_search(ivf, centroids, questions, 5, nprobe=2).withColumn("score", F.round("score", 6))


@catalog.add("vr_16_learned_lists")
def _(t):
    """Lists learned by k-means; model-dependent, so rows only."""
    corpus, questions = keyed(t)
    centroids = neighbours.kmeans_centroids(corpus, 10)
    ivf = neighbours.build_inverted_file(spread(corpus), centroids)
    return neighbours.ivf_search(ivf, centroids, questions, 5, nprobe=3)


@catalog.add("vr_17_backend_comparison", f"""
with {SQL_LISTS},
x as (select a.vec_id as question, b.vec_id as key, list_cosine_similarity(a.{EMB}, b.{EMB}) as score
      from embeddings a, embeddings b),
xr as (select * from x qualify row_number() over (partition by question order by score desc, key) <= 5),
s as (select q.vec_id as question, i.vec_id as key, list_cosine_similarity(q.v, i.v) as score
      from near q join ivf i on i.list_id = q.list_id where q.r <= 2),
sr as (select * from s qualify row_number() over (partition by question order by score desc, key) <= 5)
select coalesce(xr.question, sr.question) as question,
  count_if(xr.key is not null and sr.key is not null)::BIGINT as overlap,
  count_if(sr.key is null)::BIGINT as exact_only, count_if(xr.key is null)::BIGINT as approx_only,
  round(max(abs(xr.score - sr.score)), 6) as max_diff
from xr full outer join sr on xr.question = sr.question and xr.key = sr.key group by 1""")
def _(t):
    corpus, questions = keyed(t)
    centroids = lists(t)
    exact = neighbours.knn_join(spread(corpus), questions, 5)
    ivf = neighbours.build_inverted_file(spread(corpus), centroids)
    approx = neighbours.ivf_search(ivf, centroids, questions, 5, nprobe=2)
    return neighbours.compare_results(exact, approx).withColumn("max_diff", F.round("max_diff", 6))


SQL_HITS = f"""
 {SQL_EMBEDDED},
 q0 as (select item_id, text as question_text from benchmark),{sql_embedding_steps('q0', 'question_text', 'q1')},
 q as (select item_id, question_text, v as qv from q1),
 s as (select item_id, question_text, doc_id, chunk_index, chunk_text,
     doc_id || '#' || chunk_index as key, round(list_cosine_similarity(v, qv), 4) as score from q, e),
 hits as (select *, row_number() over (partition by item_id order by score desc, key) as rank from s
     qualify rank <= 3),
 ctx as (select item_id, any_value(question_text) as question_text,
     string_agg('[' || doc_id || ', chunk ' || chunk_index || ']' || chr(10) || chunk_text, chr(10) || chr(10)
       order by rank) as context, string_agg(chunk_text, chr(10) || chr(10) order by rank) as plain_context,
     count(*) as chunks_used, arg_min(chunk_text, rank) as top_text from hits group by item_id)
"""


def chunk_key():
    return F.concat(F.col("doc_id").cast("string"), F.lit("#"), F.col("chunk_index").cast("string"))


def question_contexts(t: Tables) -> DataFrame:
    """Top-3 chunks per question of ``benchmark``, joined into contexts."""
    chunks = chunking.chunk_table(t.documents.select("doc_id", "text")).withColumn("key", chunk_key())
    asked = t.benchmark.select(F.col("item_id").alias("question"), F.col("text").alias("question_text"))
    hits = cut_lineage(neighbours.knn_join(
        chunks.select("key", plugs.embed("chunk_text").alias("embedding")),
        asked.withColumn("embedding", plugs.embed("question_text")), 3, round_first=4))
    # the search moved keys and vectors; texts are cut again for the few documents that were hit
    hit_docs = hits.select(F.substring_index("key", "#", 1).cast("bigint").alias("doc_id")).distinct()
    found = chunking.chunk_table(lookup_join(t.documents.select("doc_id", "text"), hit_docs, ["doc_id"], "left_semi"))
    full = hits.join(found.withColumn("key", chunk_key()), "key")
    text = F.col("chunk_text")
    contexts = answers.assemble_context(
        full, answers.context_block(F.col("doc_id"), F.col("chunk_index"), text), also={"plain_context": text}, top={"top_text": text})
    return lookup_join(contexts, asked, ["question"])


@catalog.add("vr_18_context_assembly", f"""
with {SQL_HITS} select item_id as question, context, plain_context, chunks_used from ctx""")
def _(t):
    return question_contexts(t).select("question", "context", "plain_context", "chunks_used")


@catalog.add("vr_19_prompt_assembly", f"""
with {SQL_HITS}
select item_id as question, '<|im_start|>system' || chr(10) ||
  'Answer concisely based only on the context provided.<|im_end|>' || chr(10) || '<|im_start|>user' || chr(10) ||
  'Context:' || chr(10) || context || chr(10) || chr(10) || 'Question: ' || question_text || '<|im_end|>' || chr(10) ||
  '<|im_start|>assistant' || chr(10) as chat_prompt,
  'Context:' || chr(10) || plain_context || chr(10) || chr(10) || 'Question: ' || question_text || chr(10) || chr(10) ||
  'Answer in simple terms:' as user_prompt,
  'You are a credit risk expert AI. Always base your answer strictly on the provided context.' || chr(10) || 'Context:' || chr(10) ||
  plain_context || chr(10) || chr(10) || 'Question: ' || question_text || chr(10) || chr(10) || 'Answer in simple terms:' as messages from ctx""")
def _(t):
    c = question_contexts(t)
    return c.select(
        "question",
        answers.fill_prompt(answers.CHAT_PROMPT, F.col("context"), F.col("question_text")).alias("chat_prompt"),
        answers.fill_prompt(answers.USER_PROMPT, F.col("plain_context"), F.col("question_text")).alias("user_prompt"),
        F.array_join(F.transform(answers.chat_messages(F.col("plain_context"), F.col("question_text"), answers.STRICT_SYSTEM),
                                 lambda m: m["content"]), "\n").alias("messages"))


@catalog.add("vr_20_answer_records", f"""
with {SQL_HITS}
select item_id as question, top_text as answer, null::VARCHAR as answer_error, context as context_used, chunks_used,
  'aurora' as backend, 0.0::DOUBLE as retrieval_ms, 0.0::DOUBLE as generation_ms, 0.0::DOUBLE as total_ms from ctx""")
def _(t):
    prompts = question_contexts(t).withColumn(
        "prompt", answers.fill_prompt(answers.CHAT_PROMPT, F.col("context"), F.col("question_text")))
    return answers.answer_records(prompts)


@catalog.add("vr_21_request_check", """
with r as (select conv_id, turn, case when turn % 4 = 3 then null when turn % 4 = 2 then '' else text end as q,
    case when turn = 0 then null else 'u' || (conv_id % 5) end as user_id,
    case when conv_id % 3 = 0 then null when conv_id % 3 = 1 then '7' else 'many' end as k,
    case when turn % 2 = 0 then null else 'other' end as backend from conversations)
select conv_id, turn, q, coalesce(user_id, 'default') as user_id, coalesce(backend, 'dynamo') as backend,
  case when k is null then 5 else try_cast(k as INT) end as k,
  case when coalesce(q, '') = '' then 'q is required' when k = 'many' then 'k is not a number' end as reason,
  case when coalesce(q, '') = '' or coalesce(k, '') = 'many' then 400 else 200 end as status from r""")
def _(t):
    requests = t.conversations.select(
        "conv_id", "turn",
        F.expr("case when turn % 4 = 3 then null when turn % 4 = 2 then '' else text end").alias("q"),
        F.expr("case when turn = 0 then null else concat('u', conv_id % 5) end").alias("user_id"),
        F.expr("case when conv_id % 3 = 0 then null when conv_id % 3 = 1 then '7' else 'many' end").alias("k"),
        F.expr("case when turn % 2 = 0 then null else 'other' end").alias("backend"))
    return answers.check_requests(requests, answers.QUERY_BACKEND)


@catalog.add("vr_22_metadata_decode", """
with m as (select event_id, case when event_id % 7 = 0 then props[1:4] else props end as metadata from events)
select event_id, case when json_valid(metadata) then (metadata::JSON ->> 'k')::BIGINT end as k,
  not json_valid(metadata) as empty from m""")
def _(t):
    m = t.events.select("event_id", F.expr("case when event_id % 7 = 0 then substr(props, 1, 4) else props end")
                        .alias("metadata"))
    decoded = m.withColumn("obj", answers.decode_metadata(F.col("metadata")))
    return decoded.select("event_id", F.try_variant_get("obj", "$.k", "bigint").alias("k"),
                          (F.to_json("obj") == "{}").alias("empty"))


@catalog.add("vr_23_nearest_label", f"""
with {SQL_LISTS} select vec_id, list_id::BIGINT as label, round(sim, 6) as sim from near where r = 1""")
def _(t):
    near = neighbours.nearest_centroids(t.embeddings.select("vec_id", "embedding"), lists(t), 1)
    return near.select("vec_id", F.col("near")[0]["list_id"].cast("bigint").alias("label"),
                       F.round(F.col("near")[0]["score"], 6).alias("sim"))


@catalog.add("vr_24_medoid_extremes", f"""
with {SQL_LISTS},
d as (select label, vec_id, list_distance({EMB}, cv) as dist, ({EMB})[1] as axis
      from embeddings join c on label = list_id)
select label::BIGINT as label, arg_min(vec_id, dist) as medoid, round(min(dist), 6) as medoid_distance,
  arg_min(vec_id, axis) as lowest, arg_max(vec_id, axis) as highest from d group by label""")
def _(t):
    centroids = neighbours.mean_vectors(t.embeddings, "label")
    d = lookup_join(t.embeddings, centroids, ["label"]).select(
        F.col("label").cast("bigint").alias("label"), "vec_id",
        V.l2("embedding", "centroid").alias("dist"), V.as_double("embedding")[0].alias("axis"))
    return d.groupBy("label").agg(
        F.min_by("vec_id", F.struct("dist", "vec_id")).alias("medoid"), F.round(F.min("dist"), 6).alias("medoid_distance"),
        F.min_by("vec_id", F.struct("axis", "vec_id")).alias("lowest"),
        F.max_by("vec_id", F.struct("axis", "vec_id")).alias("highest"))


@catalog.add("vr_25_snapshot_drift", f"""
select vec_id, round(list_distance({EMB}, list_reverse({EMB})), 6) as drift from embeddings""")
def _(t):
    before = t.embeddings.select("vec_id", V.as_double("embedding").alias("a"))
    after = t.embeddings.select("vec_id", F.reverse(V.as_double("embedding")).alias("b"))
    return before.join(after, "vec_id").select("vec_id", F.round(V.l2("a", "b"), 6).alias("drift"))


@catalog.add("vr_26_rescaled_dimensions", f"""
with p as ({SQL_PLACES}), b as (select dim, min(x) as lo, max(x) as hi from p group by dim)
select vec_id, dim::BIGINT as dim, round((x - lo) / nullif(hi - lo, 0) * 2 - 1, 6) as signed,
  round((x - lo) / nullif(hi - lo, 0), 6) as unsigned from p join b using (dim)""")
def _(t):
    places = t.embeddings.select("vec_id", F.posexplode(V.as_double("embedding")).alias("dim", "x"))
    bounds = places.groupBy("dim").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    share = (F.col("x") - F.col("lo")) / F.nullif(F.col("hi") - F.col("lo"), F.lit(0.0))
    return lookup_join(places, bounds, ["dim"]).select(
        "vec_id", F.col("dim").cast("bigint").alias("dim"), F.round(share * 2 - 1, 6).alias("signed"),
        F.round(share, 6).alias("unsigned"))


@catalog.add("vr_27_token_plus_position", f"""
with n as (select count(*) as n from embeddings),
w as (select conv_id, turn, unnest(range(len(ws))) as pos, unnest(ws) as word from (
   select conv_id, turn, list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '') as ws from conversations)),
k as (select conv_id, turn, pos, ('0x' || md5(word)[1:4])::INT % n.n as token_id, pos % n.n as place from w, n)
select conv_id, turn::BIGINT as turn, pos::BIGINT as pos, round(a.embedding[1]::DOUBLE + b.embedding[1]::DOUBLE, 6) as first_dim,
  round(list_sum(a.{EMB}) + list_sum(b.{EMB}), 6) as total
from k join embeddings a on a.vec_id = token_id join embeddings b on b.vec_id = place""")
def _(t):
    n = t.embeddings.count()
    words = t.conversations.select("conv_id", "turn", F.posexplode(X.split_words("text")).alias("pos", "word"))
    ids = words.select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"), F.col("pos").cast("bigint").alias("pos"),
        (F.conv(F.substring(F.md5("word"), 1, 4), 16, 10).cast("bigint") % n).alias("token_id"),
        (F.col("pos") % n).cast("bigint").alias("place"))
    # of a vector only its length, first value and sum are wanted, so no vector moves with the words
    v = V.as_double("embedding")
    brief = t.embeddings.select("vec_id", F.size(v).alias("d"), F.get(v, F.lit(0)).alias("x"), V.total(v).alias("s"))
    tokens, places = (brief.select(F.col("vec_id").alias(key), *[F.col(c).alias(f"{c}_{key}") for c in ("d", "x", "s")]) for key in ("token_id", "place"))
    both = lookup_join(lookup_join(ids, tokens, ["token_id"]), places, ["place"])
    return both.select(
        "conv_id", "turn", "pos", F.round(F.col("x_token_id") + F.col("x_place"), 6).alias("first_dim"),
        F.when(F.col("d_token_id") == F.col("d_place"), F.round(F.col("s_token_id") + F.col("s_place"), 6)).alias("total"))


@catalog.add("ud_09_vector_mean", f"""
select label::BIGINT as label, dim::BIGINT as dim, round(avg(x), 6) as value from ({SQL_PLACES}) group by all""")
def _(t):
    means = neighbours.mean_vectors(t.embeddings, "label")
    return means.select(F.col("label").cast("bigint").alias("label"), F.posexplode("centroid").alias("dim", "x")).select(
        "label", F.col("dim").cast("bigint").alias("dim"), F.round("x", 6).alias("value"))
