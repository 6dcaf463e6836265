"""From retrieved chunks to prompts and answer records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions import plugs

# Prompt texts.
CHAT_PROMPT = (
    "<|im_start|>system\n"
    "Answer concisely based only on the context provided.<|im_end|>\n"
    "<|im_start|>user\n"
    "Context:\n{context}\n\nQuestion: {question}<|im_end|>\n"
    "<|im_start|>assistant\n"
)
# System texts of the two chat templates.
EXPERT_SYSTEM = "You are an expert in credit risk, finance, and AI. Answer concisely using the given context."
STRICT_SYSTEM = "You are a credit risk expert AI. Always base your answer strictly on the provided context."
USER_PROMPT = "Context:\n{context}\n\nQuestion: {question}\n\nAnswer in simple terms:"

# Request defaults.
DEFAULT_USER = "default"
DEFAULT_K = 5
QUERY_BACKEND = "dynamo"
ANSWER_BACKEND = "aurora"


def context_block(document_id: Column, chunk_index: Column, text: Column) -> Column:
    return F.concat(F.lit("["), document_id.cast("string"), F.lit(", chunk "), chunk_index.cast("string"),
                    F.lit("]\n"), text)


def assemble_context(hits: DataFrame, block: Column, by: str = "question", rank: str = "rank",
                     also: dict[str, Column] | None = None, top: dict[str, Column] | None = None) -> DataFrame:
    """Join the k blocks of a question in rank order; a group never exceeds k rows.

    ``also`` names further contexts of the same hits, ``top`` values of the best hit; all come from one grouping.
    """
    texts, best = {"context": block, **(also or {})}, top or {}
    hit = F.struct(F.col(rank).alias("_rank"), *[c.alias(n) for n, c in {**texts, **best}.items()])
    grouped = hits.groupBy(by).agg(F.sort_array(F.collect_list(hit)).alias("_hits"), F.count(F.lit(1)).alias("chunks_used"))
    # a field of an array of structs is the array of that field
    return grouped.select(
        by, *[F.array_join(F.col("_hits").getField(n), "\n\n").alias(n) for n in texts], "chunks_used",
        *[F.col("_hits")[0][n].alias(n) for n in best])


def fill_prompt(template: str, context: Column, question: Column) -> Column:
    """Put context and question into a template without reading them as patterns."""
    head, rest = template.split("{context}")
    middle, tail = rest.split("{question}")
    return F.concat(F.lit(head), context, F.lit(middle), question, F.lit(tail))


def chat_messages(context: Column, question: Column, system: str = EXPERT_SYSTEM) -> Column:
    """System and user message of a chat model, as (role, content) entries."""
    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    return F.array(message("system", F.lit(system)), message("user", fill_prompt(USER_PROMPT, context, question)))


def answer_records(prompts: DataFrame, generator=None, backend: str = ANSWER_BACKEND) -> DataFrame:
    """Answer record per question; without a generator the best chunk is the answer.

    Expects question, prompt, context, chunks_used, top_text, and optionally ``retrieval_ms``.  The
    latencies are in milliseconds; nothing is generated without a generator, which takes no time.
    """
    if generator is None:
        answered = prompts.withColumn("answer", F.col("top_text")).withColumns({
            "answer_error": F.lit(None).cast("string"), "answer_ms": F.lit(0.0)})
    else:
        answered = plugs.generate(prompts, "prompt", generator)
    retrieval = F.coalesce("retrieval_ms", F.lit(0.0)) if "retrieval_ms" in prompts.columns else F.lit(0.0)
    return answered.select("question", "answer", "answer_error", F.col("context").alias("context_used"),
                           "chunks_used", F.lit(backend).alias("backend"), retrieval.alias("retrieval_ms"),
                           F.col("answer_ms").alias("generation_ms"), (retrieval + F.col("answer_ms")).alias("total_ms"))


def check_requests(requests: DataFrame, default_backend: str) -> DataFrame:
    """Fill defaults; ``status`` is 200, or 400 with the reason."""
    k = F.when(F.col("k").isNull(), F.lit(DEFAULT_K)).otherwise(F.expr("try_cast(k AS int)"))
    return requests.withColumns({
        "user_id": F.coalesce("user_id", F.lit(DEFAULT_USER)),
        "backend": F.coalesce("backend", F.lit(default_backend)),
        "k": k,
        "reason": F.when(F.coalesce(F.col("q"), F.lit("")) == "", "q is required").when(
            k.isNull(), "k is not a number"),
    }).withColumn("status", F.when(F.col("reason").isNull(), 200).otherwise(400))


def decode_metadata(metadata: Column) -> Column:
    """JSON text as a variant, an empty object when it does not parse."""
    return F.coalesce(F.try_parse_json(metadata), F.parse_json(F.lit("{}")))
