"""Registered queries of this subpackage and their reference SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import (
    chat_tree, contamination, cotraining, main_text, merkle, minhash, neighbour_graph, pii, prefix_counts, substrings, toxicity, unigram, warc_index,
)
from weftline.llm import sql as S
from weftline.llm.groups import stage
from weftline.session import ship_package


def _table(spark: SparkSession, path: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{path}/{name}.parquet")


def op1_vector_near_duplicates(spark: SparkSession, path: str) -> DataFrame:
    found = neighbour_graph.near_duplicates(_table(spark, path, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "n_links", "component_id", "kept")


def op2_warc_captures(spark: SparkSession, path: str) -> DataFrame:
    index = warc_index.capture_index(_table(spark, path, "pages"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_toxicity(spark: SparkSession, path: str) -> DataFrame:
    docs = _table(spark, path, "documents")
    model = toxicity.train(docs, _table(spark, path, "labels"))
    return toxicity.score(docs, model, carry=["doc_id"]).select(
        "row.doc_id", toxicity.is_held_out(F.col("row.doc_id")).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op4_repeated_passages(spark: SparkSession, path: str) -> DataFrame:
    done = substrings.without_repeats(_table(spark, path, "documents"), carry=["doc_id"])
    return done.select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op5_decontamination(spark: SparkSession, path: str) -> DataFrame:
    hits = contamination.benchmark_hits(_table(spark, path, "documents"), _table(spark, path, "benchmark"), carry=["doc_id"])
    return hits.select("row.doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                       contamination.items_digest(F.col("items")).alias("items_sha256"),
                       contamination.is_contaminated(F.col("n_words"), F.col("n_hit")).alias("contaminated"))


def op6_minhash_near_duplicates(spark: SparkSession, path: str) -> DataFrame:
    done = minhash.near_duplicates(_table(spark, path, "documents"))
    return done.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


def op7_sentencepiece(spark: SparkSession, path: str) -> DataFrame:
    """Tokens and round trip of every text; ids are digested as comma-joined numbers."""
    model = unigram.UnigramModel.from_file(unigram.default_model_path())
    done = unigram.encode_texts(_table(spark, path, "documents"), model, carry=["doc_id", "text"])
    return done.select("row.doc_id", "n_tokens", "n_unknown", F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"), F.col("decoded").eqNullSafe(F.col("row.text")).alias("round_trip"))


def op8_personal_data(spark: SparkSession, path: str) -> DataFrame:
    done = pii.personal_data(_table(spark, path, "documents"), carry=["doc_id"])

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")

    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE_KINDS))
    return done.select("row.doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(joined(base), 256).alias("base_sha256"),
                       joined(F.col("spans")).alias("spans"))


def op9_main_text(spark: SparkSession, path: str) -> DataFrame:
    done = main_text.main_texts(_table(spark, path, "pages"), carry=["page_id", "url"])
    return done.select("row.page_id", "row.url", F.col("main").alias("text"), F.char_length("main").cast("bigint").alias("n_chars"))


def op10_quality(spark: SparkSession, path: str) -> DataFrame:
    docs = _table(spark, path, "documents")
    model = cotraining.train(docs, _table(spark, path, "labels"))
    return cotraining.score(docs, model, carry=["doc_id"]).select(
        "row.doc_id", toxicity.is_held_out(F.col("row.doc_id")).alias("held_out"), "score", "content_score", "metadata_score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


MANIFEST_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def op11_merkle_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Leaves, roots and proofs of all documents; a third of the texts is tampered with and folded again."""
    docs = _table(spark, path, "documents")
    upper = "".join(map(chr, range(65, 91)))
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.translate("text", upper, upper.lower())).otherwise(F.col("text"))
    other = merkle.digest([tampered if f == "text" else F.col(f) for f in MANIFEST_FIELDS])
    made = merkle.manifest(docs, MANIFEST_FIELDS, by="lang", key="doc_id", extra={"now": other})
    folded = made.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"),
                         merkle.fold(F.col("now"), F.col("path")).alias("folded_root"))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_chat_tree(spark: SparkSession, path: str) -> DataFrame:
    """All conversations and one whose texts are made of control strings, formatted as a tree and read back from it."""
    talks = _table(spark, path, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit("\\### Assistant: </turn> ok")
    extra = spark.range(2).select(F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"))
    return chat_tree.read_chats(*chat_tree.format_chats(talks.unionByName(extra)))


def op13_prefix_trie(spark: SparkSession, path: str) -> DataFrame:
    turns = stage(prefix_counts.numbered_turns(_table(spark, path, "conversations")), "numbered")
    return prefix_counts.prefix_trie(prefix_counts.rebuilt_turns(turns))


QUERIES = {f.__name__: f for f in (
    op1_vector_near_duplicates, op2_warc_captures, op3_toxicity, op4_repeated_passages, op5_decontamination,
    op6_minhash_near_duplicates, op7_sentencepiece, op8_personal_data, op9_main_text, op10_quality,
    op11_merkle_manifest, op12_chat_tree, op13_prefix_trie)}
SQL = dict(S.SQL)
