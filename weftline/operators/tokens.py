"""Vocabularies, encoding, decoding and token windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions import text as X
from weftline.operators.lookup import lookup_join
from weftline.operators.ordering import dense_index

# Special tokens.
END_OF_TEXT = "<|endoftext|>"
UNKNOWN = "<|unk|>"


def token_rows(docs: DataFrame, keys: list[str], text_col: str = "text",
               separators: str = X.TOKEN_SEPARATORS_V2) -> DataFrame:
    return docs.select(*keys, F.posexplode(X.word_tokens(text_col, separators)).alias("pos", "token"))


def vocabulary(tokens: DataFrame, specials: tuple[str, ...] = ()) -> DataFrame:
    """Distinct tokens in code-point order with ids 0..n-1; special tokens follow at the end."""
    table = dense_index(tokens.select("token").distinct(), "token", "token_id")
    if not specials:
        return table
    n = table.count()
    extra = table.sparkSession.createDataFrame(
        [(s, n + i) for i, s in enumerate(specials)], "token string, token_id bigint")
    return table.unionByName(extra)


def encode(tokens: DataFrame, vocab: DataFrame, unknown: str | None = UNKNOWN) -> DataFrame:
    """Add ``token_id``; unknown tokens become ``unknown``'s id, or stay null without one."""
    coded = lookup_join(tokens, vocab, ["token"], "left")
    if unknown is None:
        return coded
    unk = vocab.filter(F.col("token") == unknown).first()
    if unk is None:
        raise ValueError(f"vocabulary has no {unknown}")
    return coded.withColumn("token_id", F.coalesce("token_id", F.lit(unk["token_id"])))


def require_known(coded: DataFrame) -> DataFrame:
    """Fail when a token is missing from the vocabulary."""
    missing = coded.filter(F.col("token_id").isNull()).select("token").first()
    if missing is not None:
        raise KeyError(missing["token"])
    return coded


def decode(coded: DataFrame, vocab: DataFrame, keys: list[str]) -> DataFrame:
    """Text per key: tokens joined by blanks, none before punctuation."""
    words = lookup_join(coded.select(*keys, "pos", "token_id"), vocab, ["token_id"])
    ordered = F.sort_array(F.collect_list(F.struct("pos", "token")))  # the tokens of one text
    joined = F.array_join(F.transform(ordered, lambda s: s["token"]), " ")
    return words.groupBy(*keys).agg(F.regexp_replace(joined, r"\s+([,.?!\"()'])", "$1").alias("text"))


def marked_stream(docs: DataFrame, order: str, text_col: str = "text") -> DataFrame:
    """The documents as one stream in pieces: the end marker follows every text but the last."""
    last = docs.agg(F.max(order)).first()[0]
    piece = F.when(F.col(order) == F.lit(last), F.col(text_col)).otherwise(
        F.concat(F.col(text_col), F.lit(f" {END_OF_TEXT} ")))
    return docs.select(order, piece.alias("piece"))


def token_windows(ids: Column, length: int, stride: int) -> Column:
    """(start, input, target) windows; the target is the input moved on by one."""
    n = F.size(ids)
    starts = F.sequence(F.lit(0), n - length - 1, F.lit(stride))
    one = F.transform(starts, lambda i: F.struct(
        i.alias("start"), F.slice(ids, i + 1, F.lit(length)).alias("input"),
        F.slice(ids, i + 2, F.lit(length)).alias("target")))
    return F.when(n > length, one)


def growing_contexts(ids: Column) -> Column:
    """(context, next) pairs with contexts of 1, 2, ... tokens."""
    n = F.size(ids)
    return F.when(n > 1, F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.struct(
        F.slice(ids, F.lit(1), i).alias("context"), F.get(ids, i).alias("next"))))


def batches(rows: DataFrame, order: list[str], size: int) -> DataFrame:
    """Rows with ``batch`` 0, 1, ...; an incomplete last batch is left out."""
    numbered = dense_index(rows, order)
    full = numbered.count() // size
    return numbered.withColumn("batch", F.expr(f"idx div {size}")).filter(F.col("batch") < full).drop("idx")


def corpus_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Characters, tokens and distinct tokens of the corpus."""
    chars = docs.agg(F.sum(F.length(text_col)).cast("bigint").alias("characters")).select(
        "characters", F.lit(0).cast("bigint").alias("tokens"), F.lit(0).cast("bigint").alias("vocabulary"))
    counts = token_rows(docs, [], text_col).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    both = counts.agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("vocabulary")).select(
        F.lit(0).cast("bigint").alias("characters"), "tokens", "vocabulary")
    return chars.unionByName(both).agg(*[F.sum(c).alias(c) for c in ("characters", "tokens", "vocabulary")])


def word_prefixes(docs: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """Every prefix of 1..n words."""
    words = X.split_words(text_col)
    counted = docs.select(*keys, words.alias("_w")).filter(F.size("_w") > 0)
    return counted.select(*keys, "_w", F.explode(F.sequence(F.lit(1), F.size("_w"))).alias("n_words")).select(
        *keys, "n_words", F.array_join(F.slice("_w", F.lit(1), F.col("n_words")), " ").alias("prefix"))
