"""Extractive summaries: sentences ranked by the frequency of their words.

``summarize`` works inside the row.  The tables behind it (words, frequencies, scores) are there for
their own sake: the documents are shuffled once, by key, and everything after that groups by the
key and more, so it runs inside those partitions.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from itertools import chain

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weftline.functions import text as X

# Punctuation characters, messages, content parts of speech.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
EMPTY_TEXT = "Enter some text to summarize."
NO_SENTENCES = "Could not detect any sentences in the text."
CONTENT_POS = ("PROPN", "ADJ", "NOUN", "VERB")

TASK_BYTES = 4 << 20  # texts whose words one task counts

# A short default; pass the list that fits the language of the corpus.
STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "had", "has", "he", "her", "his", "in", "is",
    "it", "its", "of", "on", "or", "she", "that", "the", "their", "they", "this", "to", "was", "we", "were",
    "which", "with", "you",
)


def sentences(text: Column | str) -> Column:
    """Split behind ``.``, ``!`` or ``?`` and white space."""
    marked = F.regexp_replace(X.strip(F.coalesce(X.col(text), F.lit(""))), r"([.!?])\s+", "$1\u0001")
    return F.filter(F.split(marked, "\u0001"), lambda s: s != "")


def clean_sentence(s: Column) -> Column:
    return X.strip(F.regexp_replace(X.strip(s), '^"+|"+$', ""))


def is_content_word(token: Column, stop_words: tuple[str, ...] = STOP_WORDS, pos: Column | None = None) -> Column:
    """Neither stop word (case-sensitive) nor inside the punctuation string; ``pos`` narrows further."""
    keep = ~token.isin(*stop_words) & ~F.contains(F.lit(PUNCTUATION), token)
    return keep if pos is None else keep & pos.isin(*CONTENT_POS)


def sentence_rows(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    return docs.select(key, F.posexplode(sentences(text_col)).alias("sent", "sentence"))


def content_words(docs: DataFrame, key: str, text_col: str = "text",
                  stop_words: tuple[str, ...] = STOP_WORDS) -> DataFrame:
    """One row per content word occurrence with its sentence and place.

    The place is one number, sentence before position, so that counting stays with plain longs.
    """
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    # a task's tables of words follow its texts, so their bytes give the number of tasks
    n_tasks = max(docs.sparkSession.sparkContext.defaultParallelism, -(-size // TASK_BYTES))
    rows = sentence_rows(docs.select(key, text_col).repartition(n_tasks, key), key, text_col)
    tokens = rows.select(key, "sent", F.posexplode(X.word_tokens("sentence")).alias("pos", "word"))
    return tokens.filter(is_content_word(F.col("word"), stop_words)).select(
        key, "sent", "word", F.expr("cast(sent as bigint) * 4294967296 + pos").alias("place"))


def keyword_frequencies(words: DataFrame, key: str) -> DataFrame:
    """Count, share of the text's largest count and first place per word."""
    counts = words.groupBy(key, "word").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first_at"))
    return counts.withColumn("share", F.col("n") / F.max("n").over(Window.partitionBy(key)))


def top_keywords(frequencies: DataFrame, key: str, n: int = 5) -> DataFrame:
    """Most frequent words, ties by first occurrence."""
    order = Window.partitionBy(key).orderBy(F.desc("n"), "first_at")
    return frequencies.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def sentence_scores(words: DataFrame, key: str) -> DataFrame:
    """Sum of the shares of all word occurrences; the largest count is found among sentences, not words."""
    # occurrences are counted per sentence first; only those counts meet the total of their word
    local = words.groupBy(key, "word", "sent").agg(F.count(F.lit(1)).alias("_c"))
    counted = local.withColumn("n", F.sum("_c").over(Window.partitionBy(key, "word")))
    sums = counted.groupBy(key, "sent").agg(F.sum(F.col("n") * F.col("_c")).alias("_s"), F.max("n").alias("_m"))
    score = F.col("_s") / F.max("_m").over(Window.partitionBy(key))
    return sums.select(key, "sent", score.alias("score"))


def ranked_sentences(scores: DataFrame, key: str) -> DataFrame:
    """Rank by score, earlier sentences first among equals.

    Scores are rounded for the order, so that equal sums do not part by the order of adding.
    """
    order = Window.partitionBy(key).orderBy(F.desc(F.round("score", 9)), "sent")
    return scores.withColumn("rank", F.row_number().over(order))


_RANKED = "struct<sentences: array<string>, picked: array<int>, words: array<struct<word: string, n: bigint>>>"


def _ranked(parts: list[str], tokens: list[list[str]], n_sentences: int, n_keywords: int) -> dict:
    """Places of the best sentences and the most frequent words, from the content words of each sentence."""
    counts = Counter(chain.from_iterable(tokens))  # keeps the order of first occurrence
    most = max(counts.values(), default=1)
    scores = [(-round(sum(counts[t] for t in words) / most, 9), i) for i, words in enumerate(tokens) if words]
    return {"sentences": parts, "picked": [i for _, i in sorted(scores)[:n_sentences]],
            "words": [{"word": w, "n": n} for w, n in sorted(counts.items(), key=lambda c: -c[1])[:n_keywords]]}


def summarize(docs: DataFrame, key: str, text_col: str = "text", n_sentences: int = 3, n_keywords: int = 5,
              stop_words: tuple[str, ...] = STOP_WORDS, annotator: Callable | None = None) -> DataFrame:
    """Summary, sentence count, top keywords and error per document; no document is lost.

    A document is one row, so it is counted where it lies and nothing is shuffled.  ``annotator() ->
    (list[str] -> list of [(sentence, [(token, part of speech)])])`` replaces the rules for sentences and
    words; of its tokens only those of :data:`CONTENT_POS` count.
    """
    stops = frozenset(stop_words)

    def counts_as(token: str) -> bool:
        return token not in stops and token not in PUNCTUATION

    if annotator is None:
        @F.pandas_udf(_RANKED)
        def rank(parts: pd.Series, tokens: pd.Series) -> pd.DataFrame:
            return pd.DataFrame([_ranked(list(p), [[t for t in ts if counts_as(t)] for ts in rows], n_sentences, n_keywords)
                                 for p, rows in zip(parts, tokens)], columns=["sentences", "picked", "words"])

        parts = sentences(text_col)
        ranked = rank(parts, F.transform(parts, lambda s: X.word_tokens(s)))
    else:
        @F.pandas_udf(_RANKED)
        def rank(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            annotate = annotator()
            for texts in batches:
                rows = annotate([(t or "").strip() for t in texts])
                yield pd.DataFrame([_ranked([s for s, _ in row], [[t for t, pos in ts if pos in CONTENT_POS and counts_as(t)] for _, ts in row],
                                            n_sentences, n_keywords) for row in rows], columns=["sentences", "picked", "words"])

        ranked = rank(X.col(text_col))
    full = docs.select(key, text_col, ranked.alias("_r")).select(key, text_col, "_r.*")
    chosen = F.when(F.size("picked") > 0, F.transform("picked", lambda i: F.get(F.col("sentences"), i))) \
        .otherwise(F.slice("sentences", 1, n_sentences))
    empty = X.strip(F.coalesce(F.col(text_col), F.lit(""))) == ""
    return full.select(
        key,
        F.when(empty, "").when(F.size("sentences") == 0, F.col(text_col))
        .otherwise(F.array_join(F.transform(chosen, clean_sentence), " ")).alias("summary"),
        F.size("sentences").alias("num_sentences"), F.col("words").alias("top_keywords"),
        F.when(empty, EMPTY_TEXT).when(F.size("sentences") == 0, NO_SENTENCES).alias("error"))
