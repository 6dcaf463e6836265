"""From raw documents to tokens: five stages over the ``documents`` table.

Each stage takes all rows its predecessor kept.  Stages before the last return the columns of
``documents``; the last one adds tokens.  Rows are only removed by the decisions named here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import contamination, minhash, pii, toxicity, unigram
from weftline.llm.groups import stage
from weftline.operators.lookup import lookup_join
from weftline.session import ship_package

ORACLE_SQL = None
#: word-shingle similarity in percent at which the stage links; op6 has its own contract (85)
NEAR_PERCENT = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model).filter(F.col("score") < toxicity.THRESHOLD).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one with the smallest id; null ids stay."""
    found = minhash.near_duplicates(docs, percent=NEAR_PERCENT)
    gone = stage(found.filter(~F.col("kept")).select(F.col("id").alias("doc_id")), "gone")
    return lookup_join(docs, gone, ["doc_id"], "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with at least one word in twenty from a benchmark window go."""
    hits = contamination.benchmark_hits(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return hits.filter(~contamination.is_contaminated(F.col("n_words"), F.col("n_hit"))).select("row.*")


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the text is replaced by its kind, and the length follows."""
    done = pii.mask_personal_data(docs)
    return done.withColumn("n_chars", F.char_length("text").cast("bigint")).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every text, with whether they give the text back."""
    model = unigram.UnigramModel.from_file(unigram.default_model_path())
    done = unigram.encode_texts(docs, model)
    return done.select("row.*", "n_tokens", "ids", F.col("decoded").eqNullSafe(F.col("row.text")).alias("round_trip"))


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("decontamination", drop_contaminated),
          ("personal_data", mask_personal_data), ("tokens", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again, so a lost executor repeats one stage at most."""
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, fn in STAGES[:-1]:
        docs = stage(fn(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
