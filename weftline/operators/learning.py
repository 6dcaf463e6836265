"""Models from Spark ML that stand in for single-machine libraries."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import PCA, StandardScaler, StringIndexer, VectorAssembler, Word2Vec
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType, StringType
from pyspark.sql.window import Window

from weftline.functions import vectors as V
from weftline.operators import metrics, neighbours, skip_gram, tabular
from weftline.session import cut_lineage

BINS = 32  # per column of numbers, as the library has by default
GROUP_BEYOND = 100_000  # training rows; fewer go to the trees as they are
TASK_WORDS = 500_000  # words that one task trains word vectors on
DRIVER_WORDS = 200_000  # different words that the library may hold on the driver


def boosted_scores(train: DataFrame, test: DataFrame, features: list[str], label: str, trees: int = 100,
                   depth: int = 1, rate: float = 0.1, seed: int = 42, group_beyond: int = GROUP_BEYOND) -> DataFrame:
    """Boosted trees on mixed columns; strings count as categories.  Adds probability and score.

    Trees see a number only by its bin, so beyond ``group_beyond`` training rows those that agree in all bins, categories and
    label become one row with their number as weight: every row counts, and a pass over the trees reads the groups alone.
    """
    columns, kinds = test.columns, {f.name: f for f in train.schema if f.name in features}
    strings = [c for c, f in kinds.items() if isinstance(f.dataType, StringType)]
    numbers = [c for c in features if c not in strings]
    indexed = [f"_{c}" for c in strings]
    stages = [StringIndexer(inputCols=strings, outputCols=indexed, handleInvalid="keep").fit(train)] if strings else []
    learner = GBTClassifier(featuresCol="_features", labelCol=label, maxIter=trees, maxDepth=depth, stepSize=rate,
                            seed=seed, checkpointInterval=10)
    # columns of vectors, or with a meaning of their own to the library, stay as they are
    plain = all(isinstance(kinds[c].dataType, (NumericType, BooleanType)) and not kinds[c].metadata for c in numbers)
    counts = train.agg(F.count(F.lit(1)).alias("n"), *[
        F.approx_count_distinct(c).alias(f"d{i}") for i, c in enumerate(numbers)]).first() if plain else None
    if plain and counts["n"] > group_beyond:
        borders = _bin_borders(train, {c: counts[f"d{i}"] for i, c in enumerate(numbers)})
        bins = {f"_{c}": _in_bins(c, at) for c, at in borders.items()}
        train, test = train.withColumns(bins), test.withColumns(bins)
        train = cut_lineage(train.groupBy(*strings, *bins, label).agg(F.count(F.lit(1)).cast("double").alias("_weight")))
        # so many bins allowed that the library looks for its borders in all groups, not in a sample, and takes each
        learner = learner.setWeightCol("_weight").setMaxBins(max(2 * BINS, math.isqrt(train.count()) + 1))
        inputs = [f"_{c}" for c in features]
    else:
        inputs = [f"_{c}" if c in strings else c for c in features]
    stages += [VectorAssembler(inputCols=inputs, outputCol="_features", handleInvalid="keep"), learner]
    scored = Pipeline(stages=stages).fit(train).transform(test)
    p = vector_to_array("probability")[1]
    return scored.select(*columns, p.alias("approval")).withColumn(
        "credit_score", tabular.credit_score(F.col("approval")))


def _bin_borders(rows: DataFrame, distinct: dict[str, int]) -> dict[str, list[float]]:
    """Borders of at most :data:`BINS` bins per column: between all values if they are that few, else quantiles of all rows.

    ``distinct`` has rough numbers of values.
    """
    few = {}
    for c in (c for c, n in distinct.items() if n <= 2 * BINS):
        x = F.col(c).cast("double")
        met = sorted(r[0] for r in rows.select(x).filter(F.abs(x) < math.inf).distinct().limit(BINS + 1).collect())
        if len(met) <= BINS:
            few[c] = [low + (high - low) / 2 for low, high in zip(met, met[1:])]
    many = [c for c in distinct if c not in few]
    cuts = rows.select(*[F.col(c).cast("double").alias(c) for c in many]).approxQuantile(
        many, [i / BINS for i in range(1, BINS)], 1e-3) if many else []
    found = few | dict(zip(many, cuts))
    return {c: sorted({x for x in at if math.isfinite(x)}) for c, at in found.items()}


def _in_bins(column: str, borders: list[float]) -> Column:
    """Number of the bin, from 0; a missing or infinite value stays itself, which training refuses as it does on rows."""
    x = F.col(column).cast("double")
    number = F.lit(0)
    for i, at in enumerate(borders):
        number = number + (x >= at).cast("int")
    return F.when(F.abs(x) < math.inf, number.cast("double")).otherwise(x)


def forest_scenarios(scenarios: dict[str, DataFrame], target: str, keys: list[str], trees: int = 100,
                     seed: int = 42) -> DataFrame:
    """Random forest per embedding scenario: RMSE and MAE on half of the rows."""
    rows = []
    for name, df in scenarios.items():
        data = df.withColumn("_x", array_to_vector(V.as_double("embedding")))
        # stored once, because every pass over the trees reads the rows again
        parts = cut_lineage(tabular.exact_split(data, keys, 0.5, seed))
        model = RandomForestRegressor(featuresCol="_x", labelCol=target, numTrees=trees, seed=seed).fit(
            parts.filter(~F.col("is_test")))
        scored = model.transform(parts.filter("is_test"))
        rows.append(metrics.rmse_mae(scored, target, "prediction").withColumn("scenario", F.lit(name)))
    return reduce(DataFrame.unionByName, rows)


def word_vectors(sentences: DataFrame, words_col: str, size: int = 16, window: int = 5, seed: int = 42,
                 min_count: int = 1, driver_words: int = DRIVER_WORDS) -> DataFrame:
    """Word vectors (skip-gram) as rows of word and embedding.

    The library holds the vocabulary on the driver, with two arrays of 40 numbers a word, so it gets up to about ``driver_words``
    different words; beyond that :mod:`skip_gram` trains by the same method without it.  Either way a task gets about
    :data:`TASK_WORDS` words.
    """
    sentences = sentences.filter(F.col(words_col).isNotNull())  # the library fails on them
    met = sentences.select(F.explode(words_col).alias("word")).agg(
        F.count(F.lit(1)).alias("n"), F.approx_count_distinct("word").alias("distinct")).first()
    n_tasks = max(1, -(-met["n"] // TASK_WORDS))
    if met["distinct"] > driver_words:
        return skip_gram.skip_gram_vectors(sentences, words_col, size, window, seed, min_count, n_tasks)
    model = Word2Vec(vectorSize=size, windowSize=window, minCount=min_count, inputCol=words_col, outputCol="_v", seed=seed,
                     maxIter=1, numPartitions=n_tasks).fit(sentences)
    return model.getVectors().select("word", vector_to_array("vector").alias("embedding"))


def principal_components(df: DataFrame, k: int = 2, vector_col: str = "embedding") -> DataFrame:
    """Centred projection on the first ``k`` components; the sign of a component is arbitrary."""
    data = df.withColumn("_x", array_to_vector(V.as_double(vector_col)))
    centred = StandardScaler(withMean=True, withStd=False, inputCol="_x", outputCol="_c").fit(data).transform(data)
    done = PCA(k=k, inputCol="_c", outputCol="_p").fit(centred).transform(centred)
    return done.withColumn("components", vector_to_array("_p")).drop("_x", "_c", "_p")


def most_similar(vectors: DataFrame, requests: DataFrame, k: int, key_col: str = "key",
                 vector_col: str = "embedding") -> DataFrame:
    """Nearest keys to a signed mean of unit vectors; the inputs themselves are left out.

    ``requests`` has question, key and sign (1 or -1), a bounded number of keys per question.
    """
    unit = vectors.select(F.col(key_col).alias("key"), V.unit(vector_col).alias("u"))
    signed = requests.join(unit, "key").select(
        "question", F.transform("u", lambda x: x * F.col("sign")).alias("embedding"))
    asked = neighbours.mean_vectors(signed, "question").withColumnRenamed("centroid", "embedding")
    most = requests.groupBy("question").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    found = neighbours.knn_join(vectors, asked, k + most, key_col=key_col, vector_col=vector_col)
    others = found.join(requests.select("question", "key").distinct(), ["question", "key"], "left_anti")
    order = Window.partitionBy("question").orderBy("rank")
    return others.withColumn("rank", F.row_number().over(order).cast("bigint")).filter(F.col("rank") <= k)
