"""Nearest-neighbour search over tables of vectors.

``search`` answers one question with built-in expressions.  ``knn_join`` answers a table of
questions: the corpus stays where it lies, each task scores its rows against a size-checked
block of questions as a matrix product and hands on at most k rows per question.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from weftline.functions import vectors as V
from weftline.session import cut_lineage

QUESTION_BYTES = 32 << 20  # largest question block copied to every task
SCORE_CELLS = 2_000_000  # rows x questions scored at once inside a task
ASKS_AT_ONCE = 2_000  # questions among them
PAIRS_AT_ONCE = 10_000  # rows x questions near enough to be scored in double precision at once
METRICS = ("cosine", "l2", "squared_l2")


def metric_column(a, b, metric: str) -> Column:
    if metric == "cosine":
        return V.cosine(a, b)
    if metric == "l2":
        return V.l2(a, b)
    if metric == "squared_l2":
        return V.squared_l2(a, b)
    raise ValueError(f"metric must be one of {METRICS}")


def search(corpus: DataFrame, question: list[float], k: int = 5, *, metric: str = "cosine",
           tenant: str | None = None, tenant_col: str = "user_id", vector_col: str = "embedding",
           key_col: str = "document_chunk", round_first: int | None = None) -> DataFrame:
    """Top-k rows for one question vector.

    ``round_first`` rounds the score before ordering (ties then fall to the key);
    otherwise the raw score orders and the caller rounds what it shows.
    """
    rows = corpus if tenant is None else corpus.filter(F.col(tenant_col) == F.lit(tenant))
    q = F.array(*[F.lit(float(x)) for x in question])
    score = metric_column(F.col(vector_col), q, metric)
    if round_first is not None:
        score = F.round(score, round_first)
    order = F.desc("score") if metric == "cosine" else F.asc("score")
    return rows.withColumn("score", score).orderBy(order, F.asc(key_col)).limit(k)


# ---------------------------------------------------------------- table of questions

def _score_block(x: np.ndarray, q: np.ndarray, metric: str) -> np.ndarray:
    if metric == "cosine":
        scale = np.linalg.norm(x, axis=1)[:, None] * np.linalg.norm(q, axis=1)[None, :]
        return np.divide(x @ q.T, scale, out=np.zeros((len(x), len(q))), where=scale > 0)
    # differences, not the expanded square: that one loses digits for close vectors
    out = np.empty((len(x), len(q)))
    for j in range(len(q)):
        d = x - q[j]
        out[:, j] = np.einsum("ij,ij->i", d, d)
    return np.sqrt(out) if metric == "l2" else out


def _round_half_up(s: np.ndarray, digits: int) -> np.ndarray:
    scaled = s * 10**digits
    return np.where(scaled < 0, np.ceil(scaled - 0.5), np.floor(scaled + 0.5)) / 10**digits


def _no_rows() -> pd.DataFrame:
    """Columns of no type yet, so that they fit keys of any type."""
    return pd.DataFrame({c: pd.Series([], dtype=object) for c in ("question", "key", "score")})


class _Best:
    """At most k (score, key) per question, merged batch by batch; one array holds all questions."""

    def __init__(self, n_questions: int, k: int, larger_first: bool):
        self.k, self.sign = k, -1.0 if larger_first else 1.0
        self.n = np.zeros(n_questions, dtype=np.int64)
        self.cost = np.full((n_questions, k), np.inf)
        self.keys: np.ndarray | None = None
        #: the worst cost kept of each question, infinite until it has k rows
        self.edge = np.full(n_questions, np.inf)

    def offer(self, slots: np.ndarray, scores: np.ndarray, keys: np.ndarray) -> None:
        """Pairs of a question's slot and a row; a slot may come any number of times."""
        if not len(slots) or not self.k:
            return
        if self.keys is None:
            self.keys = np.zeros(self.cost.shape, keys.dtype)
        elif self.keys.dtype != keys.dtype:
            self.keys = self.keys.astype(np.promote_types(self.keys.dtype, keys.dtype))
        met = np.unique(slots)
        had = np.arange(self.k) < self.n[met][:, None]
        slots = np.concatenate([np.repeat(met, self.n[met]), slots])
        cost = np.concatenate([self.cost[met][had], self.sign * scores])
        keys = np.concatenate([self.keys[met][had], keys])
        order = np.lexsort((keys, cost, slots))
        slots, cost, keys = slots[order], cost[order], keys[order]
        place = np.arange(len(slots)) - np.searchsorted(slots, slots)
        stay = place < self.k
        slots, place = slots[stay], place[stay]
        self.cost[slots, place], self.keys[slots, place] = cost[stay], keys[stay]
        self.n[met] = np.bincount(np.searchsorted(met, slots), minlength=len(met))
        full = met[self.n[met] == self.k]
        worst = self.cost[full, self.k - 1]
        self.edge[full] = np.where(np.isnan(worst), np.inf, worst)

    def frame(self, question_keys: np.ndarray) -> pd.DataFrame:
        if self.keys is None:
            return _no_rows()
        had = np.arange(self.k) < self.n[:, None]
        return pd.DataFrame({"question": np.repeat(question_keys, self.n), "key": self.keys[had], "score": self.sign * self.cost[had]})


def _sortable(values) -> np.ndarray:
    arr = np.asarray(values)
    return arr.astype(str) if arr.dtype == object else arr


def _offer_rows(best: _Best, keys, scopes, x: np.ndarray, q: np.ndarray, q_scope, q_slot,
                metric: str, round_first: int | None, near_q: tuple[np.ndarray, np.ndarray] | None = None) -> None:
    groups = [(np.arange(len(x)), np.arange(len(q)))]
    if scopes is not None:
        groups = [
            (np.flatnonzero(scopes == s), np.flatnonzero(q_scope == s))
            for s in np.intersect1d(np.unique(scopes), np.unique(q_scope))
        ]
    if metric == "cosine":
        (scale_x, near_x), (scale_q, near_q) = _directions(x), near_q or _directions(q)
        # single precision only leaves out what is farther from the edge than its error and the rounding of the score
        slack = 1.2e-7 * (x.shape[1] + 16) + (0.0 if round_first is None else 10.0**-round_first)
    for rows, asks in groups:
        wide = max(1, min(len(asks), ASKS_AT_ONCE))
        step = max(1, SCORE_CELLS // wide)
        for lo in range(0, len(rows), step):
            part = rows[lo:lo + step]
            for at in range(0, len(asks), wide):
                some = asks[at:at + wide]
                slots = q_slot[some]
                if metric == "cosine":
                    cost = near_x[part] @ -near_q[some].T
                else:
                    s = _score_block(x[part], q[some], metric)
                    s = s if round_first is None else _round_half_up(s, round_first)
                    cost = best.sign * s
                edge = best.edge[slots]
                if len(part) <= best.k:
                    r, c = np.divmod(np.arange(cost.size), len(some))
                else:
                    if np.isinf(edge).any():  # the k best of the slice are a bound as good
                        edge = np.minimum(edge, np.partition(cost, best.k - 1, axis=0)[best.k - 1] + (slack if metric == "cosine" else 0.0))
                    near = cost <= (edge + slack if metric == "cosine" else edge).astype(cost.dtype)
                    r, c = np.divmod(np.flatnonzero(near.ravel()), len(some))  # flat: twice as fast as by rows and columns
                if not len(r):
                    continue
                if metric != "cosine":
                    best.offer(slots[c], s[r, c], keys[part[r]])
                    continue
                for i in range(0, len(r), PAIRS_AT_ONCE):  # exact scores, each from its own pair alone, so that equal vectors tie
                    rows_i, asks_i = part[r[i:i + PAIRS_AT_ONCE]], some[c[i:i + PAIRS_AT_ONCE]]
                    scale = scale_x[rows_i] * scale_q[asks_i]
                    dots = np.einsum("ij,ij->i", x[rows_i], q[asks_i])
                    exact = np.divide(dots, scale, out=np.zeros(len(dots)), where=scale > 0)
                    exact = exact if round_first is None else _round_half_up(exact, round_first)
                    good = ~(-exact > best.edge[q_slot[asks_i]])
                    best.offer(q_slot[asks_i[good]], exact[good], keys[rows_i[good]])


def _directions(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths, and unit vectors in single precision."""
    length, near = np.linalg.norm(x, axis=1), np.empty(x.shape, np.float32)
    np.divide(x, np.where(length > 0, length, 1.0)[:, None], out=near, casting="same_kind")
    return length, near


def knn_join(corpus: DataFrame, questions: DataFrame, k: int, *, metric: str = "cosine",
             scope: str | None = None, key_col: str = "key", vector_col: str = "embedding",
             question_col: str = "question", round_first: int | None = None,
             block_bytes: int = QUESTION_BYTES) -> DataFrame:
    """k nearest corpus rows per question: (question, rank, key, score).

    ``scope`` names a column both sides must agree on (a tenant, or a list of an inverted
    file); a question may appear under several scopes.  Question tables beyond
    ``block_bytes`` are sent to the corpus in hashed blocks, one after another; the corpus never
    moves, each block keeps at most k rows per question and task, and the bests are merged.
    """
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    extra = [scope] if scope else []
    rows = corpus.select(F.col(key_col).alias("key"), *extra, V.as_double(vector_col).alias("v"))
    asks = questions.select(F.col(question_col).alias("question"), *extra, V.as_double(vector_col).alias("v"))
    out_schema = T.StructType([
        T.StructField("question", asks.schema["question"].dataType),
        T.StructField("key", rows.schema["key"].dataType),
        T.StructField("score", T.DoubleType()),
    ])
    larger_first = metric == "cosine"
    size = asks.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("d")).first()
    ask_bytes = size["n"] * ((size["d"] or 0) * 8 + 64)

    def packed(block: pd.DataFrame) -> tuple:
        """A block as plain arrays, which a worker holds once: ids, their slot per row, scopes, vectors."""
        names, first, slot = np.unique(_sortable(block["question"]), return_index=True, return_inverse=True)
        return (block["question"].to_numpy()[first], slot, _sortable(block[scope]) if scope else None,
                np.vstack(block["v"].to_numpy()).astype(float))

    def score_rows(block: tuple, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        original, slot, q_scope, q = block
        best, near_q = _Best(len(original), k, larger_first), _directions(q) if metric == "cosine" else None
        for pdf in batches:
            if len(pdf):
                x = np.vstack(pdf["v"].to_numpy()).astype(float)
                scopes = _sortable(pdf[scope]) if scope else None
                _offer_rows(best, _sortable(pdf["key"]), scopes, x, q, q_scope, slot, metric, round_first, near_q)
        yield best.frame(original)

    n_blocks = max(1, int(-(-ask_bytes // block_bytes)))
    spark = corpus.sparkSession
    if n_blocks > 1:
        asks = cut_lineage(asks)
    parts = []
    for b in range(n_blocks):
        block = asks.filter(F.pmod(F.xxhash64("question", F.lit(7)), F.lit(n_blocks)) == b).toPandas()  # about block_bytes
        if block.empty:
            continue
        shipped = spark.sparkContext.broadcast(packed(block))
        # a block only meets rows of its own scopes
        near = rows.join(F.broadcast(spark.createDataFrame([(s,) for s in block[scope].unique().tolist()], T.StructType([asks.schema[scope]]))),
                         scope, "left_semi") if scope and n_blocks > 1 else rows
        parts.append(near.mapInPandas(lambda it, q=shipped: score_rows(q.value, it), out_schema))
    candidates = parts[0] if parts else spark.createDataFrame([], out_schema)
    if n_blocks > 1:
        # merged block by block and kept, so that the plan does not grow with the questions
        candidates = cut_lineage(candidates)
        for part in parts[1:]:
            candidates = candidates.union(cut_lineage(part))

    best_first = F.desc("score") if larger_first else F.asc("score")
    ranked = Window.partitionBy("question").orderBy(best_first, F.asc("key"))
    return (
        candidates.withColumn("rank", F.row_number().over(ranked).cast("bigint"))
        .filter(F.col("rank") <= k)
        .select("question", "rank", "key", "score")
    )


# ---------------------------------------------------------------- centroids and inverted file

def mean_vectors(df: DataFrame, group, vector_col: str = "embedding") -> DataFrame:
    """Mean vector per group, summed per (group, place) so that a big group never meets in one task."""
    groups = [group] if isinstance(group, str) else list(group)
    places = df.select(*groups, F.posexplode(V.as_double(vector_col)).alias("dim", "x"))
    means = places.groupBy(*groups, "dim").agg(F.avg("x").alias("x"))
    packed = F.sort_array(F.collect_list(F.struct("dim", "x")))  # one entry per dimension
    return means.groupBy(*groups).agg(F.transform(packed, lambda s: s["x"]).alias("centroid"))


def nearest_centroids(rows: DataFrame, centroids: DataFrame, n: int = 1, *, metric: str = "cosine",
                      vector_col: str = "embedding", id_col: str = "list_id",
                      max_bytes: int = QUESTION_BYTES) -> DataFrame:
    """Add ``near``: the n nearest centroid ids with their scores, best first.

    The centroid table must fit ``max_bytes``; an inverted file has some hundred lists.
    """
    table = centroids.select(id_col, V.as_double("centroid").alias("c")).orderBy(id_col)
    size = table.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("c")).alias("d")).first()
    if size["n"] * (size["d"] or 0) * 8 > max_bytes:
        raise ValueError("centroid table is larger than a task may hold; use knn_join")
    local = table.toPandas()
    ids = local[id_col].to_numpy()
    shipped = rows.sparkSession.sparkContext.broadcast((ids, np.vstack(local["c"].to_numpy()).astype(float)))
    id_type = table.schema[id_col].dataType
    kind = T.StructType([T.StructField(id_col, id_type), T.StructField("score", T.DoubleType())])

    @F.pandas_udf(T.StructType([T.StructField("ids", T.ArrayType(id_type)), T.StructField("scores", T.ArrayType(T.DoubleType()))]))
    def near(v: pd.Series) -> pd.DataFrame:
        names, c = shipped.value
        s = _score_block(np.vstack(v.to_numpy()).astype(float), c, metric)
        order = np.argsort(-s if metric == "cosine" else s, axis=1, kind="stable")[:, :n]
        scores = np.take_along_axis(s, order, 1)
        return pd.DataFrame({"ids": list(names[order]), "scores": list(scores)})

    found = near(V.as_double(vector_col))
    pairs = F.arrays_zip(found["ids"].alias(id_col), found["scores"].alias("score"))
    return rows.withColumn("near", pairs.cast(T.ArrayType(kind)))


def build_inverted_file(corpus: DataFrame, centroids: DataFrame, *, vector_col: str = "embedding") -> DataFrame:
    """Corpus with the ``list_id`` of its nearest centroid."""
    placed = nearest_centroids(corpus, centroids, 1, vector_col=vector_col)
    return placed.withColumn("list_id", F.col("near")[0]["list_id"]).drop("near")


def write_inverted_file(ivf: DataFrame, path: str, key_col: str = "key", files_per_list: int = 8) -> None:
    """Store by list, so that probing is partition pruning; a big list becomes several files."""
    spread = F.pmod(F.xxhash64(key_col), F.lit(files_per_list))
    ivf.repartition("list_id", spread).write.mode("overwrite").partitionBy("list_id").parquet(path)


def ivf_search(ivf: DataFrame, centroids: DataFrame, questions: DataFrame, k: int, nprobe: int = 1, *,
               key_col: str = "key", vector_col: str = "embedding", question_col: str = "question",
               round_first: int | None = None) -> DataFrame:
    """Approximate k nearest: each question visits only the rows of its nearest lists."""
    asked = nearest_centroids(questions, centroids, nprobe, vector_col=vector_col)
    probes = asked.withColumn("list_id", F.explode(F.transform("near", lambda s: s["list_id"]))).drop("near")
    return knn_join(ivf, probes, k, scope="list_id", key_col=key_col, vector_col=vector_col,
                    question_col=question_col, round_first=round_first)


def kmeans_centroids(corpus: DataFrame, lists: int = 100, *, vector_col: str = "embedding",
                     seed: int = 7) -> DataFrame:
    """Learned centroids for an inverted file (cosine distance)."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    rows = corpus.select(array_to_vector(V.as_double(vector_col)).alias("features"))
    model = KMeans(k=lists, seed=seed, distanceMeasure="cosine", maxIter=10).fit(rows)
    data = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return corpus.sparkSession.createDataFrame(data, "list_id int, centroid array<double>")


def compare_results(exact: DataFrame, approximate: DataFrame) -> DataFrame:
    """Per question: shared keys, keys only one side found, largest score difference."""
    a = exact.select("question", "key", F.col("score").alias("a"))
    b = approximate.select("question", "key", F.col("score").alias("b"))
    both = a.join(b, ["question", "key"], "full_outer")
    return both.groupBy("question").agg(
        F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull()).alias("overlap"),
        F.count_if(F.col("b").isNull()).alias("exact_only"),
        F.count_if(F.col("a").isNull()).alias("approx_only"),
        F.max(F.abs(F.col("a") - F.col("b"))).alias("max_diff"),
    )


def comparison_report(exact: DataFrame, approximate: DataFrame, exact_ms: float, approx_ms: float) -> DataFrame:
    """:func:`compare_results` with both latencies, their difference and the faster back end on every row."""
    verdict = pick_winner(exact_ms, approx_ms)
    return compare_results(exact, approximate).withColumns({k: F.lit(v) for k, v in verdict.items()})


def pick_winner(exact_ms: float, approx_ms: float) -> dict[str, object]:
    """Latency comparison of two back ends; a tie goes to the exact scan."""
    winner = "exact" if exact_ms <= approx_ms else "approximate"
    return {"exact_ms": exact_ms, "approx_ms": approx_ms, "abs_diff_ms": abs(exact_ms - approx_ms),
            "winner": winner}
