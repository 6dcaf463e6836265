"""Exact k nearest neighbours that skip whole lists of rows.

Rows are stored by the nearest of some centres, with the radius of each list.  By the triangle inequality no row of a
list is nearer to a question than its distance to the centre less the radius.  A question first meets the nearest lists
that hold k rows; its k-th best there bounds the others, and only lists that may hold something as good are scored.

Rows and questions without a vector of finite numbers take no part; a vector of zeros is similar to nothing (cosine 0) and stands in a list
of its own that every question meets.  Keys and question ids are unique and not null.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from weftline.functions import vectors as V
from weftline.operators.neighbours import METRICS, _Best, _directions, _offer_rows
from weftline.session import shared_table

SAMPLE_ROWS = 10_000  # rows the centres are fitted on; every row is stored and may be found
BLOCK_BYTES = 32 << 20  # vectors of one side that are scored together in a task; every vector moves once per block of the other side
LEAST_BYTES = 2 << 20  # smaller blocks are not made for the sake of more tasks
APART = -1  # list of the vectors without a direction
_FINITE = "embedding is not null and not exists(embedding, x -> x is null or isnan(x) or abs(x) = double('infinity'))"
_SLACK = 1e-6  # covers the rounding of the bounds, relative to the distances


@dataclass
class StoredLists:
    """``rows(key, embedding, list_id)`` sorted by list, and per list its centre, radius and number of rows."""

    rows: DataFrame
    metric: str
    ids: np.ndarray
    centres: np.ndarray
    radius: np.ndarray
    n: np.ndarray


@dataclass
class Answer:
    """``result(question, rank, key, score)`` and ``visits(question, list_id, n)``: the lists scored, with their rows."""

    result: DataFrame
    visits: DataFrame
    rows: int

    def scored_share(self) -> DataFrame:
        """One row: pairs scored, all pairs, and their share (null without pairs)."""
        met = self.visits.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("scored"), F.countDistinct("question").alias("asked"))
        every = F.col("asked") * F.lit(self.rows)
        return met.select("scored", every.alias("pairs"), F.try_divide("scored", every).alias("share"))


def _as_kept(df: DataFrame, vector_col: str) -> Column:
    """Vectors as they move: single precision stays single, anything else becomes double.  All arithmetic is in double precision."""
    kind = df.select(vector_col).schema[0].dataType
    return F.col(vector_col) if kind == T.ArrayType(T.FloatType(), kind.containsNull) else V.as_double(vector_col)


def _placed(v: pd.Series, metric: str) -> tuple[np.ndarray, np.ndarray]:
    """Vectors in the space of the bounds (unit vectors for cosine), and which of them have no place there."""
    x = np.vstack(v.to_numpy()).astype(float)
    if metric != "cosine":
        return x, np.zeros(len(x), bool)
    length = np.linalg.norm(x, axis=1)
    return x / np.where(length > 0, length, 1.0)[:, None], length == 0


def _distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Distances by differences, a centre at a time: the expanded square loses digits."""
    out = np.empty((len(x), len(c)))
    for j in range(len(c)):
        d = x - c[j]
        out[:, j] = np.sqrt(np.einsum("ij,ij->i", d, d))
    return out


def _fit(sample: np.ndarray, lists: int, rounds: int = 8) -> np.ndarray:
    """Centres: each next one is the row farthest from those before, then some rounds of means."""
    centres = sample[:1]
    near = _distances(sample, centres)[:, 0]
    while len(centres) < min(lists, len(sample)) and near.max() > 0:
        centres = np.vstack([centres, sample[near.argmax()]])
        near = np.minimum(near, _distances(sample, centres[-1:])[:, 0])
    for _ in range(rounds):
        home = _distances(sample, centres).argmin(1)
        size = np.bincount(home, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, home, sample)
        centres = np.where(size[:, None] > 0, sums / np.maximum(1, size)[:, None], centres)
    return centres


def store_lists(corpus: DataFrame, lists: int = 64, *, metric: str = "cosine", key_col: str = "key", vector_col: str = "embedding",
                sample: int = SAMPLE_ROWS, where: str | None = None) -> StoredLists:
    """Store the rows by list.  A large list becomes several files, because the table is cut by list and key."""
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    rows = corpus.select(F.col(key_col).alias("key"), _as_kept(corpus, vector_col).alias("embedding")).filter(_FINITE)
    drawn = rows.orderBy(F.xxhash64("key"), "key").limit(sample).select("embedding").toPandas()["embedding"]
    x, apart = _placed(drawn, metric) if len(drawn) else (np.zeros((0, 1)), np.zeros(0, bool))
    centres = _fit(x[~apart], lists) if (~apart).any() else np.zeros((1, x.shape[1]))
    shipped = corpus.sparkSession.sparkContext.broadcast(centres)  # at most `lists` vectors

    @F.pandas_udf("struct<list_id:int,far:double>")
    def place(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for v in batches:
            if not len(v):
                yield pd.DataFrame({"list_id": [], "far": []})
                continue
            x, apart = _placed(v, metric)
            d = _distances(x, shipped.value)
            home = d.argmin(1)
            yield pd.DataFrame({"list_id": np.where(apart, APART, home), "far": np.where(apart, np.inf, d[np.arange(len(x)), home])})

    placed = rows.withColumn("_p", place("embedding")).select("key", "embedding", "_p.list_id", "_p.far")
    stored = shared_table(placed.repartitionByRange("list_id", "key").sortWithinPartitions("list_id", "key"), "lists", where)
    stats = stored.groupBy("list_id").agg(F.max("far").alias("r"), F.count(F.lit(1)).alias("n")).orderBy("list_id").toPandas()  # a row per list
    ids = stats["list_id"].to_numpy(int)
    middle = np.where((ids == APART)[:, None], 0.0, centres[np.maximum(ids, 0)]) if len(ids) else centres[:0]
    return StoredLists(stored.drop("far"), metric, ids, middle, stats["r"].to_numpy(float), stats["n"].to_numpy(int))


def _blocks(n: np.ndarray, per: int) -> tuple[list[int], list[int]]:
    """First block and number of blocks of each list: lists up to ``per`` rows are packed together, larger ones are cut."""
    first, count = [], []
    block, used = 0, 0
    for size in n.tolist():
        if used and used + size > per:
            block, used = block + 1, 0
        first.append(block)
        count.append(max(1, -(-size // per)))
        if size > per:
            block += count[-1]
        else:
            used += size
    return first, count


def _block_rows(n: int, width: int, block_bytes: int, cores: int) -> int:
    """Rows of a block: as many as a task may hold, fewer if that leaves less than four cells for each core."""
    side = math.ceil(math.sqrt(4 * cores))
    return max(1, min(block_bytes // width, max(LEAST_BYTES // width, -(-n // side))))


def _matrix(vectors: pa.ChunkedArray) -> np.ndarray:
    """Vectors in double precision, read from Arrow's buffer and not row by row."""
    flat, n = pc.list_flatten(vectors).to_numpy(), len(vectors)
    width = len(flat) // n
    if pc.any(pc.not_equal(pc.list_value_length(vectors), width)).as_py():
        raise ValueError("vectors of different lengths")
    return flat.reshape(n, width).astype(float)


def _score_cells(lists: StoredLists, probes: DataFrame, k: int, round_first: int | None, block_bytes: int) -> DataFrame:
    """The k best rows of each cell for ``probes(question, embedding, lists, edge)``, of the named lists only: (question, key, score).

    Rows worse than ``edge``, a score, are left out (null: none is).  A cell is one block of rows and one part of the
    questions that ask for it.
    """
    metric, spark = lists.metric, lists.rows.sparkSession
    width = 8 * max(1, lists.centres.shape[1]) + 64
    per = _block_rows(int(lists.n.sum()), width, block_bytes, spark.sparkContext.defaultParallelism)
    first, count = (np.zeros(int(lists.ids.max()) - APART + 1, int) for _ in range(2))  # by list, also those without rows
    first[lists.ids - APART], count[lists.ids - APART] = _blocks(lists.n, per)

    def of(table, place):
        return F.get(F.array(*[F.lit(int(x)) for x in table]), place)

    def begin(i):
        return of(first, i - APART)

    def end(i):
        return of(first + count, i - APART)

    span = F.array_distinct(F.flatten(F.transform("lists", lambda i: F.sequence(begin(i), end(i) - 1))))
    parts = np.zeros(int((first + count).max()), int)
    for block, n in probes.select(F.explode(span).alias("block")).groupBy("block").count().collect():  # a row per block
        parts[block] = -(-n // per)
    start, cells = np.cumsum(parts) - parts, max(1, int(parts.sum()))
    part = F.pmod(F.xxhash64("question", F.lit(7)), of(parts, F.col("block"))).cast("int")
    own = F.filter("lists", lambda i: (begin(i) <= F.col("block")) & (F.col("block") < end(i)))
    asks = probes.withColumn("block", F.explode(span)).select(
        "question", "embedding", "edge", own.alias("lists"), (of(start, F.col("block")) + part).alias("cell"))
    home = begin(F.col("list_id")) + F.pmod(F.xxhash64("key"), end(F.col("list_id")) - begin(F.col("list_id"))).cast("int")
    rows = lists.rows.withColumn("block", home).filter(of(parts, F.col("block")) > 0)  # blocks that nobody asks for stay behind
    rows = rows.select("key", "embedding", "list_id", F.explode(F.sequence(
        of(start, F.col("block")), of(start + parts, F.col("block")) - 1)).alias("cell"))
    schema = T.StructType([T.StructField("question", probes.schema["question"].dataType),
                           T.StructField("key", lists.rows.schema["key"].dataType), T.StructField("score", T.DoubleType())])

    def score(asked: pa.Table, stored: pa.Table) -> pa.Table:
        best, order = _Best(asked.num_rows, k, metric == "cosine"), np.zeros(0, int)
        if asked.num_rows and stored.num_rows:
            order = pc.sort_indices(stored["key"], null_placement="at_start").to_numpy()
            place = np.empty(len(order), int)  # stands for the key, whatever its type
            place[order] = np.arange(len(order))
            q, x, home = _matrix(asked["embedding"]), _matrix(stored["embedding"]), stored["list_id"].to_numpy()
            near = _directions(q) if metric == "cosine" else None
            edge = asked["edge"].to_pandas().to_numpy(float)
            best.edge = np.where(np.isnan(edge), np.inf, best.sign * edge)
            wanted, who = pc.list_flatten(asked["lists"]).to_numpy(), pc.list_parent_indices(asked["lists"]).to_numpy()
            for i in np.unique(home).tolist():
                rows_i, slots = np.flatnonzero(home == i), who[wanted == i]
                if len(slots):
                    _offer_rows(best, place[rows_i], None, x[rows_i], q[slots], None, slots, metric, round_first,
                                near and (near[0][slots], near[1][slots]))
        had = np.arange(k) < best.n[:, None]
        keys = order[best.keys[had]] if best.keys is not None else order[:0]
        return pa.table({"question": asked["question"].take(pa.array(np.repeat(np.arange(len(best.n)), best.n))),
                         "key": stored["key"].take(pa.array(keys)), "score": best.sign * best.cost[had]})

    tasks = 3 * cells  # so that few tasks get two cells
    return asks.repartition(tasks, "cell").groupBy("cell").cogroup(rows.repartition(tasks, "cell").groupBy("cell")).applyInArrow(score, schema)


def _best_of(hits: DataFrame, k: int, metric: str) -> DataFrame:
    best = F.desc("score") if metric == "cosine" else F.asc("score")
    ranked = Window.partitionBy("question").orderBy(best, F.asc("key"))
    return hits.withColumn("rank", F.row_number().over(ranked).cast("bigint")).filter(F.col("rank") <= k)


def pruned_knn(lists: StoredLists, questions: DataFrame, k: int, *, question_col: str = "question", vector_col: str = "embedding",
               round_first: int | None = None, block_bytes: int = BLOCK_BYTES) -> Answer:
    """The rows :func:`weftline.operators.neighbours.knn_join` gives, from the lists that may hold them."""
    spark, metric = lists.rows.sparkSession, lists.metric
    shipped = spark.sparkContext.broadcast((lists.ids, lists.centres, lists.radius, lists.n))
    asks = questions.select(F.col(question_col).alias("question"), _as_kept(questions, vector_col).alias("embedding")).filter(_FINITE)

    def nearest_possible(v: pd.Series) -> tuple[np.ndarray, np.ndarray]:
        """Least distance a row of each list can have, and the distance by which lists are tried first."""
        _, centres, radius, _ = shipped.value
        x, apart = _placed(v, metric)
        d = _distances(x, centres)
        least = d - radius - _SLACK * (1 + d + np.where(np.isfinite(radius), radius, 0))
        least[apart] = -np.inf  # such a question is equally similar to every row
        return least, d

    @F.pandas_udf("array<int>")
    def first_lists(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        ids, _, radius, n = shipped.value
        for v in batches:
            out = []
            if len(v):
                least, d = nearest_possible(v)
                order = np.argsort(np.where(np.isfinite(radius), d, np.inf), axis=1, kind="stable")
                enough = (np.cumsum(n[order], axis=1) < k).sum(1) + 1
                out = [ids[o[:m]].tolist() for o, m in zip(order, enough)]
            yield pd.Series(out, dtype=object)

    @F.pandas_udf("array<int>")
    def further_lists(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        ids = shipped.value[0]
        for v, bound, had in batches:
            out = []
            if len(v):
                least, _ = nearest_possible(v)
                may = least <= bound.fillna(np.inf).to_numpy(float)[:, None]
                for m, h in zip(may, had):
                    m[np.searchsorted(ids, h)] = False
                out = [ids[m] for m in may]
            yield pd.Series(out, dtype=object)

    if not len(lists.ids):
        key = lists.rows.schema["key"].dataType
        nothing = asks.limit(0).select("question", F.lit(0).cast("bigint").alias("rank"), F.lit(None).cast(key).alias("key"),
                                       F.lit(0.0).alias("score"))
        return Answer(nothing, nothing.select("question", F.lit(0).alias("list_id"), F.col("rank").alias("n")), 0)

    def score(probes: DataFrame, names: str, edge: Column) -> DataFrame:
        return _score_cells(lists, probes.select("question", "embedding", F.col(names).alias("lists"), edge.alias("edge")), k, round_first, block_bytes)

    begun = shared_table(asks.withColumn("had", first_lists("embedding")), "questions")
    seen = shared_table(_best_of(score(begun, "had", F.lit(None).cast("double")), k, metric).drop("rank"), "first-hits")
    worst = F.min("score") if metric == "cosine" else F.max("score")
    edge = F.col("edge")
    lenient = 0.0 if round_first is None else 10.0 ** -round_first  # rows that round to the same score count as ties
    if metric == "cosine":  # |a - b|^2 = 2 - 2 cos for unit vectors
        distance = F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * (edge - lenient)) + 1e-12)
    elif metric == "l2":
        distance = edge + lenient
    else:
        distance = F.sqrt(edge + lenient)
    bounds = seen.groupBy("question").agg(worst.alias("edge"), F.count(F.lit(1)).alias("n")).filter(F.col("n") >= k).select(
        "question", "edge", distance.alias("bound"))
    more = begun.join(bounds, "question", "left").withColumn("more", further_lists("embedding", "bound", "had"))
    more = shared_table(more.select("question", "embedding", "edge", "had", "more"), "visits")
    result = _best_of(seen.unionByName(score(more, "more", edge)), k, metric).select("question", "rank", "key", "score")
    sizes = spark.createDataFrame(list(zip(lists.ids.tolist(), lists.n.tolist())), "list_id int, n bigint")
    visits = more.select("question", F.explode(F.concat("had", "more")).alias("list_id")).join(F.broadcast(sizes), "list_id")
    return Answer(result, visits.select("question", "list_id", "n"), int(lists.n.sum()))
