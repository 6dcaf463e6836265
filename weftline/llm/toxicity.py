"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier over hashed words and word beginnings learns from confirmed toxic texts
and from unlabelled texts of unknown kind.  Its risk estimate is corrected by the class
prior: with the logistic loss l, positives P, unlabelled U and prior q,

    risk = q * E_P[l(+)] + max(0, E_U[l(-)] - q * E_P[l(-)]).

While the bracket is negative its gradient is turned round, which keeps the classifier from
explaining single texts.  The prior is the share of toxic rows among the training labels;
no text counts as a negative example.

Training reads at most ``max_positive`` and ``max_unlabelled`` texts, chosen by a hash of the
text (documented parameters).  Scoring reads every text whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm import words as W
from weftline.llm.features import Vocabulary, distinct_features, row_sums, sigmoid

THRESHOLD = 0.7


@dataclass
class ToxicityModel:
    vocabulary: Vocabulary
    weights: np.ndarray
    bias: float
    prior: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        row, col, _ = self.vocabulary.rows(texts)
        return sigmoid(row_sums(row, self.weights[col], len(texts)) + self.bias)


def is_held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _feature_rows(df: DataFrame, extra: list[str]) -> DataFrame:
    def features(texts: pa.Array) -> list[pa.Array]:
        h, sizes = distinct_features(texts)
        return [W.list_array(h.view(np.int64), sizes, pa.int64())]

    return W.text_map(df, "text", extra, features, "features array<bigint>").select("row.*", "features")


def select_features(positive: list[np.ndarray], other: list[np.ndarray], most: int, least: int) -> np.ndarray:
    """Features clearly commoner in positives: by the lower end (three deviations) of their log ratio, at most ``most``."""
    hp, cp = np.unique(np.concatenate(positive), return_counts=True)
    keep = cp >= least
    hp, cp = hp[keep], cp[keep]
    ho, co = np.unique(np.concatenate(other), return_counts=True) if other else (np.zeros(0, np.uint64), np.zeros(0, int))
    spot = np.minimum(np.searchsorted(ho, hp), max(0, len(ho) - 1))
    found = np.where(ho[spot] == hp, co[spot], 0) if len(ho) else np.zeros(len(hp), int)
    a, b = (cp + 0.1) / (len(positive) + 0.2), (found + 0.1) / (len(other) + 0.2)
    bound = np.log(a / b) - 3.0 * np.sqrt(1 / (cp + 0.1) + 1 / (found + 1.0))
    order = np.lexsort((hp, -bound))
    order = order[bound[order] > 0.0][:most]
    return hp[order]


def fit_nnpu(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, most: int = 1500,
             steps: int = 800, rate: float = 0.05, decay: float = 0.01) -> ToxicityModel:
    """Fit the linear classifier on sorted distinct feature hashes of each text."""
    prior = float(min(0.9, max(0.005, prior)))
    start = float(np.log(prior / (1 - prior)))
    if not positive or not unlabelled:
        return ToxicityModel(Vocabulary(np.zeros(0, np.uint64)), np.zeros(0), start, prior)
    vocabulary = Vocabulary(select_features(positive, unlabelled, most, max(2, len(positive) // 100)))

    def matrix(texts):
        at, col = vocabulary.places(np.concatenate(texts))
        return np.repeat(np.arange(len(texts)), [len(t) for t in texts])[at], col

    rp, cp = matrix(positive)
    ru, cu = matrix(unlabelled)
    n_p, n_u, n_f = len(positive), len(unlabelled), len(vocabulary.hashes)
    theta = np.zeros(n_f + 1)
    theta[-1] = start
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        zp = row_sums(rp, theta[cp], n_p) + theta[-1]
        zu = row_sums(ru, theta[cu], n_u) + theta[-1]
        sp, su = sigmoid(zp), sigmoid(zu)
        # derivatives of l(+) and l(-) by the score are s - 1 and s
        gp = prior * (sp - 1) / n_p
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        if negative >= 0:
            gp, gu = gp - prior * sp / n_p, su / n_u
        else:
            gp, gu = prior * sp / n_p, -su / n_u
        grad = np.empty_like(theta)
        grad[:-1] = np.bincount(cp, gp[rp], minlength=n_f) + np.bincount(cu, gu[ru], minlength=n_f)
        grad[-1] = gp.sum() + gu.sum()
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        # weak features end at exactly nothing
        theta[:-1] = np.sign(theta[:-1]) * np.maximum(0, np.abs(theta[:-1]) - rate * decay)
    # texts without any known feature must stay below the prior, whatever the optimiser left in the bias
    return ToxicityModel(vocabulary, theta[:-1], min(float(theta[-1]), start), prior)


def train(docs: DataFrame, labels: DataFrame, max_positive: int = 3000, max_unlabelled: int = 6000) -> ToxicityModel:
    """Fit on confirmed toxic documents (``labels.toxic`` = 1) and unlabelled ones.

    Rows with a null id and rows held out by :func:`is_held_out` take no part.  Of contradictory
    or repeated labels of one id the largest counts.  Without any positive text the model gives
    one constant low score.
    """
    docs = docs.select("doc_id", "text").filter(F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id")))
    marks = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~is_held_out(F.col("doc_id"))) \
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = marks.agg(F.avg(F.col("toxic").cast("double")).alias("q")).first()["q"]
    # ids are chosen first, so that only the chosen texts move; both choices are bounded, hence the copies
    ids = docs.select("doc_id", F.xxhash64(F.lit(7), "text").alias("h"))

    def chosen(rows: DataFrame, most: int) -> DataFrame:
        return docs.join(F.broadcast(rows.orderBy("h", "doc_id").limit(most).select("doc_id")), "doc_id", "left_semi")

    confirmed = chosen(ids.join(marks.filter("toxic = 1").select("doc_id"), "doc_id"), max_positive)
    unlabelled = chosen(ids, max_unlabelled)

    def collect(df):
        rows = _feature_rows(df, ["doc_id"]).toArrow()
        lists = rows.column("features").combine_chunks()
        flat = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        sizes = np.diff(lists.offsets.to_numpy()) if len(lists) else []
        parts = np.split(flat, np.cumsum(sizes)[:-1]) if len(sizes) else []
        ids = rows.column("doc_id").to_pylist()
        return [parts[i] for i in sorted(range(len(ids)), key=ids.__getitem__)]

    return fit_nnpu(collect(confirmed), collect(unlabelled), share or 0.0)


def score(docs: DataFrame, model: ToxicityModel, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Rows ``(row, score)`` for every whole text.

    Null and empty texts get the score of a text without known words.  Equal texts get equal
    scores; nothing but the text enters.  An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most `most` features

    def scores(texts: pa.Array) -> list[pa.Array]:
        return [pa.array(shared.value.scores(texts), pa.float64())]

    return W.text_map(docs, text, carry, scores, "score double")
