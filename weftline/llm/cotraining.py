"""Text quality by co-training two views.

The content view sees what a text says and how (character classes, repetition of words and lines,
word lengths); the metadata view sees what is known about it (language, source, length, layout).
Each view has boosted trees of its own.  In every round each view labels the unlabelled texts
it is surest about, and they join the other view's training set.  Both views are then calibrated
on labelled texts kept aside, and their log odds are added (less the prior, which both
contain) to score every document.

Training reads at most ``max_labelled`` and ``max_unlabelled`` rows, chosen by a hash of the id.
Features of all documents come from whole texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm import words as W
from weftline.llm.boosting import BoostedTrees, fit
from weftline.llm.toxicity import is_held_out

_byte = np.arange(256)
#: byte classes whose shares are content features
CLASSES = {
    "letter": ((_byte | 32) >= 97) & ((_byte | 32) <= 122) | (_byte >= 128), "upper": (_byte >= 65) & (_byte <= 90),
    "digit": (_byte >= 48) & (_byte <= 57), "stop": np.isin(_byte, list(b".,;:")), "loud": np.isin(_byte, list(b"!?")),
    "symbol": np.isin(_byte, list(b"#$%&*+<=>@[\\]^_`{|}~/")), "space": _byte == 32,
}
NOT_LINE_FEED = _byte != 10
CONTENT = (*CLASSES, "distinct_words", "top_word", "distinct_lines", "word_length", "short_words", "long_words", "distinct_prefixes")
METADATA = ("declared", "size", "lines", "line_length", "words_per_line", "lang", "source", "lang2", "source2")
N_CONTENT, N_METADATA = len(CONTENT), len(METADATA)


def _distinct_share(doc: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Share of distinct values, and of the commonest value, per text."""
    total = np.bincount(doc, minlength=n)
    if not len(h):
        return np.ones(n), np.zeros(n)
    order = np.lexsort((h, doc))
    d, v = doc[order], h[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (d[1:] != d[:-1])
    at = np.flatnonzero(new)
    run = np.diff(np.append(at, len(v)))
    most = np.zeros(n)
    np.maximum.at(most, d[at], run)
    return np.bincount(d[at], minlength=n) / np.maximum(1, total), most / np.maximum(1, total)


def content_view(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Content features, and bytes and words per text."""
    n = len(texts)
    w = W.words(texts, W.NOT_SPACE, W.LOWER_CASE)
    data, offs = W.buffers(texts)
    size, count, doc = np.diff(offs), w.counts, w.text_of_word()
    cols = []
    for members in CLASSES.values():
        upto = np.concatenate([[0], np.cumsum(members[data], dtype=np.int64)])
        cols.append((upto[offs[1:]] - upto[offs[:-1]]) / np.maximum(1, size))
    distinct, top = _distinct_share(doc, w.hash, n)
    lines = W.words(texts, NOT_LINE_FEED)
    distinct_lines, _ = _distinct_share(lines.text_of_word(), lines.hash, n)
    length = (w.end - w.start).astype(float)
    mean = lambda v: np.bincount(doc, v, n) / np.maximum(1, count)
    prefixes, _ = _distinct_share(doc, w.prefixes(3), n)
    cols += [distinct, top, distinct_lines, mean(length), mean(length <= 3), mean(length >= 15), prefixes]
    return np.stack(cols, 1), size, count


def metadata_view(texts: pa.Array, lang: pa.Array, source: pa.Array, declared: pa.Array) -> np.ndarray:
    """Metadata features; a null language or source has a bucket of its own, a null length counts as 0."""
    _, offs = W.buffers(texts)
    lines = W.words(texts, NOT_LINE_FEED).counts
    words = W.words(texts).counts
    size = np.diff(offs)

    def bucket(values: pa.Array, buckets: int) -> np.ndarray:
        names = W.words(pa.array([f"{v}".replace("\n", " ") + "." for v in values.to_pylist()], pa.string()), NOT_LINE_FEED).hash
        return (names % np.uint64(buckets)).astype(float)

    said = np.array([v or 0 for v in declared.to_pylist()], float)
    return np.stack([np.log1p(np.maximum(0, said)), np.log1p(size), np.log1p(lines), np.log1p(size / np.maximum(1, lines)),
                     np.log1p(words / np.maximum(1, lines)), bucket(lang, 31), bucket(source, 31), bucket(lang, 7), bucket(source, 7)], 1)


@dataclass
class View:
    trees: BoostedTrees
    slope: float = 1.0
    shift: float = 0.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.slope * self.trees.margin(x) + self.shift

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """Platt scaling by Newton steps; kept as it is when one class is missing."""
        if len(np.unique(y)) < 2:
            return
        z = self.trees.margin(x)
        target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
        ab = np.array([1.0, 0.0])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(ab[0] * z + ab[1], -30, 30)))
            g = np.array([((p - target) * z).sum() + 1e-3 * (ab[0] - 1), (p - target).sum()])
            v = p * (1 - p)
            h = np.array([[(v * z * z).sum() + 1e-3, (v * z).sum()], [(v * z).sum(), v.sum() + 1e-6]])
            ab = ab - np.clip(np.linalg.solve(h, g), -2, 2)
        if ab[0] > 0:
            self.slope, self.shift = float(ab[0]), float(ab[1])


@dataclass
class QualityModel:
    content: View
    metadata: View
    prior: float

    def scores(self, content: np.ndarray, metadata: np.ndarray) -> np.ndarray:
        z = self.content.margin(content) + self.metadata.margin(metadata) - np.log(self.prior / (1 - self.prior))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def constant_model() -> QualityModel:
    """What is known without labels: every score is one half."""
    flat = [View(BoostedTrees([np.zeros(0)] * n, np.zeros((0, 1), np.int64), np.zeros((0, 1), np.int64), np.zeros((0, 2)), 0.0))
            for n in (N_CONTENT, N_METADATA)]
    return QualityModel(*flat, 0.5)


def co_train(content: np.ndarray, metadata: np.ndarray, y: np.ndarray, more_content: np.ndarray, more_metadata: np.ndarray,
             rounds: int = 4, step: float = 0.05, sure: float = 0.9, trees: int = 25) -> QualityModel:
    """Fit both views on labels ``y`` and exchange pseudo-labels for the further rows.

    Each round a view hands over at most ``step`` of the further rows, in the classes' proportion,
    and only rows whose class it gives at least ``sure``.  Without labels the model is :func:`constant_model`.
    """
    prior = float(np.clip(y.mean() if len(y) else 0.5, 0.02, 0.98))
    aside = np.arange(len(y)) % 4 == 3
    views = [content, metadata]
    train = [(x[~aside], y[~aside].astype(float)) for x in views]
    pool = [more_content, more_metadata]
    free = [np.ones(len(more_content), bool) for _ in views]
    if not len(y):
        return constant_model()
    models = [fit(x, t, trees, 3) for x, t in train]
    for _ in range(rounds if len(more_content) else 0):
        handed = []
        for k, model in enumerate(models):
            p = 1 / (1 + np.exp(-model.margin(pool[k])))
            room = max(2, int(step * len(p)))
            order = np.argsort(p, kind="stable")
            order = order[free[1 - k][order]]
            low, high = order[:max(1, int(room * (1 - prior)))], order[::-1][:max(1, int(room * prior))]
            handed.append((np.concatenate([low[p[low] <= 1 - sure], high[p[high] >= sure]]), p))
        for k, (rows, p) in enumerate(handed):
            other = 1 - k
            free[other][rows] = False
            x, t = train[other]
            train[other] = (np.concatenate([x, pool[other][rows]]), np.concatenate([t, (p[rows] > 0.5).astype(float)]))
        models = [fit(x, t, trees, 3) for x, t in train]
    done = [View(m) for m in models]
    for view, x in zip(done, views):
        view.calibrate(x[aside], y[aside].astype(float))
    return QualityModel(*done, prior)


def _views(df: DataFrame, carry: list[str], finish, fields: str) -> DataFrame:
    """Run ``finish(content, metadata)`` on bounded slices of ``documents``-like rows."""
    from pyspark.sql.types import StructType

    W.small_batches(df)
    pick = lambda c, kind: (W.column(c) if c in df.columns else F.lit(None)).cast(kind).alias(c)
    packed = df.select(F.struct(*[W.column(c) for c in carry]).alias("row"), pick("text", "string"), pick("lang", "string"),
                       pick("source", "string"), pick("n_chars", "bigint"))
    schema = StructType([packed.schema["row"], *StructType.fromDDL(fields).fields])

    def run(batches):
        for batch in batches:
            for part in W.slices(batch):
                x, _, _ = content_view(part.column("text"))
                m = metadata_view(part.column("text"), part.column("lang"), part.column("source"), part.column("n_chars"))
                yield pa.RecordBatch.from_arrays([part.column("row"), *finish(x, m)], schema.names)

    return packed.mapInArrow(run, schema)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", max_labelled: int = 6000, max_unlabelled: int = 12000) -> QualityModel:
    """Fit on a bounded sample of labelled documents (none of the held-out third) and of unlabelled ones.

    Of contradictory or repeated labels of one id the smallest counts; null ids and labels take no part.  Of rows that
    repeat an id one is taken, the same in every run.  Without labelled documents every score will be one half.
    """
    marks = labels.select("doc_id", W.column(label).alias("y")).dropna().groupBy("doc_id").agg(F.min("y").alias("y"))
    used = [W.column(c) for c in ("text", "lang", "source", "n_chars") if c in docs.columns]
    docs = docs.filter(F.col("doc_id").isNotNull()).select("doc_id", *used)
    order = F.xxhash64(F.lit(3), "doc_id"), F.col("doc_id")
    known = marks.filter(~is_held_out(F.col("doc_id"))).orderBy(*order).limit(max_labelled)
    ids = docs.select("doc_id").join(marks.select("doc_id"), "doc_id", "left_anti")
    other = ids.filter(~is_held_out(F.col("doc_id"))).orderBy(*order).limit(max_unlabelled)
    chosen = known.unionByName(other.withColumn("y", F.lit(-1).cast(dict(known.dtypes)["y"])))

    def flat(x, m):
        return [W.list_array(x.ravel(), np.full(len(x), N_CONTENT), pa.float64()), W.list_array(m.ravel(), np.full(len(m), N_METADATA), pa.float64())]

    picked = docs.join(F.broadcast(chosen), "doc_id")  # at most max_labelled + max_unlabelled ids
    picked = picked.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64(*used).alias("h"), "y", *used)).alias("r")).select("doc_id", "r.*")
    rows = _views(picked, ["doc_id", "y"], flat, "x array<double>, m array<double>").select("row.*", "x", "m").toPandas()
    rows = rows.sort_values("doc_id", ignore_index=True)
    if not (rows["y"] >= 0).any():
        return constant_model()
    x, m, y = np.stack(rows["x"]), np.stack(rows["m"]), rows["y"].to_numpy()
    k = y >= 0
    return co_train(x[k], m[k], y[k], x[~k], m[~k])


def score(docs: DataFrame, model: QualityModel, carry: list[str] | None = None) -> DataFrame:
    """Rows ``(row, score, content_score, metadata_score)`` for every whole document.

    Null and empty texts are scored as texts without characters; missing metadata columns count as null.
    Repeated rows give repeated results; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed number of small trees

    def finish(x, m):
        q = shared.value
        one = lambda z: pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))), pa.float64())
        return [pa.array(q.scores(x, m), pa.float64()), one(q.content.margin(x)), one(q.metadata.margin(m))]

    return _views(docs, docs.columns if carry is None else carry, finish, "score double, content_score double, metadata_score double")
