"""Places where a caller's own model plugs in.

Each plug takes a *factory*: it runs once per Python worker and returns the callable that
handles one batch, so a model is loaded once and not per row.  Every plug has a default
that needs no model.
"""

from __future__ import annotations

import hashlib
import re
import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from weftline.functions import text as X
from weftline.functions import vectors as V

HASH_DIMS = 16
KEPT_TOKENS = 200_000  # distinct tokens whose bucket a worker remembers
SLICE_BYTES, SLICE_ROWS = 1 << 20, 2_000  # values that are Python objects at the same time


def hash_embedding(text: Column | str, dims: int = HASH_DIMS) -> Column:
    """Default embedder: token counts in ``dims`` md5 buckets, scaled to length one.

    Each distinct token of a batch is hashed once, and one pass counts all buckets.
    """
    words = X.word_tokens(F.lower(F.col(text) if isinstance(text, str) else text))

    @F.arrow_udf("array<double>")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kept: dict[str, int] = {}
        for batch in batches:
            for part in slices(batch):
                n = pc.fill_null(pc.list_value_length(part), 0).to_numpy(zero_copy_only=False)
                slots = []
                for t in _objects(part.flatten()):
                    slot = kept.get(t)
                    if slot is None:
                        slot = kept[t] = int(hashlib.md5(t.encode()).hexdigest()[:4], 16) % dims
                    slots.append(slot)
                place = np.repeat(np.arange(len(part)) * dims, n) + np.array(slots, dtype=np.int64)
                counts = np.bincount(place, minlength=len(part) * dims).reshape(-1, dims).astype(float).tolist()
                yield pa.array([c if ok else None for c, ok in zip(counts, part.is_valid().to_pylist())], pa.list_(pa.float64()))
                if len(kept) > KEPT_TOKENS:
                    kept.clear()

    return V.unit(count(words))


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """Cut a column so that each part has at most ``limit`` bytes of values, or one row; only a part becomes Python objects.

    Arrow's batches have as many rows as fit its own bounds, so their objects would follow the size of the splits.
    """
    if pa.types.is_list(column.type) or pa.types.is_large_list(column.type):
        width = pc.multiply(pc.list_value_length(column), 64 if pa.types.is_string(column.type.value_type) else 8)
    else:
        width = pc.binary_length(column)
    total = np.cumsum(pc.fill_null(width, 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(total):
        stop = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + limit, "right")))
        stop = min(stop, at + SLICE_ROWS)
        yield column.slice(at, stop - at)
        at = stop


def _objects(part: pa.Array) -> list:
    """Python values of a slice; numbers of lists leave Arrow together and not one by one."""
    if not pa.types.is_list(part.type):
        return part.to_numpy(zero_copy_only=False).tolist() if pa.types.is_string(part.type) else part.to_pylist()
    flat = part.flatten()
    values = flat.to_pylist() if flat.null_count else flat.to_numpy(zero_copy_only=False).tolist()
    n = pc.list_value_length(part)
    ends = np.cumsum(pc.fill_null(n, 0).to_numpy(zero_copy_only=False)).tolist()
    return [values[a:b] if ok else None for a, b, ok in zip([0, *ends], ends, n.is_valid().to_pylist())]


def _batched(factory: Callable[[], Callable], kind: T.DataType | str):
    made = to_arrow_type(T._parse_datatype_string(kind) if isinstance(kind, str) else kind)

    @F.arrow_udf(kind)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fn = factory()
        for batch in batches:
            for part in slices(batch):
                yield pa.array(list(fn(_objects(part))), made, from_pandas=True)

    return run


def embed(text: Column | str, factory: Callable | None = None, dims: int = HASH_DIMS) -> Column:
    """Text to vector; ``factory() -> (list[str] -> list[list[float]])``."""
    if factory is None:
        return hash_embedding(text, dims)
    return _batched(factory, "array<double>")(text)


def token_count(text: Column | str, factory: Callable | None = None) -> Column:
    """Number of tokens; ``factory() -> (list[str] -> list[int])``, default the word tokenizer."""
    if factory is None:
        return F.size(X.word_tokens(F.col(text) if isinstance(text, str) else text)).cast("bigint")
    return _batched(factory, "bigint")(text)


def encode_subwords(text: Column | str, factory: Callable) -> Column:
    """Token ids from a caller's sub-word tokenizer; ``factory() -> (list[str] -> list[list[int]])``."""
    return _batched(factory, "array<int>")(text)


def decode_subwords(ids: Column | str, factory: Callable) -> Column:
    return _batched(factory, "string")(ids)


def score(text: Column | str, factory: Callable) -> Column:
    """Number per text; ``factory() -> (list[str] -> list[float])``."""
    return _batched(factory, "double")(text)


def lexicon_score(text: Column | str, lexicon: dict[str, float]) -> Column:
    """Default scorer: mean weight of the words found in a small lexicon, 0 when none is."""
    shared = _shared(lexicon)
    space = re.compile(r"[ \t\n\x0b\f\r]+")  # what X.split_words splits at

    @F.arrow_udf("double")
    def mean(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = shared.value
        for batch in batches:
            for part in slices(batch):
                hits = [None if t is None else [table[w] for w in space.split(t) if w and w in table] for t in _objects(part)]
                yield pa.array([None if h is None else sum(h) / len(h) if h else 0.0 for h in hits], pa.float64(), from_pandas=True)

    return mean(F.lower(F.col(text) if isinstance(text, str) else text))


def _shared(table: dict):
    """A dictionary sent to every worker once, looked up by hash; it is the caller's own object, so its size is known."""
    from pyspark import SparkContext

    return SparkContext.getOrCreate().broadcast(table)


def generate(df: DataFrame, prompt_col: str, factory: Callable, out: str = "answer") -> DataFrame:
    """Prompts to texts: ``factory() -> (list[str] -> list[str])``.

    Only a failed batch is repeated prompt by prompt; a failing prompt fills ``<out>_error`` and leaves
    the job running.  ``<out>_ms`` is the time per prompt in milliseconds.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.StringType()),
                           T.StructField(f"{out}_error", T.StringType()), T.StructField(f"{out}_ms", T.DoubleType())])

    def run(batches):
        fn = factory()

        def singly(prompt):
            begin = time.perf_counter()
            try:
                return fn([prompt])[0], None, 1000 * (time.perf_counter() - begin)
            except Exception as e:  # the error is data here
                return None, f"Error: {e}", 1000 * (time.perf_counter() - begin)

        for pdf in batches:
            prompts = pdf[prompt_col].tolist()
            begin = time.perf_counter()
            try:
                texts = list(fn(prompts))
                if len(texts) != len(prompts):
                    raise ValueError("the generator must answer every prompt")
                each = 1000 * (time.perf_counter() - begin) / max(1, len(prompts))
                answers = [(t, None, each) for t in texts]
            except Exception:
                answers = [singly(p) for p in prompts]
            yield pdf.assign(**{k: [a[i] for a in answers] for i, k in enumerate((out, f"{out}_error", f"{out}_ms"))})

    return df.mapInPandas(run, schema)


def annotate(df: DataFrame, text_col: str, factory: Callable, out: str = "entities") -> DataFrame:
    """Entity spans from a caller's annotator: ``factory() -> (list[str] -> list[list[(text, label)]])``."""
    kind = T.ArrayType(T.StructType([T.StructField("text", T.StringType()), T.StructField("label", T.StringType())]))

    schema = T.StructType([*df.schema.fields, T.StructField(out, kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = factory()
        for batch in batches:
            at = 0
            for texts in slices(batch.column(text_col)):
                found = fn([v or "" for v in _objects(texts)])
                spans = pa.array([[{"text": t, "label": g} for t, g in row] for row in found], to_arrow_type(kind))
                yield pa.RecordBatch.from_arrays([*batch.slice(at, len(texts)).columns, spans], schema.names)
                at += len(texts)

    return df.mapInArrow(run, schema)
