"""Vectorised word work on Arrow string columns.

Texts stay in Arrow's own buffer.  Words, their 64-bit hashes and n-gram hashes come from
whole-array numpy operations, so no Python code runs per word.  Batches are cut into
slices of bounded size first; a slice holds several rows or one long row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SLICE_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_GRAM = np.uint64(0xD6E8FEB86659FD93)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

_byte = np.arange(256)
#: bytes of words between ASCII white space
NOT_SPACE = ~((_byte == 0x20) | ((_byte >= 0x09) & (_byte <= 0x0D)))
#: bytes of words made of ASCII letters, digits and everything beyond ASCII
ALNUM = (_byte >= 0x80) | ((_byte >= 0x30) & (_byte <= 0x39)) | (((_byte | 32) >= 0x61) & ((_byte | 32) <= 0x7A) & (_byte >= 0x41))
_values = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
SAME_CASE = _values
LOWER_CASE = _values.copy()
LOWER_CASE[0x41:0x5B] = _values[0x61:0x7B]

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[k] = np.multiply.accumulate(table)
    return _powers[0], _powers[1]


@dataclass
class Words:
    """Words of several texts: ``hash``, byte range in ``data``, and the first word of each text (n + 1 entries)."""

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    data: np.ndarray
    sums: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def prefixes(self, n: int) -> np.ndarray:
        """Hash of the first ``n`` bytes of each word (of the whole word if it is shorter)."""
        _, back = _power_tables(len(self.data) + 1)
        stop = np.minimum(self.end, self.start + n)
        return mix((self.sums[stop] - self.sums[self.start]) * back[self.start] + np.uint64(n))

    def word(self, i: int) -> bytes:
        return self.data[self.start[i]:self.end[i]].tobytes()


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n + 1 offsets of a string array; nulls count as empty."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    _, offsets, data = texts.buffers()
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(offsets, np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def words(texts: pa.Array, is_word: np.ndarray = NOT_SPACE, values: np.ndarray = SAME_CASE) -> Words:
    """Split texts at bytes outside ``is_word`` and hash each word by the byte ``values``."""
    data, offs = buffers(texts)
    n = len(data)
    inside = is_word[data]
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    filled = np.flatnonzero(np.diff(offs))
    before[offs[filled]] = False
    after[offs[filled + 1] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    power, back = _power_tables(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values[data] * power[:n], out=sums[1:])
    h = mix((sums[end] - sums[start]) * back[start] + (end - start).astype(np.uint64))
    return Words(h, start, end, np.searchsorted(start, offs), data, sums)


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive values, over text ends too (see :func:`gram_starts`)."""
    n = max(0, len(h) - k + 1)
    out = np.full(n, k, np.uint64)
    for j in range(k):
        out *= _GRAM
        out += h[j:j + n]
    return mix(out)


def gram_starts(first: np.ndarray, k: int) -> np.ndarray:
    """Positions at which a run of ``k`` words stays inside its text."""
    counts = np.diff(first)
    keep = np.maximum(0, counts - k + 1)
    skip = np.repeat(first[:-1] - (np.cumsum(keep) - keep), keep)
    return np.arange(keep.sum()) + skip


def ranges(sizes: np.ndarray) -> np.ndarray:
    """0..size-1 for each size, joined."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part has at most ``limit`` bytes of text, or one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    at = 0
    total = np.cumsum(sizes)
    while at < len(sizes):
        done = total[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(total, done + limit, "right")))
        yield batch.slice(at, stop - at)
        at = stop


def text_map(df: DataFrame, text: str, carry: list[str] | None, fn: Callable[[pa.Array], list[pa.Array]],
             fields: str, limit: int = SLICE_BYTES) -> DataFrame:
    """Apply ``fn`` to bounded slices of a text column.

    ``carry`` names the columns to keep (all by default).  They travel packed in one column
    ``row``, so their names never clash with the new ``fields``; ``fn`` returns one array
    for each of them.
    """
    small_batches(df)
    keep = df.columns if carry is None else carry
    packed = df.select(F.struct(*[column(c) for c in keep]).alias("row"), column(text).cast("string").alias("text"))
    schema = StructType([packed.schema["row"], *StructType.fromDDL(fields).fields])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", limit):
                yield pa.RecordBatch.from_arrays([part.column("row"), *fn(part.column("text"))], names)

    return packed.mapInArrow(run, schema)


def column(name: str) -> Column:
    """A column by its literal name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def small_batches(df: DataFrame, rows: int = 512) -> None:
    """Bound the memory of Python workers: fewer rows for each Arrow batch."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def list_array(values: np.ndarray | list, sizes: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """A list column from joined values and the length of each list."""
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
