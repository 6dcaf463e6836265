"""Reading one JSON array with many tasks.

A file is read in Spark's own splits, as pieces between closing braces, so no task and no row holds a whole file.  What a split
means depends on what stands before it: whether it begins inside a string, and how deep.  One pass notes for each split
what it would do in either case (quotes are counted, brackets outside strings move the depth, commas and opening brackets are counted per depth); running
sums over these few rows give each split its true beginning.  A second pass cuts the elements at the commas of depth 1.  An element that
lies in several splits is put together again from one piece per split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weftline.session import cut_lineage

SLICE_BYTES = 1 << 20  # bytes looked at together inside a task; a longer piece is looked at alone
_BLOCK = ("file string, block bigint, bytes bigint, parity int, delta0 bigint, delta1 bigint, "
          "commas0 map<int,bigint>, commas1 map<int,bigint>, opens0 map<int,bigint>, opens1 map<int,bigint>")
_PIECE = "file string, block bigint, ord bigint, offset bigint, text binary, begins boolean, ends boolean, closing boolean, stray boolean"


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary(),
             "map<int,bigint>": pa.map_(pa.int32(), pa.int64())}
    return pa.schema([pa.field(n, kinds[k]) for n, k in (c.split(" ") for c in ddl.split(", "))])


def _slices(batch: pa.RecordBatch, seen: tuple | None) -> Iterator[tuple[tuple, int, np.ndarray]]:
    """``((file, block), first row, bytes)`` of at most about SLICE_BYTES, never of two blocks.

    The closing brace that ended the piece before is put in front again; only the first piece of a file has none.
    """
    if not batch.num_rows:
        return
    files, blocks = batch.column("file").dictionary_encode(), batch.column("block").to_numpy(zero_copy_only=False)
    names, code = files.dictionary.to_pylist(), files.indices.to_numpy(zero_copy_only=False)
    text = batch.column("value").cast(pa.large_binary())
    at = np.frombuffer(text.buffers()[1], np.int64, len(text) + 1, text.offset * 8)
    data = np.frombuffer(text.buffers()[2] or b"", np.uint8)
    change = np.flatnonzero((np.diff(code) != 0) | (np.diff(blocks) != 0)) + 1
    for lo, hi in zip([0, *change], [*change, len(text)]):
        key = (names[code[lo]], int(blocks[lo]))
        while lo < hi:
            end = max(lo + 1, int(np.searchsorted(at, at[lo] + SLICE_BYTES, "right")) - 1)
            end = min(end, hi)
            bare = key != seen and key[1] == 0
            raw = np.full(int(at[end] - at[lo]) + end - lo, ord("}"), np.uint8)
            own = np.ones(len(raw), bool)
            own[(at[lo:end] - at[lo]) + np.arange(end - lo)] = False
            raw[own] = data[at[lo]:at[end]]
            yield key, lo, raw[1:] if bare else raw
            seen, lo = key, end


def _strings(raw: np.ndarray) -> np.ndarray:
    """Number of quotes that open or close a string, up to each byte.  A piece never ends in a backslash."""
    quote = np.flatnonzero(raw == ord('"'))
    place = np.arange(len(raw), dtype=np.int64)
    other = np.maximum.accumulate(np.where(raw != ord("\\"), place, -1))
    before = np.where(quote > 0, other[np.maximum(quote, 1) - 1], -1)
    real = quote[(quote - 1 - before) % 2 == 0]
    marks = np.zeros(len(raw), np.int32)
    marks[real] = 1
    return np.cumsum(marks, dtype=np.int32)


def _structure(raw: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of brackets and commas outside strings, and how each moves the depth."""
    opens, closes = (raw == ord("{")) | (raw == ord("[")), (raw == ord("}")) | (raw == ord("]"))
    at = np.flatnonzero((opens | closes | (raw == ord(","))) & ~inside)
    return at, opens[at].astype(np.int64) - closes[at]


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per block: what it does if it begins outside (0) or inside (1) a string."""
    schema = _arrow(_BLOCK)
    key, state = None, None

    def row() -> pa.RecordBatch:
        size, parity, delta, commas, opens = state
        values = [*key, size, parity, *delta, *[list(c.items()) for c in (*commas, *opens)]]
        return pa.record_batch([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)

    for batch in batches:
        for name, _, raw in _slices(batch, key):
            if name != key:
                if key is not None:
                    yield row()
                key, state = name, (0, 0, [0, 0], [{}, {}], [{}, {}])
            size, parity, delta, commas, opens = state
            quotes = _strings(raw)
            for begin in (0, 1):
                at, move = _structure(raw, ((quotes + parity + begin) & 1).astype(bool))
                depth = delta[begin] + np.cumsum(move)
                for counts, which in ((commas[begin], raw[at] == ord(",")), (opens[begin], move > 0)):
                    for d, n in zip(*(x.tolist() for x in np.unique(depth[which], return_counts=True))):
                        counts[d] = counts.get(d, 0) + n
                delta[begin] += int(move.sum())
            state = (size + len(raw), (parity + (int(quotes[-1]) if len(quotes) else 0)) & 1, delta, commas, opens)
    if key is not None:
        yield row()


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Elements, or the part of them that lies in a block."""
    schema = _arrow(_PIECE)
    key, state = None, None
    rows: list[tuple] = []
    held = 0

    def batch_of() -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def rest() -> None:
        _, depth, number, place, parts, begins = state
        text = b"".join(parts)
        if depth > 0 and text:
            rows.append((*key, number, place, text, begins, False, False, False))
        elif text.strip():  # before or behind the array
            rows.append((*key, number, place, b"", False, False, False, True))

    for batch in batches:
        starts = [batch.column(c) for c in ("state", "depth", "ord", "offset")]
        for name, first, raw in _slices(batch, key):
            if name != key:
                if key is not None:
                    rest()
                inside, depth, number, place = (c[first].as_py() for c in starts)
                key, state = name, (inside, depth, number, place, [], False)
            inside, depth, number, place, parts, begins = state
            quotes = _strings(raw)
            at, move = _structure(raw, ((quotes + inside) & 1).astype(bool))
            level = depth + np.cumsum(move)
            sign = raw[at]
            opens = (move > 0) & (level == 1)
            closes = (move < 0) & (level == 0)
            border = at[opens | closes | ((sign == ord(",")) & (level == 1)) | (level < 0)]
            kind, deep = (x[np.searchsorted(at, border)] for x in (sign, level))
            done = 0
            for b, sort, now in zip(border.tolist(), kind.tolist(), deep.tolist()):
                text = b"".join([*parts, raw[done:b].tobytes()])
                if sort in b",]" and now in (0, 1):
                    rows.append((*key, number, place, text, begins, True, sort == ord("]"), False))
                    number += sort == ord(",")
                elif text.strip() or sort != ord("["):
                    rows.append((*key, number, place, b"", False, False, False, True))
                held += len(text)
                place += len(text) + 1
                parts, begins, done = [], now == 1, b + 1
            parts.append(raw[done:].tobytes())
            state = ((inside + (int(quotes[-1]) if len(quotes) else 0)) & 1, int(level[-1]) if len(level) else depth, number, place, parts, begins)
            if held >= SLICE_BYTES:
                yield batch_of()
                rows.clear()
                held = 0
    if key is not None:
        rest()
    if rows:
        yield batch_of()


def elements(spark: SparkSession, path, pattern: str | None = None, what: str = "JSON array") -> DataFrame:
    """Elements of files that hold one JSON array each: ``(file, ord, offset, text)``, with the first byte's place in the file.

    An empty array gives no row, nor does a file without a byte, which Spark does not open.  A file that is no single array (another value, an open string or bracket, something beside
    the array, an empty element) is an error that names the file and place.  The elements themselves are not parsed.
    Strings stand in double quotes and files in UTF-8.  The beginnings of all splits are copied to every task: some 60 bytes per split.
    """
    reader = spark.read.option("lineSep", "}")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    pieces = reader.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    blocks = cut_lineage(pieces.mapInArrow(_measure, _BLOCK))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)

    def upto(c):
        return F.coalesce(F.sum(c).over(before), F.lit(0)).cast("bigint")

    outside = F.col("state") == 0
    starts = blocks.withColumn("state", F.pmod(upto("parity"), F.lit(2)).cast("int"))
    starts = starts.withColumn("delta", F.when(outside, F.col("delta0")).otherwise(F.col("delta1"))).withColumn("depth", upto("delta"))

    def at_top(zero, one):
        return F.coalesce(F.try_element_at(F.when(outside, F.col(zero)).otherwise(F.col(one)), (1 - F.col("depth")).cast("int")), F.lit(0))

    starts = starts.withColumns({"n": at_top("commas0", "commas1"), "arrays": at_top("opens0", "opens1")})
    starts = cut_lineage(starts.select("file", "block", "state", "depth", upto("n").alias("ord"), upto("bytes").alias("offset"),
                                       "parity", "delta", "bytes", "arrays"))
    ends = starts.groupBy("file").agg((F.sum("parity") % 2).alias("p"), F.sum("delta").alias("d"), F.sum("arrays").alias("n"), F.sum("bytes").alias("b"))
    # a brace at the very end of a file ends a piece without a trace
    listed = spark.read.format("binaryFile").options(**({"pathGlobFilter": pattern} if pattern else {})).load(path)
    listed = listed.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))
    last = (F.col("b") == F.col("size") - 1) & ~F.col("file").rlike(r"\.(gz|bz2|zst|lz4|snappy|deflate)$")
    broken = listed.join(ends, "file", "left").filter(F.col("b").isNull() | (F.expr("p <> 0 or d <> 0 or n <> 1")) | last).orderBy("file").first()
    if broken is not None:
        raise ValueError(f"damaged {what}: {broken['file']} is not one whole array; it ends at byte {broken['size']}")
    placed = pieces.join(F.broadcast(starts.select("file", "block", "state", "depth", "ord", "offset")), ["file", "block"])
    found = placed.select("file", "block", "value", "state", "depth", "ord", "offset").mapInArrow(_cut, _PIECE)
    blank = F.trim(F.regexp_replace(F.col("text").cast("string"), r"[\r\n\t]", " ")) == ""
    wrong = F.raise_error(F.concat(F.lit(f"damaged {what}: "), F.col("file"), F.lit(" at byte "), F.col("offset").cast("string")))
    whole = found.filter("(begins and ends) or stray")
    parts = found.filter("not (begins and ends) and not stray").groupBy("file", "ord").agg(
        F.min("offset").alias("offset"), F.max("closing").alias("closing"),
        F.array_sort(F.collect_list(F.struct("block", "text"))).alias("s"))  # a piece per split
    joined = parts.withColumn("text", F.aggregate("s", F.lit(b""), lambda a, x: F.concat(a, x["text"])))
    every = whole.select("file", "ord", "offset", "text", "closing", "stray").unionByName(
        joined.select("file", "ord", "offset", "text", "closing", F.lit(False).alias("stray")))
    checked = every.filter(F.col("stray") | ~(blank & F.col("closing") & (F.col("ord") == 0)))
    return checked.select("file", "ord", "offset", F.when(F.col("stray") | blank, wrong).otherwise(F.col("text").cast("string")).alias("text"))
