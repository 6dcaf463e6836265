"""Removal of repeated passages with a compressed FM-index per shard.

A window is ``width`` consecutive words.  Windows are routed to shards by their smallest n-gram
hash, so equal windows meet.  Neighbouring windows that share its place travel as one stretch of
words.  Only stretches whose hash occurs at least twice in the corpus can hold a repeated window;
the others are not sent.  Equal stretches are combined before they move and count by weight.

Each shard indexes its stretches and streams them through the index (:mod:`fm_index`): backward
search over a wavelet matrix gives how far back each sequence repeats, and the intervals of at least
``width`` words are reported.  They return to their documents, whose words they cover are removed.

A hash with too many words for one shard (a passage in a large share of all documents) is not indexed.
Its stretches are taken apart into single windows, and the weights of equal ones are summed by their
128-bit names in an aggregate that combines before it moves, so no task holds them together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from weftline.llm import words as W
from weftline.llm.fm_index import FMIndex, repeated_starts
from weftline.llm.groups import stage

GRAM = 6
SHARD_WORDS = 400_000


def _first_least(x: np.ndarray, span: int) -> np.ndarray:
    """Position of the smallest of each ``span`` consecutive values, the first of equal ones."""
    at = np.arange(len(x))

    def better(a, b):
        return np.where(x[a] <= x[b], a, b)

    done = 1
    while done * 2 <= span:
        at = better(at[:len(at) - done], at[done:])
        done *= 2
    rest = span - done
    return better(at[:len(at) - rest], at[rest:]) if rest else at


def stretches(w: W.Words, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, windows, smallest hash) of the stretches of all texts.

    The windows of a stretch share the place of their smallest hash.  Equal windows have it at the same
    offset, so they never lie in one stretch, and a hash of one stretch alone has no repeated window.
    """
    starts = W.gram_starts(w.first, width)
    if not len(starts):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    gram = min(GRAM, width)
    hashes = W.grams(w.hash, gram)
    place = _first_least(hashes, width - gram + 1)[starts]
    doc = np.repeat(np.arange(len(w.counts)), np.maximum(0, w.counts - width + 1))
    new = np.ones(len(starts), bool)
    new[1:] = (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])
    begin = np.flatnonzero(new)
    return doc[begin], starts[begin], np.diff(np.append(begin, len(starts))), hashes[place[begin]]


def _signature(w: W.Words, first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128-bit name of each word sequence, as two signed columns."""
    out = []
    for salt in (np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)):
        v = W.mix(w.hash * salt)
        place = W.ranges(count)
        flat = np.repeat(first, count) + place
        rolled = v[flat] * W.mix((place + 1).astype(np.uint64) * salt | np.uint64(1))
        ends = np.cumsum(count)
        sums = np.add.reduceat(rolled, ends - count) if len(ends) else np.zeros(0, np.uint64)
        out.append(W.mix(sums + count.astype(np.uint64)).view(np.int64))
    return out[0], out[1]


def _anchors(docs: DataFrame, width: int) -> DataFrame:
    """(anchor, key, idx): the smallest hash of every stretch of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch):
                doc, _, _, least = stretches(W.words(part.column("text")), width)
                keys = part.column("key").to_numpy(zero_copy_only=False)
                idx = W.ranges(np.bincount(doc, minlength=len(keys)))
                yield pa.RecordBatch.from_pydict({"anchor": least.view(np.int64), "key": keys[doc], "idx": idx.astype(np.int32)})

    return docs.select("key", "text").mapInArrow(run, "anchor bigint, key bigint, idx int")


def _pieces(docs: DataFrame, width: int) -> DataFrame:
    """Wanted stretches of ``docs(key, text, wanted)`` with signature; a text comes once per slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch):
                w = W.words(part.column("text"))
                doc, first, size, least = stretches(w, width)
                per_doc = np.bincount(doc, minlength=part.num_rows)
                lists = part.column("wanted")
                chosen = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
                pick = np.sort(np.repeat(np.cumsum(per_doc) - per_doc, sizes) + chosen)
                doc, first, size, least = doc[pick], first[pick], size[pick], least[pick]
                s1, s2 = _signature(w, first, size + width - 1)
                _, once = np.unique(s1, return_index=True)
                texts: list[bytes | None] = [None] * len(pick)
                for i in once:
                    texts[i] = w.data[w.start[first[i]]:w.end[first[i] + size[i] + width - 2]].tobytes()
                keys = part.column("key").to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_pydict({
                    "key": keys[doc], "at": (first - w.first[doc]).astype(np.int32), "windows": size.astype(np.int32),
                    "anchor": least.view(np.int64), "s1": s1, "s2": s2, "text": pa.array(texts, pa.binary())})

    return docs.select("key", "text", "wanted").mapInArrow(
        run, "key bigint, at int, windows int, anchor bigint, s1 bigint, s2 bigint, text binary")


def _single_windows(stretch: DataFrame, width: int) -> DataFrame:
    """Each window (w1, w2) of the given stretches as a row, named by its own words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch):
                w = W.words(part.column("text").cast(pa.string()))
                counts = w.counts - width + 1
                row, shift = np.repeat(np.arange(part.num_rows), counts), W.ranges(counts)
                first = w.first[row] + shift
                w1, w2 = _signature(w, first, np.full(len(first), width))
                take = lambda c: part.column(c).to_numpy(zero_copy_only=False)[row]
                yield pa.RecordBatch.from_pydict({"s1": take("s1"), "s2": take("s2"), "shift": shift.astype(np.int32),
                                                  "weight": take("weight"), "w1": w1, "w2": w2})

    return stretch.select("s1", "s2", "weight", "text").mapInArrow(
        run, "s1 bigint, s2 bigint, shift int, weight int, w1 bigint, w2 bigint")


def repeated_singles(single: DataFrame) -> DataFrame:
    """(s1, s2, first, last): the windows of ``single`` that occur at least twice."""
    # stored apart from the join, so that adaptive execution can split a window of very many stretches
    often = stage(single.groupBy("w1", "w2").agg(F.sum("weight").alias("n")).filter("n > 1").select("w1", "w2"), "often-windows")
    return single.join(often, ["w1", "w2"], "left_semi").select("s1", "s2", F.col("shift").alias("first"), F.col("shift").alias("last"))


def search_shard(texts: list[bytes], weights: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index the texts of one shard and report their repeated window starts (text, first, last)."""
    w = W.words(pa.array([t.decode() for t in texts], pa.string()))
    counts = w.counts
    number = np.unique(w.hash, return_inverse=True)[1].astype(np.int64) + 1
    symbols = np.zeros(len(number) + len(texts), np.int64)
    begin = w.first[:-1] + np.arange(len(texts))
    spot = np.arange(len(number)) + w.text_of_word()
    symbols[spot] = number
    weight = np.zeros(len(symbols), np.int64)
    weight[spot] = np.repeat(weights, counts)
    index = FMIndex(symbols, weight, int(counts.max()) + 1)
    return repeated_starts(index, symbols, begin, np.maximum(0, counts - width + 1), width)


def repeated_windows(docs: DataFrame, width: int) -> DataFrame:
    """(key, spans): covered word ranges (stop exclusive) of documents ``docs(key, text)`` with repeated windows."""
    anchors = _anchors(docs, width)
    # stored apart from the join, so that adaptive execution can split a hot hash there
    often = stage(anchors.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor"), "often")
    wanted = anchors.join(often, "anchor", "left_semi").groupBy("key").agg(F.collect_set("idx").alias("wanted"))
    # texts are shuffled at every size: a copy of the other side would only fit small inputs
    pieces = stage(_pieces(docs.join(wanted, "key"), width), "pieces")

    # a document row that came several times counts as often
    stretch = pieces.groupBy("s1", "s2").agg(
        F.least(F.count(F.lit(1)), F.lit(2)).cast("int").alias("weight"), F.max("text").alias("text"),
        F.first("anchor").alias("anchor"), F.first("windows").alias("windows"))
    stretch = stage(stretch, "stretches")
    load = stretch.groupBy("anchor").agg(F.sum(F.col("windows") + width).alias("words"))
    total = load.agg(F.sum("words").alias("w")).first()["w"] or 0
    shards = max(1, -(-total // SHARD_WORDS))
    hot = stage(load.filter(F.col("words") > SHARD_WORDS).select("anchor"), "hot-anchors")  # fewer than total / SHARD_WORDS rows
    plain = stretch.join(F.broadcast(hot), "anchor", "left_anti").select(
        "s1", "s2", "weight", "text", F.pmod("anchor", F.lit(shards)).cast("int").alias("shard"))

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["s1", "s2"], ignore_index=True)
        text, first, last = search_shard(list(pdf["text"]), pdf["weight"].to_numpy(), width)
        return pd.DataFrame({"s1": pdf["s1"].to_numpy()[text], "s2": pdf["s2"].to_numpy()[text], "first": first, "last": last})

    found = plain.groupBy("shard").applyInPandas(search, "s1 bigint, s2 bigint, first int, last int")
    if not hot.isEmpty():
        single = stage(_single_windows(stretch.join(F.broadcast(hot), "anchor"), width), "single-windows")
        found = found.unionByName(repeated_singles(single))
    # stored apart from the join for the same reason as the counts: one stretch may lie in very many documents
    spans = stage(found.groupBy("s1", "s2").agg(F.collect_list(F.struct("first", "last")).alias("found")), "found")
    home = pieces.select("key", "at", "s1", "s2").join(spans, ["s1", "s2"])
    covered = F.transform("found", lambda s: F.struct((F.col("at") + s["first"]).alias("start"), (F.col("at") + s["last"] + width).alias("stop")))
    return stage(home.select("key", F.explode(covered).alias("s")).groupBy("key").agg(F.collect_set("s").alias("spans")), "spans")


def without_repeats(docs: DataFrame, text: str = "text", carry: list[str] | None = None, width: int = 35) -> DataFrame:
    """Texts without the words that lie in a repeated window.

    Rows ``(row, n_words, n_removed, kept)``: ``row`` packs the carried columns, ``kept`` joins the
    remaining words by one space.

    Words stand between ASCII white space and stay unchanged.  Null and empty texts have no words and an
    empty ``kept``.  Texts shorter than a window lose nothing.  A repeated row is a document of its own,
    so both lose their windows.  An empty table gives no rows.
    """
    keep = docs.columns if carry is None else carry
    packed = docs.select(F.struct(*[W.column(c) for c in keep]).alias("row"), W.column(text).cast("string").alias("text"))
    W.small_batches(docs)
    # equal rows share a key; their spans are equal too
    packed = packed.withColumn("key", F.xxhash64(F.to_json("row"), "text"))
    spans = repeated_windows(packed.filter("text is not null").select("key", "text"), width)
    joined = packed.join(spans, "key", "left").select("row", "text", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, kept = [], [], []
            for value, found in zip(batch.column("text"), batch.column("spans").to_pylist()):
                ws = (value.as_py() or "").encode().split()  # bytes.split() knows ASCII white space alone
                total.append(len(ws))
                if found:
                    stays = np.ones(len(ws), bool)
                    for s in found:
                        stays[s["start"]:s["stop"]] = False
                    ws = [ws[i] for i in np.flatnonzero(stays)]
                removed.append(total[-1] - len(ws))
                kept.append(b" ".join(ws).decode())
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                                              pa.array(kept, pa.string())], ["row", "n_words", "n_removed", "kept"])

    schema = StructType([packed.schema["row"], *StructType.fromDDL("n_words bigint, n_removed bigint, kept string").fields])
    return joined.mapInArrow(cut, schema)
