"""Stored trigram index over a corpus: patterns read only the line blocks that can match.

Texts are cut into blocks of lines.  The postings table has a row per trigram and run of some blocks, so a frequent
trigram is many rows and no long list.  A regular expression gives the trigrams that every match must hold; its rarest ones are
joined to the postings, blocks that have them all are candidates, and only candidates are searched with the expression.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weftline.session import shared_table

BLOCK_LINES = 32
BLOCK_CHARS = 2_048  # a block ends with the line that reaches one of both
RUN_BLOCKS = 1_024  # blocks whose postings are written together, a row per trigram
RUN_GRAMS = 4_096  # and rows that leave the worker at once
RUN_CHARS = 4 << 20  # characters whose trigrams are sorted together
HIT_ROWS, HIT_CHARS = 8_192, 4 << 20  # hits that leave the worker at once
RAREST = 3  # trigrams of a pattern that are looked up
PACK = 500  # patterns that meet a block at once
COMMON = 2  # a pattern whose rarest trigram is in more than one of so many blocks meets all of them
FEW_PACKS = 20  # packs whose patterns are sent to the blocks and postings
LISTED_BLOCKS = 1_000  # candidates up to which blocks are picked by a pushed filter
#: characters that one regular expression letter may match without case: fixed values of Unicode
_FOLD = {**{chr(c): chr(c + 32) for c in range(65, 91)}, "İ": "i", "ı": "i", "ſ": "s", "K": "k"}


@dataclass(frozen=True)
class TrigramIndex:
    """``blocks(block, path, first_line, text)``, ``postings(gram, blocks)`` and ``grams(gram, n)``, all stored."""

    blocks: DataFrame
    postings: DataFrame
    grams: DataFrame


def fold(text: str) -> str:
    """Case folded character by character, so that places stay."""
    if text.isascii():
        return text.lower()
    text = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # folds A to Z alone
    for char, plain in _FOLD.items():
        if char > "z" and char in text:
            text = text.replace(char, plain)
    return text


def block_grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of trigram and place in ``texts``, sorted; lines are folded and no trigram crosses a line end.

    A trigram is a number of three times 21 bits, a code point each.
    """
    found, part, size = [], [], 0
    for place, text in enumerate(texts):
        for lo in range(0, max(len(text) - 2, 0), RUN_CHARS):  # a window of a long text goes on by two characters
            piece = text[lo:lo + RUN_CHARS + 2]
            if part and size + len(piece) > RUN_CHARS:
                found.append(_window_grams(part))
                part, size = [], 0
            part.append((place, piece))
            size += len(piece)
    if part:
        found.append(_window_grams(part))
    if len(found) == 1:
        return found[0]
    grams, places = (np.concatenate([f[i] for f in found] or [np.zeros(0, np.int64)]) for i in (0, 1))
    order = np.lexsort((places, grams))
    grams, places = grams[order], places[order]
    first = np.ones(len(grams), dtype=bool)
    first[1:] = (grams[1:] != grams[:-1]) | (places[1:] != places[:-1])
    return grams[first], places[first]


def _window_grams(part: list[tuple[int, str]]) -> tuple[np.ndarray, np.ndarray]:
    folded = [fold(text) for _, text in part]
    codes = np.frombuffer("\n".join(folded).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letters = np.flatnonzero(np.bincount(codes))
    at = np.zeros(letters[-1] + 1, dtype=np.int64)
    at[letters] = np.arange(len(letters))
    own, n, k = at[codes], len(letters), len(part)
    text = np.repeat(np.arange(k), [len(f) + 1 for f in folded])[:-1]
    whole = codes != 10
    whole = whole[:-2] & whole[1:-1] & whole[2:]
    gram = (own[:-2] * n + own[1:-1]) * n + own[2:] if n ** 3 * k < 1 << 63 else None
    if gram is None:  # so many different characters that the pair is no number: trigrams are numbered first
        wide = codes.astype(np.int64)
        known, gram = np.unique((wide[:-2] << 42) | (wide[1:-1] << 21) | wide[2:], return_inverse=True)
    pairs = np.sort((gram * k + text[:-2])[whole])  # faster than the library's unique values
    pairs = pairs[np.diff(pairs, prepend=-1) > 0]
    gram, text = pairs // k, pairs % k
    if n ** 3 * k < 1 << 63:
        gram = (letters[gram // (n * n)] << 42) | (letters[gram // n % n] << 21) | letters[gram % n]
    else:
        gram = known[gram]
    return gram, np.array([place for place, _ in part])[text]


def _gram_names(grams: np.ndarray) -> list[str]:
    chars = np.stack([grams >> 42, grams >> 21 & 0x1FFFFF, grams & 0x1FFFFF], axis=1).astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
    return [chars[i:i + 3] for i in range(0, len(chars), 3)]


def build_index(corpus: DataFrame, where: str | None = None, block_lines: int = BLOCK_LINES) -> TrigramIndex:
    """Index a corpus (path, text) below ``where`` (default: a staged folder that goes with the session).

    A final line feed ends the last line; null and empty texts have no lines.  Paths may repeat or be null.
    """
    def cut(text: str) -> list[tuple[int, str]]:
        blocks, first, size = [], 0, 0
        lines = text.removesuffix("\n").split("\n")
        for n, line in enumerate(lines, 1):
            size += len(line) + 1
            if n - first == block_lines or size >= BLOCK_CHARS or n == len(lines):
                blocks.append((first + 1, "\n".join(lines[first:n])))
                first, size = n, 0
        return blocks

    cutter = F.udf(cut, "array<struct<first_line:bigint,text:string>>", useArrow=True)
    blocks = shared_table(corpus.filter("text <> ''").select("path", F.inline(cutter("text"))).withColumn(
        "block", F.monotonically_increasing_id()), "blocks", where)
    return _with_postings(blocks, where)


def path_index(corpus: DataFrame, where: str | None = None) -> TrigramIndex:
    """Index of the paths themselves: a block is one path."""
    blocks = shared_table(corpus.filter("path is not null").select(
        F.monotonically_increasing_id().alias("block"), "path", F.lit(0).cast("bigint").alias("first_line"), F.col("path").alias("text")), "paths", where)
    return _with_postings(blocks, where)


def _with_postings(blocks: DataFrame, where: str | None) -> TrigramIndex:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, RUN_BLOCKS):  # a block has up to one trigram per character
                part = batch.slice(at, RUN_BLOCKS)
                grams, places = block_grams(part.column(1).to_pylist())
                ids = part.column(0).to_numpy()[places]
                first = np.flatnonzero(np.r_[True, grams[1:] != grams[:-1]]) if len(grams) else np.zeros(0, np.int64)
                ends = np.append(first, len(grams))
                for lo in range(0, len(first), RUN_GRAMS):
                    some = ends[lo:lo + RUN_GRAMS + 1]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(_gram_names(grams[some[:-1]]), pa.string()), pa.array(np.diff(some), pa.int64()),
                        pa.ListArray.from_arrays(pa.array(some - some[0], pa.int32()), pa.array(ids[some[0]:some[-1]], pa.int64()))], ["gram", "n", "blocks"])

    # stored before it is sorted, because sampling the ranges would make all trigrams twice
    raw = shared_table(blocks.select("block", "text").mapInArrow(rows, "gram string, n bigint, blocks array<bigint>"), "trigrams")
    postings, run = raw.select("gram", "blocks"), F.col("blocks")[0]
    if where:  # sorted for the searches of other sessions; one that goes with its session is read a time or two
        postings = shared_table(postings.repartitionByRange("gram", run).sortWithinPartitions("gram", run), "postings", where)
    return TrigramIndex(blocks, postings, shared_table(raw.groupBy("gram").agg(F.sum("n").alias("n")), "grams", where))


def open_index(spark: SparkSession, where: str, blocks: str = "blocks") -> TrigramIndex:
    """An index that :func:`build_index` (or :func:`path_index`, blocks ``paths``) stored."""
    return TrigramIndex(*[spark.read.parquet(f"{where}/{name}") for name in (blocks, "postings", "grams")])


@lru_cache(maxsize=4096)
def required_literals(pattern: str) -> tuple[str, ...]:
    """Case-folded stretches of characters that every match of a regular expression holds, longest first.

    Only literal characters count; optional parts, alternatives and classes end a stretch.
    """
    tree = re._parser.parse(pattern)  # the library's own parse tree
    stretches, run = [], []

    def end() -> None:
        stretches.append("".join(run))
        run.clear()

    def walk(items, flags: int) -> None:
        for op, value in items:
            name = str(op)
            if name == "LITERAL" and (not flags & re.IGNORECASE or value < 128):
                run.append(chr(value))
            elif name == "SUBPATTERN":
                walk(value[3], (flags | value[1]) & ~value[2])
            elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT") and value[0] >= 1:
                walk(value[2], flags)
                end()  # the part occurs at least once; what follows may stand after a repetition
                if value[1] == 1:
                    continue
                run.clear()
            elif name == "AT":
                continue
            else:
                end()
        return

    walk(tree, tree.state.flags)
    end()
    return tuple(sorted({fold(x) for x in stretches if x and "\n" not in x}, key=len, reverse=True))


def required_grams(pattern: str) -> list[str]:
    """Trigrams that every match holds; none if nothing can be said."""
    return sorted({s[i:i + 3] for s in required_literals(pattern) for i in range(len(s) - 2)})


@lru_cache(maxsize=4096)
def _compiled(pattern: str) -> re.Pattern:
    return re.compile(pattern)


def candidates(index: TrigramIndex, patterns: DataFrame) -> DataFrame:
    """``(pattern, regex, block)``: blocks that hold the rarest trigrams of each pattern.

    ``patterns(pattern, regex)`` are distinct expressions that compile; those without a required trigram are left out here
    (see :func:`search`).
    """
    grams = F.udf(required_grams, "array<string>", useArrow=True)
    asked = patterns.select("pattern", "regex", F.explode(grams("regex")).alias("gram"))
    known = asked.join(index.grams, "gram", "left").fillna(0, ["n"])
    rank = F.row_number().over(Window.partitionBy("pattern").orderBy("n", "gram"))
    picked = known.withColumn("rank", rank).filter(F.col("rank") <= RAREST).withColumn(
        "of", F.count(F.lit(1)).over(Window.partitionBy("pattern")))
    found = picked.filter("n > 0")
    found = F.broadcast(found) if patterns.count() <= FEW_PACKS * PACK else found  # else all postings would move
    met = found.join(index.postings, "gram").withColumn("block", F.explode("blocks"))
    return met.groupBy("pattern", "regex", "block").agg(F.count(F.lit(1)).alias("have"), F.first("of").alias("of")).filter(
        "have = of").select("pattern", "regex", "block")


_HITS = "pattern string, path string, line_no bigint, line string"


def _hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("pattern", pa.string()), ("path", pa.string()), ("line_no", pa.int64()), ("line", pa.string())])
    out, size = [], 0
    for batch in batches:
        for patterns, path, first, text in zip(*(batch.column(c).to_pylist() for c in ("patterns", "path", "first_line", "text"))):
            lines, plain = text.split("\n"), fold(text)
            starts, at = [], 0
            for line in lines:
                starts.append(at)
                at += len(line) + 1
            for p in patterns:
                rx, part = _compiled(p["regex"]), next(iter(required_literals(p["regex"])), "")
                for n in _lines_with(part, plain, starts) if part else range(len(lines)):
                    if rx.search(lines[n]):
                        out.append((p["pattern"], path, first + n, lines[n]))
                        size += len(lines[n])
                if len(out) >= HIT_ROWS or size >= HIT_CHARS:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                    out, size = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


def _lines_with(part: str, plain: str, starts: list[int]) -> Iterator[int]:
    """Numbers of the lines of ``plain`` that hold ``part``, which has no line end."""
    at = plain.find(part)
    while at >= 0:
        n = bisect_right(starts, at) - 1
        yield n
        at = plain.find(part, starts[n + 1]) if n + 1 < len(starts) else -1


def _packed(index: TrigramIndex, found: DataFrame, pack: int) -> DataFrame:
    """Texts of the blocks in ``found(pattern, regex, block)``, each with at most ``pack`` of its patterns."""
    found = shared_table(found, "candidates")
    place = F.row_number().over(Window.partitionBy("block").orderBy("pattern")) - 1
    packed = found.withColumn("pack", F.floor(place / pack)).groupBy("block", "pack").agg(F.collect_list(F.struct("pattern", "regex")).alias("patterns")).drop("pack")
    some = [r["block"] for r in found.select("block").distinct().limit(LISTED_BLOCKS + 1).collect()]
    blocks = index.blocks.filter(F.col("block").isin(some)) if len(some) <= LISTED_BLOCKS else index.blocks
    return packed.join(blocks, "block").select("patterns", "path", "first_line", "text")


def verify(index: TrigramIndex, found: DataFrame, pack: int = PACK) -> DataFrame:
    """Hits of given candidates ``(pattern, regex, block)``, in the form of :func:`search`."""
    return _packed(index, found, pack).mapInArrow(_hits, _HITS)


def search(index: TrigramIndex, patterns: DataFrame, pack: int = PACK) -> DataFrame:
    """Hits ``(pattern, path, line_no, line)`` of every expression in ``patterns(pattern, regex)``.

    Patterns are distinct.  Expressions without a required trigram, or whose rarest one most blocks hold, are searched in every block, in
    packs of ``pack``, by one join.
    """
    grams = F.udf(required_grams, "array<string>", useArrow=True)
    asked = patterns.select("pattern", "regex", F.explode_outer(grams("regex")).alias("gram")).join(index.grams, "gram", "left")
    rarest = F.min(F.when(F.col("gram").isNotNull(), F.coalesce("n", F.lit(0))))
    common = F.coalesce(rarest * COMMON > index.blocks.count(), F.lit(True))
    patterns = shared_table(asked.groupBy("pattern", "regex").agg(common.alias("common")), "patterns")
    hits = verify(index, candidates(index, patterns.filter("not common")), pack)
    one = F.struct("pattern", "regex")
    loose = patterns.filter("common")
    n_packs = -(-loose.count() // pack)
    if n_packs:
        packs = loose.groupBy(F.pmod(F.xxhash64("regex", "pattern"), F.lit(n_packs)).alias("pack")).agg(F.collect_list(one).alias("patterns"))
        packs = F.broadcast(packs) if n_packs <= FEW_PACKS else packs  # few would take the blocks to as few tasks
        everywhere = index.blocks.withColumn("pack", F.explode(F.expr(f"sequence(0L, {n_packs - 1}L)")))
        hits = hits.unionByName(everywhere.join(packs, "pack").select("patterns", "path", "first_line", "text").mapInArrow(_hits, _HITS))
    return hits
