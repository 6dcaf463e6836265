"""Reading, searching and editing texts of a corpus table (path, text)."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions import text as X
from weftline.functions.vectors import let
from weftline.operators import trigrams
from weftline.operators.chunking import lines
from weftline.session import cut_lineage, shared_table

# Limits and folders that listings leave out.
MAX_LINES = 800
MAX_HITS = 80
MAX_OUTPUT = 48_000
FEW_PATHS = 10_000  # paths of read calls that are sent to the texts
SKIPPED_FOLDERS = (".git", "node_modules", "__pycache__", ".venv", "venv", "dist", "build", ".mypy_cache",
                   ".pytest_cache", "target")


def line_array(text: Column) -> Column:
    body = F.when(text.endswith("\n"), F.substr(text, F.lit(1), F.length(text) - 1)).otherwise(text)
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(body, "\n"))


def read_slice(text: Column, offset: Column | int = 0, limit: Column | int | None = None,
               max_lines: int | None = MAX_LINES) -> Column:
    """Numbered lines from ``offset``, at most ``max_lines`` (None: all), with a note on what is left."""
    at = offset if isinstance(offset, Column) else F.lit(offset)

    def show(ls: Column) -> Column:
        n = F.size(ls)
        asked = n - at if limit is None else F.coalesce(
            limit if isinstance(limit, Column) else F.lit(limit), n - at)
        cap = asked if max_lines is None else F.least(asked, F.lit(max_lines))
        numbered = F.transform(F.slice(ls, at + 1, F.greatest(cap, F.lit(0))),
                               lambda line, i: F.concat(F.format_string("%4d| ", at + i + 1), line))
        left = n - at - cap
        note = F.when(left > 0, F.concat(F.lit("\n... ("), left.cast("string"), F.lit(" more lines)"))).otherwise("")
        bad = F.concat(F.lit("error: offset "), at.cast("string"), F.lit(" out of range (file has "),
                       n.cast("string"), F.lit(" lines)"))
        return F.when((at < 0) | (at > n), bad).otherwise(F.concat(F.array_join(numbered, "\n"), note))

    return let(line_array(text), show)


def grep(corpus: DataFrame, pattern: str, limit: int = MAX_HITS) -> DataFrame:
    """First matching lines by path and line number, and the number of further hits."""
    # hits are found once and kept, because they are both counted and ranked
    hits = cut_lineage(lines(corpus, ["path"]).filter(F.col("line").rlike(pattern)).select(
        "path", (F.col("line_no") + 1).alias("line_no"), F.rtrim("line").alias("line")))
    more = hits.agg(F.greatest(F.count(F.lit(1)) - limit, F.lit(0)).cast("bigint").alias("more"))  # one row
    return hits.orderBy("path", "line_no").limit(limit).crossJoin(F.broadcast(more)).select(
        "path", "line_no", F.concat_ws(":", "path", F.col("line_no").cast("string"), "line").alias("hit"), "more")


def glob_pattern(pattern: str) -> str:
    """Path pattern (``*``, ``?``, ``**``) as a regular expression."""
    out, i = "", 0
    while i < len(pattern):
        if pattern.startswith("**/", i):
            out, i = out + "(?:.*/)?", i + 3
        elif pattern.startswith("**", i):
            out, i = out + ".*", i + 2
        else:
            c = pattern[i]
            out, i = out + {"*": "[^/]*", "?": "[^/]"}.get(c, re.escape(c)), i + 1
    return f"^{out}$"


def list_paths(files: DataFrame, pattern: str, newest_first: bool = False) -> DataFrame:
    """Paths that fit the pattern, by name or by modification time (column ``modified``)."""
    skipped = "|".join(re.escape(s) for s in SKIPPED_FOLDERS)
    found = files.filter(F.col("path").rlike(glob_pattern(pattern)) & ~F.col("path").rlike(f"(^|/)(?:{skipped})(/|$)"))
    return found.orderBy(F.desc("modified"), "path") if newest_first else found.orderBy("path")


def replace_exact(text: Column, old: Column, new: Column, everywhere: bool = False) -> tuple[Column, Column]:
    """(new text, status): refuses what does not occur, or occurs twice unless ``everywhere``."""
    n = ((F.length(text) - F.length(F.replace(text, old, F.lit("")))) / F.length(old)).cast("bigint")
    at = F.position(old, text)
    first = F.concat(F.substr(text, F.lit(1), at - 1), new, F.substr(text, at + F.length(old)))
    status = F.when(n == 0, "error: old_string not found")
    if not everywhere:
        status = status.when(n > 1, F.concat(F.lit("error: old_string appears "), n.cast("string"),
                                             F.lit(" times (use all=true)")))
    status = status.otherwise("ok")
    changed = F.replace(text, old, new) if everywhere else first
    return F.when(status == "ok", changed).otherwise(text), status


def capped(output: Column, limit: int = MAX_OUTPUT) -> Column:
    """Output cut to ``limit`` characters with a note."""
    return F.when(
        F.length(output) > limit,
        F.concat(X.cut(output, limit), F.lit("\n... [truncated "), (F.length(output) - limit).cast("string"),
                 F.lit(" chars]"))).otherwise(output)


def _pattern_errors(patterns: pd.Series) -> pd.Series:
    """The message for each expression that does not compile, else null."""
    def one(pattern):
        try:
            re.compile(pattern)
        except re.error as e:
            return f"error: {e}"
        return None

    return pd.Series([one(p) for p in patterns], dtype=object)


def grep_index(index: trigrams.TrigramIndex, pattern: str, limit: int = MAX_HITS) -> DataFrame:
    """:func:`grep` over a stored trigram index; the pattern follows Python's rules."""
    asked = index.blocks.sparkSession.createDataFrame([(pattern, pattern)], "pattern string, regex string")
    hits = cut_lineage(trigrams.search(index, asked).select("path", "line_no", F.rtrim("line").alias("line")))
    more = hits.agg(F.greatest(F.count(F.lit(1)) - limit, F.lit(0)).cast("bigint").alias("more"))  # one row
    return hits.orderBy("path", "line_no").limit(limit).crossJoin(F.broadcast(more)).select(
        "path", "line_no", F.concat_ws(":", "path", F.col("line_no").cast("string"), "line").alias("hit"), "more")


def _answered(searches: DataFrame, hits: DataFrame, shown: Column) -> DataFrame:
    found = hits.select(F.col("pattern").alias("_pat"), F.col("line_no").alias("seq"), shown.alias("output"))
    return searches.join(found, "_pat").select("call_id", "name", "seq", "output")


@lru_cache(maxsize=1 << 16)
def _fits(pattern: str, folder: str) -> bool:
    return trigrams._compiled(glob_pattern(pattern)).search(folder) is not None


def _named_hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (pattern, path) with one file name, those that fit: the name is plain, so the folders decide."""
    for batch in batches:
        found = []
        for pattern, path in zip(batch.column("pattern").to_pylist(), batch.column("path").to_pylist()):
            if "\n" in path:  # each of its lines is looked at, as in the index of paths
                rx = re.compile(glob_pattern(pattern))
                found += [(pattern, path, n) for n, line in enumerate(path.split("\n")) if rx.search(line)]
                continue
            name = len(pattern) - pattern.rfind("/") - 1
            if _fits(pattern[:len(pattern) - name], path[:len(path) - name]):
                found.append((pattern, path, 0))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*found), (pa.string(), pa.string(), pa.int64()))],
                                             ["pattern", "path", "line_no"])


def _glob_hits(globs: DataFrame, corpus: DataFrame, pack: int) -> DataFrame:
    """Paths of path patterns (column ``pattern``): by file name where the last part has no wildcard, by the index of paths otherwise.

    Patterns that name a file meet the paths of that name before anything is made of them.
    """
    last = F.substring_index("pattern", "/", -1)
    named = globs.filter(~last.rlike("[*?]")).distinct().withColumn("last", last)
    wild = globs.filter(last.rlike("[*?]")).distinct()
    paths = corpus.filter("path is not null").select("path", F.substring_index("path", "/", -1).alias("last"))
    hits = named.join(paths, "last").select("pattern", "path").mapInArrow(_named_hits, "pattern string, path string, line_no bigint")
    if wild.isEmpty():
        return hits
    asked = wild.select("pattern", F.udf(glob_pattern, "string", useArrow=True)("pattern").alias("regex"))
    return hits.unionByName(trigrams.search(trigrams.path_index(corpus), asked, pack).select("pattern", "path", "line_no"))


def run_calls(calls: DataFrame, corpus: DataFrame, extra: dict[str, Callable] | None = None,
              pattern_block: int = trigrams.PACK, index: trigrams.TrigramIndex | None = None) -> DataFrame:
    """Answer a table of tool calls (call_id, name, args JSON) over a corpus (path, text).

    ``read`` gives one row per call, ``grep`` and ``glob`` one row per hit.  An unknown or missing name, a
    missing argument and a pattern that does not compile each give an error row for their call (a path pattern always
    compiles).  Ids may repeat or be null: every call is answered for itself.  ``extra`` adds tools: name ->
    function(calls, corpus) -> rows.

    Equal patterns are searched once, over a trigram index of the texts (``index``, else one is built for this run) and one
    of the paths; at most ``pattern_block`` patterns meet a block of text at once.  Hits meet their calls in a join, so the number of
    calls or patterns does not matter to the driver.
    """
    arg = F.try_parse_json("args")
    read = {
        "_path": F.try_variant_get(arg, "$.path", "string"), "_pat": F.try_variant_get(arg, "$.pat", "string"),
        "_offset": F.coalesce(F.try_variant_get(arg, "$.offset", "int"), F.lit(0)),
        "_limit": F.try_variant_get(arg, "$.limit", "int")}
    # stored, because every kind of answer would parse all arguments again
    calls = shared_table(calls.withColumns(read) if extra else calls.select("call_id", "name", *[c.alias(n) for n, c in read.items()]), "calls")
    zero = F.lit(0).cast("bigint").alias("seq")

    def failed(rows: DataFrame, message: Column) -> DataFrame:
        return rows.select("call_id", "name", zero, message.alias("output"))

    asked = calls.filter(F.col("name") == "read")
    named = asked.filter(F.col("_path").isNotNull())
    texts, paths = corpus.withColumnRenamed("path", "_path"), named.select("_path").distinct()
    if paths.limit(FEW_PATHS + 1).count() <= FEW_PATHS:  # then only the texts that are read move
        texts = texts.join(F.broadcast(paths), "_path", "left_semi")
    outputs = [
        named.join(texts, "_path", "left").select(
            "call_id", "name", zero,
            capped(F.coalesce(read_slice(F.col("text"), F.col("_offset"), F.col("_limit")),
                              F.concat(F.lit("error: not a file: "), F.col("_path")))).alias("output")),
        failed(asked.filter(F.col("_path").isNull()), F.lit("error: 'path'"))]
    searches = calls.filter(F.col("name").isin("grep", "glob"))
    outputs.append(failed(searches.filter(F.col("_pat").isNull()), F.lit("error: 'pat'")))
    searches = searches.filter(F.col("_pat").isNotNull()).select("call_id", "name", "_pat")
    greps, globs = searches.filter("name = 'grep'"), searches.filter("name = 'glob'")
    patterns = shared_table(greps.select("_pat").distinct().withColumn("_error", F.pandas_udf(_pattern_errors, "string")("_pat")), "expressions")
    outputs.append(failed(greps.join(patterns.filter(F.col("_error").isNotNull()), "_pat"), F.col("_error")))
    good = patterns.filter(F.col("_error").isNull()).select(F.col("_pat").alias("pattern"), F.col("_pat").alias("regex"))
    if not good.isEmpty():
        hits = trigrams.search(index or trigrams.build_index(corpus), good, pattern_block)
        outputs.append(_answered(greps, hits, F.concat(
            F.coalesce(F.concat("path", F.lit(":")), F.lit("")), F.col("line_no").cast("string"), F.lit(":"), F.col("line"))))
    if not globs.isEmpty():
        outputs.append(_answered(globs, _glob_hits(globs.select(F.col("_pat").alias("pattern")), corpus, pattern_block), F.col("path")))
    known = ["read", "grep", "glob", *(extra or {})]
    unknown = calls.filter(F.col("name").isNull() | ~F.col("name").isin(*known))
    outputs.append(failed(unknown, F.concat(F.lit("error: unknown tool '"), F.coalesce("name", F.lit("null")), F.lit("'"))))
    for name, fn in (extra or {}).items():
        outputs.append(fn(calls.filter(F.col("name") == name), corpus).select("call_id", "name", "seq", "output"))
    result = outputs[0]
    for more in outputs[1:]:
        result = result.unionByName(more)
    return result
