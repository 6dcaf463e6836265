"""Cutting texts into chunks and lines."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions import text as X
from weftline.functions import plugs
from weftline.operators.ordering import dense_index, running_total


def fixed_chunks(text: Column | str, size: int = 256, overlap: int = 32) -> Column:
    """Overlapping pieces of ``size`` characters; an empty text gives none."""
    if overlap >= size or overlap < 0:
        raise ValueError("overlap must be at least 0 and smaller than size")
    t = X.col(text)
    starts = F.sequence(F.lit(0), F.length(t) - 1, F.lit(size - overlap))
    return F.when(F.length(t) > 0, F.transform(starts, lambda i: F.substr(t, i + 1, F.lit(size)))).otherwise(
        F.array().cast("array<string>"))


def chunk_table(docs: DataFrame, text_col: str = "text", size: int = 256, overlap: int = 32) -> DataFrame:
    """One row per chunk; the other columns are repeated, the text itself is not."""
    others = [c for c in docs.columns if c != text_col]
    return docs.select(*others, F.posexplode(fixed_chunks(text_col, size, overlap)).alias("chunk_index", "chunk_text"))


def separator_chunks(text: Column | str, separator: str = "\n\n", size: int = 1000) -> Column:
    """Pieces between (literal) separators packed up to ``size``; a longer piece stays whole."""
    @F.arrow_udf("array<string>")
    def pack(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        # a fold over array expressions would copy its result for every piece
        for batch in batches:
            for part in plugs.slices(batch):
                yield pa.array([None if t is None else _packed(t, separator, size) for t in part.to_pylist()], pa.list_(pa.string()))

    return F.filter(F.transform(pack(X.col(text)), X.strip), lambda c: c != "")


def _packed(text: str, separator: str, size: int) -> list[str]:
    done: list[str] = []
    parts: list[str] = []
    length = 0
    for piece in filter(None, text.split(separator)):
        if parts and length + len(separator) + len(piece) <= size:
            length += len(separator) + len(piece)
        else:
            if parts:
                done.append(separator.join(parts))
            parts, length = [], len(piece)
        parts.append(piece)
    return [*done, separator.join(parts)] if parts else done


def _with_bases(docs: DataFrame, keys: list[str], text_col: str, n: Column) -> DataFrame:
    """Rows ``(keys, text)`` with ``_base``, when each row takes ``n`` numbers (a value of its text) in the order of the keys.

    Null keys come first, equal keys stand in the order of a digest.  Rows are numbered by name and count; a text moves once, to meet
    its number, and equal rows move as one.
    """
    shown = F.to_json(F.struct(*[F.col(k).cast("string").alias(f"k{i}") for i, k in enumerate(keys)]))
    named = docs.select(*keys, text_col, F.sha2(F.concat(shown, F.lit("\0"), F.col(text_col)), 256).alias("_name"), n.cast("bigint").alias("_n"))
    named = named.filter(F.col(text_col).isNotNull())
    order = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    counted = named.groupBy(*order, "_name").agg(F.max("_n").alias("_n"), F.count(F.lit(1)).alias("_copies"))
    upto = running_total(counted.withColumn("_all", F.col("_n") * F.col("_copies")), [*[f"_k{i}" for i in range(len(keys))], "_name"], "_all", "_upto")
    bases = upto.select("_name", (F.col("_upto") - F.col("_all")).alias("_from"), "_copies")
    met = named.dropDuplicates(["_name"]).join(bases, "_name")
    copies = met.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_copies") - 1)))
    return copies.select(*keys, text_col, (F.col("_from") + F.col("_copy") * F.col("_n")).alias("_base"))


def indexed_chunks(docs: DataFrame, key_col: str, text_col: str = "text", source_col: str | None = None,
                   size: int = 256, overlap: int = 32, embedder=None) -> DataFrame:
    """Chunks with embedding, ``metadata`` (file, chunk number) and global ids ``doc-0, doc-1, ...``.

    Documents stand in the order of their key, null first; every row has ids of its own, repeated rows as well.
    """
    # the number of chunks follows from the length, so documents are numbered and no chunk text moves for it
    n = F.ceil(F.length(text_col) / (size - overlap))
    keys = [key_col] if source_col in (None, key_col) else [key_col, source_col]
    chunks = chunk_table(_with_bases(docs, keys, text_col, n), text_col, size, overlap)
    return chunks.select(
        F.concat(F.lit("doc-"), F.col("_base") + F.col("chunk_index")).alias("id"),
        F.col("chunk_text").alias("document"),
        F.struct(F.col(source_col or key_col).cast("string").alias("file_path"),
                 F.col("chunk_index").cast("bigint").alias("chunk")).alias("metadata"),
        plugs.embed("chunk_text", embedder).alias("embedding"),
    )


def _split_lines(text: Column) -> Column:
    return F.split(F.when(text.endswith("\n"), F.substr(text, F.lit(1), F.length(text) - 1)).otherwise(text), "\n")


def lines(docs: DataFrame, key_cols: list[str], text_col: str = "text") -> DataFrame:
    """One row per line, numbered from 0; a final line break opens no further line."""
    t = F.col(text_col)
    return docs.filter(t != "").select(*key_cols, F.posexplode(_split_lines(t)).alias("line_no", "line"))


def _reason(text: Column) -> Column:
    return F.when(text == "", "Line cannot be empty.").when(F.size(X.split_words(text)) < 2, "Line must contain at least two words.")


def checked_lines(docs: DataFrame, key_cols: list[str], text_col: str = "text") -> DataFrame:
    """Every line stripped, with the reject reason; accepted ones are numbered from 0 over all documents.

    Documents are numbered, not lines: a line's number is that of the lines before its document and its place among its own.
    """
    stripped = F.transform(_split_lines(F.col(text_col)), X.strip)
    accepted = F.size(F.filter(stripped, lambda x: _reason(x).isNull()))
    placed = _with_bases(docs.filter(F.col(text_col) != ""), key_cols, text_col, accepted)
    judged = placed.withColumn("_lines", F.transform(stripped, lambda x, i: F.struct(
        i.alias("line_no"), x.alias("text"), _reason(x).alias("reason"))))

    def numbered(x: Column, line_id: Column) -> Column:
        return F.struct(x["line_no"].alias("line_no"), x["text"].alias("text"), x["reason"].alias("reason"), line_id.cast("bigint").alias("line_id"))

    taken = F.transform(F.filter("_lines", lambda x: x["reason"].isNull()), lambda x, i: numbered(x, F.col("_base") + i))
    left = F.transform(F.filter("_lines", lambda x: x["reason"].isNotNull()), lambda x: numbered(x, F.lit(None)))
    return judged.select(*key_cols, F.explode(F.concat(taken, left)).alias("_l")).select(*key_cols, "_l.*")


def check_lines(line_table: DataFrame, order: list[str]) -> DataFrame:
    """Strip lines, give the reject reason, and number the accepted ones from 0; ``order`` identifies a line.

    For a table that holds lines already; from documents :func:`checked_lines` numbers them without moving lines.
    """
    t = X.strip("line")
    checked = line_table.withColumn("text", t).withColumn("reason", _reason(F.col("text"))).drop("line")
    ids = dense_index(checked.filter(F.col("reason").isNull()).select(*order), order, "line_id")
    return checked.join(ids, order, "left")
