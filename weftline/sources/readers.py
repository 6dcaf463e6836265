"""Readers.  Every reader declares its schema and attaches the order of its rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from weftline.operators.export import EXPORT_SCHEMA
from weftline.operators.lookup import lookup_join
from weftline.operators.requests import RESPONSE_SCHEMA
from weftline.session import cut_lineage
from weftline.sources import json_array

# File types of a document tree.
DOCUMENT_TYPES = ("md", "py", "js", "ts", "java", "c", "cpp", "h", "html", "css", "txt")


def _whole_files(spark: SparkSession, paths, pattern: str | None = None, recursive: bool = False) -> DataFrame:
    reader = spark.read.option("recursiveFileLookup", recursive)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.text(paths, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("file_name"),
        F.col("value").alias("text"))


def _damaged(what: str, *where: Column) -> Column:
    return F.raise_error(F.concat_ws(" ", F.lit(f"damaged {what}:"), *[w.cast("string") for w in where]))


def exports(spark: SparkSession, path) -> DataFrame:
    """Conversations of export files (one JSON array each) with file and place ``ord``.

    The map of messages is declared, never inferred: inference would turn keys into columns.
    A large file is read by many tasks.  A file that is no JSON array is an error, and so is a damaged element, named by its first byte.
    """
    found = json_array.elements(spark, path, what="export")
    parsed = F.from_json(F.concat(F.lit("["), "text", F.lit("]")), f"array<struct<{EXPORT_SCHEMA}>>")
    one = F.when(F.size(parsed) == 1, parsed[0]).otherwise(_damaged("export", F.col("file"), F.lit("at byte"), F.col("offset")))
    rows = found.select("file", "ord", one.alias("c"))
    # times go through a variant: it keeps the digits of a number as they were written
    return rows.select(
        "file", "ord", "c.title", "c.id",
        F.try_variant_get("c.create_time", "$", "string").alias("create_time"),
        F.try_variant_get("c.update_time", "$", "string").alias("update_time"), "c.mapping")


def numbered_lines(spark: SparkSession, paths, pattern: str | None = None, recursive: bool = True) -> DataFrame:
    """Lines with file and 0-based ``line_no``; a big file is read by many tasks.

    Rows of one file block are consecutive, so a line number is the number of lines in the
    blocks before plus the place inside its own block.
    """
    return _numbered(spark, paths, pattern, recursive, None)


def _numbered(spark: SparkSession, paths, pattern: str | None, recursive: bool, intact: Column | None) -> DataFrame:
    """Numbered lines; with ``intact`` only of files of which every line fulfils it.

    One pass counts (and tests) the lines of each block and keeps one row per block; a second one reads them.
    """
    reader = spark.read.option("recursiveFileLookup", recursive)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    rows = reader.text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"),
        F.col("value").alias("line"), F.monotonically_increasing_id().alias("_at"))
    blocks = rows.groupBy("file", "_block").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"),
        F.min(F.lit(True) if intact is None else intact).alias("_ok"))
    before = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = cut_lineage(blocks.select(
        "file", "_block", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"),
        F.min("_ok").over(Window.partitionBy("file")).alias("_ok")).filter("_ok").drop("_ok"))
    placed = lookup_join(rows, starts, ["file", "_block"])
    return placed.select("file", (F.col("_base") + F.col("_at") - F.col("_first")).alias("line_no"), "line")


def json_lines(spark: SparkSession, paths, pattern: str = "*.jsonl") -> DataFrame:
    """JSON lines as variants, to be ordered by file and line number."""
    return numbered_lines(spark, paths, pattern).withColumn("record", F.try_parse_json("line"))


def intact_json_lines(spark: SparkSession, paths, pattern: str = "*.jsonl") -> DataFrame:
    """Only files of which every line parses; one bad or blank line drops its whole file."""
    rows = _numbered(spark, paths, pattern, True, F.try_parse_json("line").isNotNull())
    return rows.withColumn("record", F.try_parse_json("line"))


def transcripts(spark: SparkSession, roots) -> DataFrame:
    """Transcript records: file, line_no, uuid, parent, type and the JSON of the content."""
    rows = intact_json_lines(spark, roots)

    def field(path: str) -> Column:
        return F.try_variant_get("record", path, "string")

    content = F.to_json(F.try_variant_get("record", "$.message.content", "variant"))
    return rows.select("file", "line_no", field("$.uuid").alias("uuid"), field("$.parentUuid").alias("parent"),
                       field("$.type").alias("type"), F.coalesce(content, F.lit('""')).alias("content"))


def training_rows(spark: SparkSession, paths) -> DataFrame:
    """Training files: file_name, line_no, and either ``text`` or ``messages``.  A line that is no JSON is an error."""
    rows = json_lines(spark, paths)
    rows = rows.withColumn("record", F.when(F.col("record").isNotNull(), F.col("record")).otherwise(
        _damaged("training line", F.col("file"), F.col("line_no"))))
    kind = "array<struct<role: string, content: string>>"
    return rows.select(
        F.element_at(F.split("file", "/"), -1).alias("file"), "line_no",
        F.try_variant_get("record", "$.text", "string").alias("text"),
        F.try_variant_get("record", "$.messages", kind).alias("messages"))


def document_tree(spark: SparkSession, root: str, types: Sequence[str] = DOCUMENT_TYPES) -> DataFrame:
    """Every document of the given types below a folder, whole file per row."""
    return _whole_files(spark, root, "*.{" + ",".join(types) + "}", recursive=True)


def text_document(spark: SparkSession, path: str) -> DataFrame:
    """One document with its source as metadata."""
    return _whole_files(spark, path).select(
        "text", F.create_map(F.lit("source"), F.lit(path)).alias("metadata"))


def text_lines(spark: SparkSession, path) -> DataFrame:
    return numbered_lines(spark, path, recursive=False)


def seed_documents(spark: SparkSession, folder: str) -> DataFrame:
    """``*.txt`` of a folder in no particular order; the file stem is the document id.  No file is an error."""
    rows = _whole_files(spark, folder, "*.txt").select(
        F.regexp_extract("file_name", r"(.*)\.txt$", 1).alias("document_id"), "text")
    if rows.isEmpty():
        raise FileNotFoundError(f"no .txt files in {folder}")
    return rows


def csv_table(spark: SparkSession, path, schema: str | T.StructType, required: Sequence[str] = (),
              multi_line: bool = False) -> DataFrame:
    """CSV with header; columns are matched by name, missing required ones are an error.

    ``multi_line`` allows line breaks in quoted fields; each file is then read by one task.
    """
    header = spark.read.option("header", True).csv(path).columns
    missing = [c for c in required if c not in header]
    if missing:
        raise ValueError(f"missing columns {missing}; available: {header}")
    wanted = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    by_name = T.StructType([wanted[c] if c in wanted.names else T.StructField(c, T.StringType()) for c in header])
    return spark.read.schema(by_name).option("header", True).option("multiLine", multi_line).option("escape", '"').csv(path)


def parquet_table(spark: SparkSession, path, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return spread(df.select(*columns) if columns else df)


def spread(df: DataFrame) -> DataFrame:
    """Give every core work when the input has fewer splits than there are cores.

    A table of one file with one row group is read by one task, and all expressions behind
    the scan would run there.  Large tables have more splits than cores and stay as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def batch_outputs(spark: SparkSession, prefix: str) -> DataFrame:
    """Responses of a batch job with file and line number; no files give an empty table."""
    schema = T.StructType.fromDDL(RESPONSE_SCHEMA)
    try:
        rows = numbered_lines(spark, prefix, "*.jsonl.out")
    except Exception as e:  # an empty prefix is not a failure
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], T.StructType(
            [T.StructField("file", T.StringType()), T.StructField("line_no", T.LongType()), *schema.fields]))
    filled = rows.filter(F.trim("line") != "")
    whole = F.when(F.try_parse_json("line").isNotNull(), F.from_json("line", schema)).otherwise(
        _damaged("batch output", F.col("file"), F.col("line_no")))
    return filled.withColumn("r", whole).select("file", "line_no", "r.*")


def vector_table(spark: SparkSession, path: str, tenant=None, tenant_col: str = "user_id") -> DataFrame:
    """A stored vector table, all of it or one tenant (a pruned partition)."""
    df = spark.read.parquet(path)
    return df if tenant is None else df.filter(F.col(tenant_col) == F.lit(tenant))


def image_folder(spark: SparkSession, root: str) -> DataFrame:
    """JPG and PNG files below a folder, any case of the suffix; other files are not opened."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    return reader.option("pathGlobFilter", "*.{[jJ][pP][gG],[pP][nN][gG]}").load(root)


def file_listing(spark: SparkSession, root: str) -> DataFrame:
    """Path, size and modification time of every file; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def literal_rows(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    names = T.StructType.fromDDL(schema).names
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)
