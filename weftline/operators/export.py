"""Conversation exports: titles, messages and Markdown.

One export row holds one conversation with all its messages in ``mapping``; everything here
works inside the row, so no shuffle is needed until titles are sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions import text as X
from weftline.operators.ordering import dense_index

EXPORT_SCHEMA = """
    title string, id string, create_time variant, update_time variant,
    mapping map<string, struct<
        id: string, parent: string, children: array<string>,
        message: struct<id: string, author: struct<role: string>, create_time: string,
                        content: struct<content_type: string, parts: array<string>>>>>
"""


def titles(exports: DataFrame, order: str = "ord") -> DataFrame:
    """Title and id per conversation with defaults; ``order`` numbers the conversations from 0."""
    return exports.select(
        order,
        F.coalesce("id", F.lit("")).alias("id"),
        _title(order).alias("title"),
    )


def _title(order: str) -> Column:
    return F.coalesce("title", F.concat(F.lit("Untitled Conversation "), F.col(order).cast("string")))


def sorted_titles(exports: DataFrame, order: str = "ord") -> DataFrame:
    """Titles with their place ``idx`` in the case-insensitive, stable title order."""
    listed = titles(exports, order).withColumn("_low", F.lower("title"))
    return dense_index(listed, ["_low", order]).drop("_low")


def by_id(exports: DataFrame, conversation_id: str, order: str = "ord") -> DataFrame:
    """The first conversation with exactly this id."""
    return exports.filter(F.col("id") == conversation_id).orderBy(order).limit(1)


def by_title(exports: DataFrame, needle: str) -> DataFrame:
    """Conversations whose title contains ``needle``, ignoring case; empty titles never match."""
    return exports.filter((F.col("title") != "") & F.lower("title").contains(needle.lower()))


def by_position(exports: DataFrame, index: int, order: str = "ord") -> DataFrame:
    """The conversation at a place of the sorted title list."""
    listed = sorted_titles(exports, order)
    if not 0 <= index < listed.count():
        raise IndexError(f"no title at position {index}")
    return exports.join(listed.filter(F.col("idx") == index).select(order), order, "left_semi")


def extract_by_title_search(exports: DataFrame, needle: str, order: str = "ord") -> DataFrame:
    """The conversations that a search of the title list (with its default titles) hits."""
    return exports.filter(F.lower(_title(order)).contains(needle.lower()))


def message_array(mapping: Column | str = "mapping") -> Column:
    """Messages of a conversation by time, ties in the order of the export."""
    def stage(entry: Column, i: Column) -> Column:
        message = entry["value"]["message"]
        return F.struct(
            F.coalesce(message["create_time"].try_cast("double"), F.lit(0.0)).alias("ts"),
            i.alias("pos"),
            message["author"]["role"].alias("role"),
            message["content"]["parts"].alias("parts"),
            message["content"].isNotNull().alias("keep"),
        )

    staged = F.transform(F.map_entries(X.col(mapping)), stage)
    return F.array_sort(F.filter(staged, lambda s: s["keep"]))


def messages(exports: DataFrame, keys: list[str]) -> DataFrame:
    """One row per message with its place ``seq`` and its text parts."""
    return exports.select(*keys, F.posexplode(message_array()).alias("seq", "m")).select(
        *keys, "seq", "m.ts", "m.pos", "m.role", "m.parts")


def markdown(exports: DataFrame) -> Column:
    """The conversation as Markdown text."""
    def block(m: Column) -> Column:
        heading = F.when(m["role"].isNotNull(), F.concat(F.lit("## "), X.capitalize(m["role"]), F.lit("\n\n")))
        filled = F.filter(F.coalesce(m["parts"], F.array().cast("array<string>")),
                          lambda p: p.isNotNull() & (p != ""))
        body = F.array_join(F.transform(filled, lambda p: F.concat(p, F.lit("\n\n"))), "")
        return F.concat(F.coalesce(heading, F.lit("")), body)

    head = F.concat(F.lit("# "), F.coalesce("title", F.lit("")), F.lit("\n\n"))
    created = F.when(F.col("create_time").isNotNull(),
                     F.concat(F.lit("**Created:** "), F.col("create_time"), F.lit("\n\n")))
    ident = F.when(F.col("id").isNotNull(), F.concat(F.lit("**Conversation ID:** "), F.col("id"), F.lit("\n\n")))
    body = F.array_join(F.transform(message_array(), block), "")
    return F.concat(head, F.coalesce(created, F.lit("")), F.coalesce(ident, F.lit("")), F.coalesce(body, F.lit("")))


def render(exports: DataFrame, order: str = "ord", sanitize: bool = True) -> DataFrame:
    """File name and Markdown content per conversation."""
    titled = exports.withColumn(
        "title", F.coalesce("title", F.concat(F.lit("Conversation_"), F.col(order).cast("string"))))
    name = file_name("title") if sanitize else F.col("title")
    return titled.select(order, F.concat(name, F.lit(".md")).alias("file_name"), markdown(titled).alias("content"))


def file_name(title: Column | str) -> Column:
    """Lower case, blanks and characters that file systems refuse become ``_``."""
    return F.regexp_replace(F.replace(F.lower(X.col(title)), F.lit(" "), F.lit("_")), r'[\\/*?:"<>|]', "_")


def thread_view(thread_messages: DataFrame) -> DataFrame:
    """Messages of a thread oldest first; files and images by placeholder.

    Expects thread_id, created_at, role and content (array of type/text structs); an unknown
    block type reads as no content.
    """
    first = F.get(F.col("content"), F.lit(0))
    shown = (
        F.when(first["type"] == "file", "[File received]")
        .when(first["type"] == "image_file", "[Image received]")
        .when(first["type"] == "text", X.strip(first["text"]))
        .otherwise("[No content]")
    )
    return thread_messages.select("thread_id", "created_at", "role", shown.alias("message")).orderBy(
        "thread_id", "created_at")


