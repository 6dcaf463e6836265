"""Transcript records to threads to training examples.

A transcript file is a forest: each record names its parent.  A thread is the path from a
leaf up to the root, at most ``MAX_NODES`` records long.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions import text as X
from weftline.functions.vectors import let
from weftline.operators.ordering import first_per_key, smallest_by_hash
from weftline.session import cut_lineage

# Limits and the tools whose calls are kept.
MAX_NODES = 60
MAX_TURNS = 12
MAX_RESULT_CHARS = 800
MAX_EXAMPLES = 500
OPENING_CHARS = 100
TARGET_TOOLS = ("Bash", "Read", "Write", "Edit", "Glob", "Grep")


def candidate_records(records: DataFrame) -> DataFrame:
    """Records that may be part of a thread: they have a uuid and come from user or assistant."""
    return records.filter((F.col("uuid") != "") & F.col("type").isin("user", "assistant"))


def nodes(records: DataFrame) -> DataFrame:
    """One node per (file, uuid): the last record wins, the first place stays.

    The table is narrow on purpose; contents stay in the records until the end.
    """
    grouped = candidate_records(records).groupBy("file", "uuid").agg(
        F.max_by(F.struct("parent", "type"), "line_no").alias("_r"), F.min("line_no").alias("first_line"),
        F.max("line_no").alias("last_line"))
    return grouped.select("file", "uuid", "first_line", "last_line", "_r.parent", "_r.type")


def leaves(records: DataFrame, node_table: DataFrame) -> DataFrame:
    """Nodes no kept record calls its parent.  Parents are made distinct before the join."""
    parents = (
        candidate_records(records).filter(F.col("parent") != "")
        .select("file", F.col("parent").alias("uuid")).distinct()
    )
    return node_table.select("file", "uuid", "first_line").join(parents, ["file", "uuid"], "left_anti")


def walk_up(node_table: DataFrame, leaf_table: DataFrame, limit: int = MAX_NODES) -> DataFrame:
    """(file, leaf, depth, uuid) for every node on the way up, leaf at depth 0.

    Jump tables double each round (1, 2, 4, ... steps up), so a walk of 60 takes six joins.
    A parent that is not a node ends the walk.  Only ids move, never contents.  Pass a
    materialised ``node_table``: it is read several times.
    """
    ids = node_table.select("file", "uuid")
    links = node_table.filter(F.col("parent") != "").select("file", "uuid", F.col("parent").alias("up"))
    # a node without parents below it in the table keeps no link
    jump = links.join(ids.withColumnRenamed("uuid", "up"), ["file", "up"], "left_semi").select("file", "uuid", "up")
    front = leaf_table.select("file", F.col("uuid").alias("leaf"), F.lit(0).alias("depth"), "uuid")
    width = 1
    while width < limit:
        # a node below which many leaves meet is a hot key of ``front`` only; the jump table is
        # unique, so adaptive execution can split that key over several tasks
        reached = front.join(jump, ["file", "uuid"], "left")
        steps = F.array(
            F.struct(F.col("depth").alias("depth"), F.col("uuid").alias("uuid")),
            F.struct((F.col("depth") + width).alias("depth"), F.col("up").alias("uuid")))
        front = reached.select("file", "leaf", F.explode(
            F.filter(steps, lambda s: s["uuid"].isNotNull() & (s["depth"] < limit))).alias("_s")
        ).select("file", "leaf", "_s.depth", "_s.uuid")
        width *= 2
        if width < limit:
            further = jump.select("file", F.col("uuid").alias("up"), F.col("up").alias("top"))
            jump = jump.join(further, ["file", "up"]).select("file", "uuid", F.col("top").alias("up"))
            if width in (4, 16, 64):  # every second round; the plan would double with each round otherwise
                jump = cut_lineage(jump)
    return front


def threads(walks: DataFrame) -> DataFrame:
    """Root-to-leaf uuid list per leaf (bounded by the walk limit)."""
    path = F.sort_array(F.collect_list(F.struct(-F.col("depth"), F.col("uuid").alias("uuid"))))
    listed = walks.groupBy("file", "leaf").agg(F.transform(path, lambda s: s["uuid"]).alias("path"))
    return listed.dropDuplicates(["file", "path"])


# ---------------------------------------------------------------- record to message

def _blocks(content: Column) -> Column:
    return F.try_variant_get(content, "$", "array<variant>")


def _field(block: Column, name: str, kind: str = "string") -> Column:
    return F.try_variant_get(block, f"$.{name}", kind)


def tool_result_text(inner: Column, limit: int | None = MAX_RESULT_CHARS) -> Column:
    """Text of a tool result: a string, or the text blocks of a list; cut to ``limit`` (None: whole)."""
    parts = F.try_variant_get(inner, "$", "array<variant>")
    joined = F.array_join(F.transform(F.filter(parts, lambda b: _field(b, "type") == "text"),
                                      lambda b: F.coalesce(_field(b, "text"), F.lit(""))), "\n")
    is_text = F.schema_of_variant(inner) == "STRING"
    text = F.when(is_text, F.try_variant_get(inner, "$", "string")).when(parts.isNotNull(), joined)
    return X.cut(F.coalesce(text, F.lit("")), limit)


def _is_list(content: Column) -> Column:
    return F.schema_of_variant(content).startswith("ARRAY")


def user_text(content: Column, result_chars: int | None = MAX_RESULT_CHARS) -> Column:
    """User message text; tool results win over text blocks; null when nothing is left."""
    def from_list(blocks: Column) -> Column:
        results = F.filter(
            F.transform(F.filter(blocks, lambda b: _field(b, "type") == "tool_result"),
                        lambda b: tool_result_text(_field(b, "content", "variant"), result_chars)),
            lambda s: s != "")
        texts = F.transform(F.filter(blocks, lambda b: _field(b, "type") == "text"),
                            lambda b: F.coalesce(_field(b, "text"), F.lit("")))
        as_json = F.transform(results, lambda s: F.struct(F.lit("tool_result").alias("type"), s.alias("content")))
        return F.when(F.size(results) > 0, F.to_json(as_json)).otherwise(X.strip(F.array_join(texts, " ")))

    text = F.when(_is_list(content), let(_blocks(content), from_list)).when(
        F.schema_of_variant(content) == "STRING", X.strip(F.try_variant_get(content, "$", "string")))
    return F.when(text != "", text)


def assistant_text(content: Column) -> Column:
    """Assistant message text from block lists only; known tool calls win over text."""
    def from_list(blocks: Column) -> Column:
        calls = F.transform(
            F.filter(blocks, lambda b: (_field(b, "type") == "tool_use") & _field(b, "name").isin(*TARGET_TOOLS)),
            lambda b: F.struct(F.lit("tool_use").alias("type"), _field(b, "name").alias("name"),
                               F.coalesce(_field(b, "input", "variant"), F.parse_json(F.lit("{}"))).alias("input")))
        texts = F.filter(F.transform(F.filter(blocks, lambda b: _field(b, "type") == "text"),
                                     lambda b: X.strip(F.coalesce(_field(b, "text"), F.lit("")))), lambda s: s != "")
        return F.when(F.size(calls) > 0, F.to_json(calls)).otherwise(F.array_join(texts, "\n"))

    text = F.when(_is_list(content), let(_blocks(content), from_list))
    return F.when(text != "", text)


def node_messages(records: DataFrame, node_table: DataFrame, result_chars: int | None = MAX_RESULT_CHARS) -> DataFrame:
    """Role and text per node from the JSON of its content; nodes without text give no row.

    Texts are made where the records lie and shuffled once, to keep the winning record of a
    repeated uuid.
    """
    parsed = candidate_records(records).withColumn("_v", F.try_parse_json("content"))
    text = F.when(F.col("type") == "user", user_text(F.col("_v"), result_chars)).otherwise(assistant_text(F.col("_v")))
    texts = parsed.select("file", "uuid", "line_no", F.col("type").alias("role"), text.alias("text")).filter(
        "text IS NOT NULL")
    winners = node_table.select("file", "uuid", F.col("last_line").alias("line_no"))
    return texts.join(winners, ["file", "uuid", "line_no"], "left_semi").drop("line_no")


# ---------------------------------------------------------------- threads to examples

def is_valid(m: Column) -> Column:
    """Starts with a plain user turn, ends with the assistant, alternates, calls a tool."""
    n = F.size(m)
    same = F.zip_with(F.slice(m, F.lit(1), F.greatest(n - 1, F.lit(0))),
                      F.slice(m, F.lit(2), F.greatest(n - 1, F.lit(0))),
                      lambda a, b: a["role"] == b["role"])
    first, last = F.get(m, F.lit(0)), F.get(m, n - 1)
    return (
        (n >= 2) & (first["role"] == "user") & ~first["content"].startswith("[") & (last["role"] == "assistant")
        & F.exists(m, lambda x: (x["role"] == "assistant") & x["content"].startswith("["))
        & ~F.exists(same, lambda s: s)
    )


def windows(m: Column, size: int = MAX_TURNS) -> Column:
    """Valid windows starting at every second message; a trailing user turn is dropped."""
    def piece(start: Column) -> Column:
        def trim(w: Column) -> Column:
            return F.when(F.get(w, F.size(w) - 1)["role"] == "assistant", w).otherwise(
                F.slice(w, F.lit(1), F.size(w) - 1))

        return let(F.slice(m, start + 1, F.lit(size)), trim)

    starts = F.sequence(F.lit(0), F.greatest(F.size(m) - 2, F.lit(0)), F.lit(2))
    return F.when(F.size(m) >= 2, F.filter(F.transform(starts, piece), is_valid))


def thread_messages(walks: DataFrame, messages: DataFrame) -> DataFrame:
    """Message list per thread in order; nodes without a message leave no gap."""
    placed = walks.join(messages, ["file", "uuid"])  # messages are unique per node, see walk_up
    ordered = F.sort_array(F.collect_list(F.struct(
        (-F.col("depth")).alias("p"), F.col("role").alias("role"), F.col("text").alias("content"))))
    return placed.groupBy("file", "leaf").agg(
        F.transform(ordered, lambda s: F.struct(s["role"].alias("role"), s["content"].alias("content")))
        .alias("messages"))


def examples(threaded: DataFrame, max_turns: int | None = MAX_TURNS) -> DataFrame:
    """Whole valid threads of at most ``max_turns`` (None: any length), windows of all others: adds ``window`` and ``messages``."""
    m = F.col("messages")
    whole = is_valid(m) if max_turns is None else is_valid(m) & (F.size(m) <= max_turns)
    others = [c for c in threaded.columns if c != "messages"]
    return threaded.select(
        *others, F.posexplode(F.when(whole, F.array(m)).otherwise(windows(m, max_turns or MAX_TURNS))).alias("window", "messages"))


def distinct_openings(example_table: DataFrame, order: list[str], opening_chars: int | None = OPENING_CHARS) -> DataFrame:
    """First example per opening: ``opening_chars`` characters of the first message (None: all of it)."""
    opening = X.cut(F.col("messages")[0]["content"], opening_chars)
    return first_per_key(example_table, opening, order)


def sample_examples(example_table: DataFrame, keys: list[str], seed: int = 42, n: int | None = MAX_EXAMPLES) -> DataFrame:
    """``n`` examples by seeded order (None: all)."""
    return example_table if n is None else smallest_by_hash(example_table, seed, keys, n)


def build_examples(records: DataFrame, seed: int = 42, n: int | None = MAX_EXAMPLES) -> DataFrame:
    """Records (file, line_no, uuid, parent, type, content JSON) to at most ``n`` examples."""
    table = cut_lineage(nodes(records))
    ends = leaves(records, table)
    walks = walk_up(table, ends)
    threaded = thread_messages(walks, node_messages(records, table))
    ordered = threaded.join(ends.withColumnRenamed("uuid", "leaf"), ["file", "leaf"])
    found = examples(ordered)
    kept = distinct_openings(found, ["file", "first_line", "window"])
    return sample_examples(kept, ["file", "first_line", "window"], seed, n)
