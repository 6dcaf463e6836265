"""Parsing of raw model outputs, request/response conversion and evaluation reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions import text as X
from weftline.functions.vectors import let
from weftline.operators.ordering import dense_index

# Markers in raw outputs.
FINAL = "<|channel|>final<|message|>"
ANALYSIS = "<|channel|>analysis<|message|>"
STOPS = ("<|return|>", "<|end|>", "<|start|>")
CONTROL_TOKEN = r"<\|[^>]+\|>"
TURN_LEAKS = ("\nUser:", "\nSystem:", "\nHuman:", "\n\nUser:", "\n\nSystem:")
CALL_ENDS = ("</tool_call>", "</read>", "</glob>", "</grep>")
CALL_TAGS = ("read", "glob", "grep")
CLOSED_CALL = r"(?s)<tool_call>\s*(\{.*?\})\s*</tool_call>"
OPEN_CALL = r"(?s)<tool_call>\s*(\{[^<]*)"
CALL_BLOCKS = r"(?s)<tool_call>.*?</tool_call>|<(?:read|glob|grep)>.*?</(?:read|glob|grep)>"
MAX_HISTORY = 4
DEFAULT_MAX_TOKENS = 1024
DEFAULT_TEMPERATURE = 1.0
FALLBACK_SYSTEM = "You are a concise coding assistant with tool access."
RESULT_CHARS = 800
SHORT_TITLE = 60
NO_RESULT = "*(no result)*"
DASH = "—"


def final_text(raw: Column) -> Column:
    """Text behind the last final marker, cut at the first stop token."""
    return X.strip(reduce(X.before, STOPS, X.after_last(raw, FINAL)))


def without_tokens(raw: Column) -> Column:
    """Text behind the last final marker with every control token removed."""
    return X.strip(F.regexp_replace(X.after_last(raw, FINAL), CONTROL_TOKEN, ""))


def split_channels(raw: Column) -> tuple[Column, Column]:
    """(thinking, content): first analysis channel and first final channel."""
    def part(marker: str) -> Column:  # what stands between the first and the second marker
        return X.before(X.after_first(raw, marker), marker)

    thinking = F.when(F.contains(raw, F.lit(ANALYSIS)), X.strip(X.before(part(ANALYSIS), "<|end|>")))
    content = F.when(
        F.contains(raw, F.lit(FINAL)),
        X.strip(X.before(X.before(part(FINAL), "<|end|>"), "<|return|>")),
    ).otherwise(X.strip(F.regexp_replace(raw, CONTROL_TOKEN, "")))
    return F.nullif(thinking, F.lit("")), content


def is_tool_array(raw: Column) -> Column:
    """Is the text a JSON array whose first element is a tool call?"""
    t = X.strip(raw)
    first = F.try_variant_get(F.try_parse_json(t), "$[0].type", "string")
    return t.startswith("[") & F.coalesce(first == "tool_use", F.lit(False))


def _call(name: Column, args: Column) -> Column:
    return F.struct(name.alias("name"), F.to_json(args).alias("args"))


def _named_calls(bodies: Column, tools: tuple[str, ...]) -> Column:
    parsed = F.transform(bodies, F.try_parse_json)
    known = F.filter(parsed, lambda v: F.try_variant_get(v, "$.tool", "string").isin(*tools))
    return F.transform(known, lambda v: _call(
        F.try_variant_get(v, "$.tool", "string"),
        F.coalesce(F.try_variant_get(v, "$.args", "variant"), F.parse_json(F.lit("{}")))))


def balanced_prefix(s: Column) -> Column:
    """Text up to the last brace that closes everything opened before it."""
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("at"), F.lit(0).alias("last"))

    def step(state: Column, ch: Column) -> Column:
        depth = state["depth"] + F.when(ch == "{", 1).when(ch == "}", -1).otherwise(0)
        closed = (ch == "}") & (depth == 0)
        return F.struct(depth.alias("depth"), (state["at"] + 1).alias("at"),
                        F.when(closed, state["at"] + 1).otherwise(state["last"]).alias("last"))

    return F.substr(s, F.lit(1), F.aggregate(F.split(s, ""), start, step, lambda x: x["last"]))


def tool_calls(raw: Column, tools: tuple[str, ...] = CALL_TAGS, lenient: bool = True) -> Column:
    """Calls as (name, args JSON): tagged ones first, then call blocks; bad JSON is skipped.

    With ``lenient`` an unclosed block is read when nothing else was found.
    """
    def tagged_calls(tag: str) -> Column:
        bodies = F.regexp_extract_all(raw, F.lit(f"(?s)<{tag}>(.*?)</{tag}>"), F.lit(1))
        parsed = F.filter(F.transform(bodies, F.try_parse_json), lambda v: v.isNotNull())
        return F.transform(parsed, lambda v: _call(F.lit(tag), v))

    tagged = F.concat(*[tagged_calls(tag) for tag in CALL_TAGS])
    closed = F.concat(tagged, _named_calls(F.regexp_extract_all(raw, F.lit(CLOSED_CALL), F.lit(1)), tools))
    if not lenient:
        return closed
    opened = F.transform(F.regexp_extract_all(raw, F.lit(OPEN_CALL), F.lit(1)), lambda s: balanced_prefix(X.strip(s)))
    return let(closed, lambda c: F.when(F.size(c) > 0, c).otherwise(_named_calls(opened, tools)))


def first_call_only(raw: Column) -> Column:
    """Text up to the end of the first call; end tags are tried in their fixed order."""
    out = raw
    for tag in reversed(CALL_ENDS):
        at = F.instr(raw, tag)
        out = F.when(at > 0, F.substr(raw, F.lit(1), at + len(tag) - 1)).otherwise(out)
    return out


def without_leak(raw: Column) -> Column:
    """Cut where the model starts to write the next turn."""
    out = raw
    for mark in reversed(TURN_LEAKS):
        out = F.when(F.contains(raw, F.lit(mark)), X.strip(X.before(raw, mark))).otherwise(out)
    return out


def display_text(raw: Column) -> Column:
    """The answer without its call blocks."""
    return X.strip(F.regexp_replace(raw, CALL_BLOCKS, ""))


def flatten_content(content_json: Column) -> Column:
    """Content (JSON string or block list) as plain text."""
    def block(b: Column) -> Column:
        kind = F.try_variant_get(b, "$.type", "string")
        return (
            F.when(kind == "text", F.try_variant_get(b, "$.text", "string"))
            .when(kind == "tool_use", F.concat(
                F.lit('<tool_call>{"tool": "'), F.try_variant_get(b, "$.name", "string"), F.lit('", "args": '),
                F.to_json(F.try_variant_get(b, "$.input", "variant")), F.lit("}</tool_call>")))
            .when(kind == "tool_result", F.concat(
                F.lit("Tool result: "), F.coalesce(F.try_variant_get(b, "$.content", "string"), F.lit(""))))
        )

    parsed = F.try_parse_json(content_json)
    blocks = F.try_variant_get(parsed, "$", "array<variant>")
    joined = F.array_join(F.filter(F.transform(blocks, block), lambda s: s.isNotNull()), "\n")
    return F.when(F.schema_of_variant(parsed) == "STRING", F.try_variant_get(parsed, "$", "string")).otherwise(joined)


def convert_request(body: Column, suffix: str, max_history: int | None = MAX_HISTORY) -> Column:
    """Chat request in the other format: (system, messages, stream, max_tokens, temperature, stop).

    The system text is extended by ``suffix``; only the last ``max_history`` messages stay (None: all).
    """
    v = F.try_parse_json(body)

    def joined_texts(blocks: Column, sep: str) -> Column:
        texts = F.filter(blocks, lambda b: F.try_variant_get(b, "$.type", "string") == "text")
        return F.array_join(F.transform(
            texts, lambda b: F.coalesce(F.try_variant_get(b, "$.text", "string"), F.lit(""))), sep)

    system_value = F.try_variant_get(v, "$.system", "variant")
    system_list = F.try_variant_get(system_value, "$", "array<variant>")
    system_text = X.strip(F.when(system_list.isNotNull(), joined_texts(system_list, " ")).otherwise(
        F.try_variant_get(system_value, "$", "string")))
    system = F.concat(F.coalesce(F.nullif(system_text, F.lit("")), F.lit(FALLBACK_SYSTEM)), F.lit("\n\n" + suffix))

    def message(m: Column) -> Column:
        value = F.try_variant_get(m, "$.content", "variant")

        def as_text(blocks: Column) -> Column:
            structured = F.exists(blocks, lambda b: F.coalesce(
                F.try_variant_get(b, "$.type", "string").isin("tool_result", "tool_use"), F.lit(False)))
            return F.when(structured, F.to_json(value)).otherwise(joined_texts(blocks, ""))

        text = F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string")).otherwise(
            let(F.try_variant_get(value, "$", "array<variant>"), as_text))
        clean = let(text, lambda s: F.when(F.contains(s, F.lit("<|channel|>")), final_text(s)).otherwise(s))
        return F.struct(F.try_variant_get(m, "$.role", "string").alias("role"), clean.alias("content"))

    history = F.coalesce(F.try_variant_get(v, "$.messages", "array<variant>"), F.array().cast("array<variant>"))
    last = history if max_history is None else let(history, lambda h: F.slice(
        h, F.greatest(F.size(h) - max_history, F.lit(0)) + 1, F.lit(max_history)))
    head = F.struct(F.lit("system").alias("role"), system.alias("content"))
    return F.struct(
        F.concat(F.array(head), F.transform(last, message)).alias("messages"),
        F.coalesce(F.try_variant_get(v, "$.stream", "boolean"), F.lit(False)).alias("stream"),
        F.coalesce(F.try_variant_get(v, "$.max_tokens", "int"), F.lit(DEFAULT_MAX_TOKENS)).alias("max_tokens"),
        F.coalesce(F.try_variant_get(v, "$.temperature", "double"), F.lit(DEFAULT_TEMPERATURE)).alias("temperature"),
        F.coalesce(F.try_variant_get(v, "$.stop", "array<string>"), F.array().cast("array<string>")).alias("stop"))


def message_tail(raw: Column) -> Column:
    """Fallback when the final channel is empty: text behind the last message marker."""
    return X.strip(reduce(X.before, STOPS, X.strip(X.after_last(raw, "<|message|>"))))


def convert_response(body: Column) -> Column:
    """Chat response in the other format: (text, tools JSON array or null, stop_reason, tokens)."""
    v = F.try_parse_json(body)
    content = F.coalesce(F.try_variant_get(v, "$.choices[0].message.content", "string"), F.lit(""))
    calls = F.try_variant_get(v, "$.choices[0].message.tool_calls", "array<variant>")
    rebuilt = F.to_json(F.transform(calls, lambda c: F.struct(
        F.lit("tool_use").alias("type"),
        F.coalesce(F.try_variant_get(c, "$.function.name", "string"), F.lit("")).alias("name"),
        F.coalesce(F.try_parse_json(F.try_variant_get(c, "$.function.arguments", "string")),
                   F.parse_json(F.lit("{}"))).alias("input"))))
    raw = F.when((content == "") & (F.size(calls) > 0), rebuilt).otherwise(content)

    def shape(r: Column) -> Column:
        def finish(t: Column) -> Column:
            tool = is_tool_array(t)
            only_calls = F.filter(F.try_variant_get(F.try_parse_json(t), "$", "array<variant>"),
                                  lambda b: F.try_variant_get(b, "$.type", "string") == "tool_use")
            return F.struct(
                F.when(~tool, t).alias("text"), F.when(tool, F.to_json(only_calls)).alias("tools"),
                F.when(tool, "tool_use").otherwise("end_turn").alias("stop_reason"),
                F.coalesce(F.try_variant_get(v, "$.usage.prompt_tokens", "bigint"), F.lit(0)).alias("input_tokens"),
                F.coalesce(F.try_variant_get(v, "$.usage.completion_tokens", "bigint"), F.lit(0)).alias("output_tokens"))

        tail = (final_text(r) == "") & F.contains(r, F.lit("<|message|>"))
        return let(F.when(tail, message_tail(r)).otherwise(final_text(r)), finish)

    return let(raw, shape)


# ---------------------------------------------------------------- evaluation reports

def evaluation_results(log: DataFrame, result_chars: int | None = RESULT_CHARS) -> DataFrame:
    """Per model and prompt: last answer, total latency, steps, tool output cut to ``result_chars`` (None: whole).

    The log has model, prompt, step, answer, latency and tool_result.
    """
    last_result = F.max_by("tool_result", "step")
    return log.groupBy("model", "prompt").agg(
        F.max_by("answer", "step").alias("answer"),
        F.sum("latency").alias("latency"),
        F.count(F.lit(1)).alias("steps"),
        X.cut(last_result, result_chars).alias("tool_result"))


def seconds(latency: Column) -> Column:
    return F.when(latency.isNotNull(), F.concat(F.format_string("%.2f", latency), F.lit("s")))


def cell(text: Column) -> Column:
    """Text that may stand in a Markdown table cell."""
    return F.replace(F.replace(text, F.lit("\n"), F.lit("<br>")), F.lit("|"), F.lit("\\|"))


def short_title(text: Column) -> Column:
    return F.when(F.length(text) > SHORT_TITLE, F.concat(X.cut(text, SHORT_TITLE), F.lit("…"))).otherwise(text)


def pivot_results(results: DataFrame, models: list[str]) -> DataFrame:
    """One row per prompt with answer and latency of every model; gaps are marked."""
    wide = results.groupBy("prompt").pivot("model", models).agg(
        F.first("answer").alias("answer"), F.first("latency").alias("latency"))
    columns = []
    for m in models:
        columns.append(cell(F.coalesce(X.named(f"{m}_answer"), F.lit(NO_RESULT))).alias(f"{m}_answer"))
        columns.append(F.coalesce(seconds(X.named(f"{m}_latency")), F.lit(DASH)).alias(f"{m}_latency"))
    return wide.select("prompt", *columns)


def report_lines(wide: DataFrame, models: list[str]) -> DataFrame:
    """The pivot as ordered Markdown lines: (prompt, line_no, line)."""
    def row(label: str, kind: str) -> Column:
        cells = [x for m in models for x in (X.named(f"{m}_{kind}"), F.lit(" | "))][:-1]
        return F.concat(F.lit(f"| {label} | "), *cells, F.lit(" |"))

    lines = F.array(
        F.concat(F.lit("### Q: "), F.col("prompt")), F.lit(""),
        F.lit("| | " + " | ".join(models) + " |"), F.lit("|---|" + "---|" * len(models)),
        row("**Answer**", "answer"), row("**Latency**", "latency"), F.lit(""))
    return wide.select("prompt", F.posexplode(lines).alias("line_no", "line")).orderBy("prompt", "line_no")


def tool_log_blocks(log: DataFrame, keys: list[str]) -> DataFrame:
    """Readable text per step of a tool log: response, then each call with its result.

    Steps stay rows, so a long log is never gathered; order them by ``step``.
    """
    call = F.transform("tool_calls", lambda c: F.concat(
        F.lit("\n**→ "), c["tool"], F.lit("("), c["args"], F.lit(")**\n```\n"), c["result"], F.lit("\n```")))
    response = F.when(F.coalesce(F.col("response"), F.lit("")) != "", F.array("response")).otherwise(
        F.array().cast("array<string>"))
    return log.select(*keys, "step", F.array_join(F.concat(response, call), "\n").alias("block"))


def tool_logs(log: DataFrame, keys: list[str], per: int = 256) -> DataFrame:
    """One text per task: the blocks of :func:`tool_log_blocks` in step order, between blank lines.

    Runs of ``per`` steps are joined first, so a long log is put together from few long pieces.
    """
    def joined(order: str) -> Column:
        rows = F.sort_array(F.collect_list(F.struct(order, "block")))
        return F.array_join(F.transform(rows, lambda b: b["block"]), "\n\n")

    blocks = tool_log_blocks(log, keys).withColumn("_run", F.floor(F.col("step") / per))
    runs = blocks.groupBy(*keys, "_run").agg(joined("step").alias("block"))
    return runs.groupBy(*keys).agg(joined("_run").alias("tool_log"))


def scenario_order(names: DataFrame, column: str, prefix: str) -> DataFrame:
    """Names ``<prefix><number>`` with their place in numeric order; others are left out."""
    fitting = names.filter(F.col(column).rlike(f"^{prefix}\\d+$")).select(column).distinct()
    numbered = fitting.withColumn("number", F.regexp_extract(column, r"(\d+)$", 1).cast("bigint"))
    return dense_index(numbered, ["number", column])
