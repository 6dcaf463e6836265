"""Training rows: follow-up filter, first-seen dedup, caps, rendering, split and statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions import plugs
from weftline.functions import text as X
from weftline.functions.vectors import let
from weftline.operators.ordering import flag_first_by_hash, order_statistics, seeded_hash

# Caps.
MAX_TOKENS = 1024
MAX_TOOL_CALLS = 2
MAX_MESSAGES = 7
VALID_SHARE = 0.2
OPENING_CHARS = 120
QUESTION_CHARS = 500
IGNORED_LABEL = -100

# First user turns that only acknowledge something.
ACKNOWLEDGEMENTS = (
    "ok", "okay", "k", "yes", "yeah", "yep", "yup", "no", "nope", "nah", "correct", "right", "thanks",
    "thank you", "thx", "ty", "got it", "cool", "nice", "great", "perfect", "continue", "next", "more",
    "please", "pls", "sure", "hmm", "hm", "interesting", "exactly", "i see", "understood", "alright",
    "all right", "do it", "try again", "again", "go ahead", "proceed", "mhm", "indeed", "sounds good", "agreed",
)
FOLLOW_UP_STARTS = (
    "now what", "what now", "what next", "and now", "so what", "what about now", "ok so what", "yes what", "ok next",
)
ONE_WORD_ACK = r"^(?:ok(?:ay)?|yes|yeah|yep|no|nope|correct|right|thanks?|thx|sure|got it)[\s,!.]*$"
TWO_FILLERS = (
    r"^(?:ok|okay|yes|yeah|thanks?|thx|sure|cool|nice|great)[\s,!.]+"
    r"(?:ok|okay|yes|yeah|thanks?|thx|sure|cool|nice|great|please|pls)[\s,!.]*$"
)
TOOL_CALL = r'"type":\s*"tool_use"'
QUESTION = r"(?s)user<\|message\|>(.*?)<\|end\|>"
RESPONSE_MARK = "### Response:"


def first_user_text(messages: Column) -> Column:
    """Content of the first user message, empty when there is none."""
    return F.coalesce(F.get(F.filter(messages, lambda m: m["role"] == "user"), F.lit(0))["content"], F.lit(""))


def is_follow_up(content: Column) -> Column:
    """Does the opening read like a reply inside a conversation?"""
    def judge(t: Column) -> Column:
        starts = F.lit(False)
        for p in FOLLOW_UP_STARTS:
            starts = starts | (t == p) | t.startswith(p + " ") | t.startswith(p + "?")
        return (
            (t == "") | t.isin(*ACKNOWLEDGEMENTS) | t.rlike(ONE_WORD_ACK) | starts
            | ((F.length(t) <= 40) & t.rlike(TWO_FILLERS))
        )

    return let(F.regexp_replace(F.lower(X.strip(F.coalesce(content, F.lit("")))), r"\s+", " "), judge)


def tool_calls(messages: Column) -> Column:
    counts = F.transform(
        F.filter(messages, lambda m: m["role"] == "assistant"),
        lambda m: F.regexp_count(m["content"], F.lit(TOOL_CALL)))
    return F.aggregate(counts, F.lit(0), lambda a, x: a + x)


def render_chat(messages: Column) -> Column:
    """The conversation in channel-marked template form."""
    def turn(m: Column) -> Column:
        return (
            F.when(m["role"] == "system", F.concat(F.lit("<|start|>system<|message|>"), m["content"], F.lit("<|end|>\n")))
            .when(m["role"] == "assistant", F.concat(
                F.lit("<|start|>assistant<|channel|>final<|message|>"), m["content"], F.lit("<|end|>")))
            .when(m["role"] == "user", F.concat(F.lit("<|start|>user<|message|>"), m["content"], F.lit("<|end|>")))
            .otherwise(F.lit(""))
        )

    return F.array_join(F.transform(messages, turn), "")


def prepare(rows: DataFrame, order: list[str], tokenizer=None, max_tool_calls: int | None = MAX_TOOL_CALLS,
            max_messages: int | None = MAX_MESSAGES, max_tokens: int | None = MAX_TOKENS,
            opening_chars: int | None = OPENING_CHARS) -> DataFrame:
    """Judge every row: adds text, n_tokens and ``reason`` (null for rows that are kept).

    A limit of None is no limit; :func:`reason_counts` tells how many rows each one took.

    Rows carry ``messages`` or a ready ``text``.  An opening is used up by its first row,
    even when that row is dropped by a cap afterwards.
    """
    ready = F.col("messages").isNull() & F.col("text").isNotNull()
    judged = rows.withColumn("_first", first_user_text(F.col("messages"))).withColumn(
        "_ready", ready).withColumn("_follow", ~F.col("_ready") & is_follow_up(F.col("_first")))
    # winners are found by an aggregate and joined back on the unique order key, so an
    # opening shared by very many rows is never gathered
    winners = (
        judged.filter(~F.col("_ready") & ~F.col("_follow"))
        .groupBy(X.cut(F.col("_first"), opening_chars).alias("_key"))
        .agg(F.min(F.struct(*order)).alias("_w")).select("_w.*").withColumn("_winner", F.lit(True))
    )
    m = F.col("messages")
    full = judged.join(winners, order, "left").withColumn(
        "text", F.when(F.col("_ready"), F.col("text")).otherwise(render_chat(m)))
    full = full.withColumn("n_tokens", plugs.token_count("text", tokenizer))
    capped = ~F.col("_ready")

    def over(value: Column, limit: int | None) -> Column:
        return F.lit(False) if limit is None else value > limit

    reason = (
        F.when(F.col("_follow"), "follow-up")
        .when(capped & F.col("_winner").isNull(), "repeated opening")
        .when(capped & ~F.coalesce(F.get(m, F.size(m) - 1)["role"] == "assistant", F.lit(False)), "no final answer")
        .when(capped & over(tool_calls(m), max_tool_calls), "too many tool calls")
        .when(capped & over(F.size(m), max_messages), "too many messages")
        .when(over(F.col("n_tokens"), max_tokens), "too many tokens")
    )
    return full.withColumn("reason", reason).drop("_first", "_ready", "_follow", "_winner")


def reason_counts(prepared: DataFrame) -> DataFrame:
    return prepared.groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def split(kept: DataFrame, order: list[str], seed: int = 42, share: float = VALID_SHARE) -> DataFrame:
    """Add ``is_valid`` for exactly max(1, floor(n * share)) rows of the seeded order."""
    return flag_first_by_hash(kept, seed, order, lambda n: max(1, int(n * share)), "is_valid")


def token_statistics(kept: DataFrame) -> DataFrame:
    """Smallest, upper median, floor mean and largest token count; nulls for no rows."""
    total = kept.agg(F.count(F.lit(1)).alias("n"), F.sum("n_tokens").alias("s"), F.min("n_tokens").alias("lo"),
                     F.max("n_tokens").alias("hi")).first()
    n = total["n"]
    median = order_statistics(kept, "n_tokens", {"m": n // 2})["m"] if n else None
    row = (total["lo"], median, total["s"] // n if n else None, total["hi"])
    return kept.sparkSession.createDataFrame(
        [row], "min_tokens bigint, median_tokens bigint, mean_tokens bigint, max_tokens bigint")


def instruction_text(instruction: Column, response: Column) -> Column:
    return F.concat(F.lit("### Instruction: "), instruction, F.lit("\n### Response: "), response)


def completion_labels(tokens: Column, marker: list[str]) -> Column:
    """Token ids with everything up to and including the marker masked; all masked without one.

    ``tokens`` is an array of (text, id) structs.
    """
    n = len(marker)
    wanted = F.array(*[F.lit(x) for x in marker])

    def mask(t: Column) -> Column:
        words = F.transform(t, lambda x: x["text"])
        starts = F.filter(
            F.transform(words, lambda _, i: F.when(F.slice(words, i + 1, F.lit(n)) == wanted, i)),
            lambda i: i.isNotNull())
        return let(F.get(starts, F.lit(0)), lambda s: F.transform(
            t, lambda x, i: F.when(s.isNull() | (i < s + n), F.lit(IGNORED_LABEL)).otherwise(x["id"])))

    return let(tokens, mask)


def pad(ids: Column, length: int, pad_id: int = 0) -> Column:
    """Exactly ``length`` ids: cut, or filled with ``pad_id``."""
    return F.concat(F.slice(ids, 1, length),
                    F.array_repeat(F.lit(pad_id), F.greatest(F.lit(length) - F.size(ids), F.lit(0))))


def attention_mask(ids: Column, length: int) -> Column:
    kept = F.least(F.size(ids), F.lit(length))
    return F.concat(F.array_repeat(F.lit(1), kept), F.array_repeat(F.lit(0), F.lit(length) - kept))


def hash_share(h: Column, start: int) -> Column:
    """Four hex digits of a hash as a number in [0, 1)."""
    return F.conv(F.substring(h, start, 4), 16, 10).cast("double") / 65536


def masked_tokens(tokens: DataFrame, keys: list[str], vocabulary_size: int, mask_id: int, *,
                  share: float = 0.15, seed: int = 42) -> DataFrame:
    """Corrupt token rows (keys, token_id) for masked-token training.

    ``share`` of the tokens get their id as label; of those 80 % become ``mask_id``, 10 % a
    random id and 10 % stay.  All choices come from a seeded hash of the row key.
    """
    h = seeded_hash(seed, *keys)
    chosen, kind = hash_share(F.col("_h"), 1) < share, hash_share(F.col("_h"), 5)
    random_id = (F.conv(F.substring("_h", 9, 6), 16, 10).cast("bigint") % vocabulary_size)
    return tokens.withColumn("_h", h).withColumns({
        "input_id": F.when(chosen & (kind < 0.8), F.lit(mask_id)).when(chosen & (kind < 0.9), random_id)
        .otherwise(F.col("token_id")).cast("bigint"),
        "label": F.when(chosen, F.col("token_id")).otherwise(F.lit(IGNORED_LABEL)).cast("bigint"),
    }).drop("_h")


def user_questions(rows: DataFrame, text_col: str = "text", row_col: str = "row_no",
                   chars: int | None = QUESTION_CHARS) -> DataFrame:
    """First user turn of rendered texts, cut to ``chars`` (None: whole); empty ones are dropped, the row number stays the id."""
    q = X.strip(F.regexp_extract(text_col, QUESTION, 1))
    return rows.select(F.col(row_col).cast("string").alias("id"), q.alias("q")).filter("q <> ''").select(
        "id", X.cut(F.col("q"), chars).alias("text"))
