r"""Chat formatting as a prefix tree of token rows.

A turn is written as ``<turn:ROLE>TEXT</turn>`` and a line feed.  Inside roles and texts a backslash is doubled and the two
control strings get one after their ``<`` (a role's ``>`` as well), so no control string is left in them and every
backslash begins a pair: taking the first backslash of each pair away gives the text back.

Conversations with equal first turns share those turns.  Each distinct beginning is one row of tokens; rows stand
depth-first, the heaviest branch first, so the ancestors of a row fill at most log2(tokens) + 1 intervals of the stream.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.groups import stage
from weftline.llm.prefix_trie import HEIGHT, NO_ID, chain_scan, subtree_sums, turn_digest, walks
from weftline.llm.running import running
from weftline.operators.lookup import lookup_join

OPEN, CLOSE = "<turn:", "</turn>"
LEARNED = "assistant"
#: the published pattern of the byte-level vocabulary, a fixed value
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SLICE = 1 << 15  # characters encoded at once
RUN = 1 << 10  # rows of an interval that are listed at once

_PAIR = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"<turn:((?:[^\\>]|\\.)*)>(.*)</turn>\n", re.S)
_CUT = "struct<stop:bigint,start:bigint,row_stop:bigint,row_start:bigint>"
_STATE = f"struct<stop:bigint,row:bigint,pos:bigint,cuts:array<{_CUT}>>"


def default_ranks_path() -> str:
    return os.environ.get("CHAT_RANKS", "/opt/tokenizers/byte_bpe_50k.tiktoken")


@lru_cache(maxsize=2)
def tokenizer(ranks: bytes) -> tiktoken.Encoding:
    """Byte-level tokenizer of a rank file's content; built once per worker."""
    pairs = (line.split() for line in ranks.splitlines() if line.strip())
    return tiktoken.Encoding("chat", pat_str=PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs}, special_tokens={})


def escape(text: str, role: bool = False) -> str:
    text = text.replace("\\", "\\\\").replace(CLOSE, "<\\" + CLOSE[1:]).replace(OPEN, "<\\" + OPEN[1:])
    return text.replace(">", "\\>") if role else text


def unescape(text: str) -> str:
    return _PAIR.sub(r"\1", text)


def turn_parts(role: str, text: str) -> tuple[str, str, str]:
    """Head, body and foot of a formatted turn."""
    return f"{OPEN}{escape(role, True)}>", escape(text), CLOSE + "\n"


def turn_ids(coder: tiktoken.Encoding, role: str, text: str) -> tuple[list[int], int, int]:
    """Token ids of a turn, and where its body begins and ends among them; parts never share a token."""
    parts = [[i for at in range(0, len(p), SLICE) for i in coder.encode_ordinary(p[at:at + SLICE])] for p in turn_parts(role, text)]
    return sum(parts, []), len(parts[0]), len(parts[0]) + len(parts[1])


def _distinct_turns(rows: DataFrame, ranks: bytes) -> DataFrame:
    """Tokens of every distinct turn: ``(digest, ids, loss_from, loss_to)``; no loss span where the model does not speak."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer(ranks)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                done = [(*turn_ids(coder, role, text), role == LEARNED) for role, text in zip(part.column(1).to_pylist(), part.column(2).to_pylist())]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([d[0] for d in done], pa.list_(pa.int32())),
                    pa.array([d[1] if d[3] else None for d in done], pa.int32()), pa.array([d[2] if d[3] else None for d in done], pa.int32())],
                    ["digest", "ids", "loss_from", "loss_to"])

    return rows.select("digest", "role", "text").dropDuplicates(["digest"]).mapInArrow(
        run, "digest binary, ids array<int>, loss_from int, loss_to int")


def _join(a: Column, b: Column) -> Column:
    """Layout of a stretch of a path and the stretch below it; all numbers count from the end of the turn above."""
    moved = F.transform(b["cuts"], lambda c: F.struct((c["stop"] + a["stop"]).alias("stop"), (c["start"] + a["stop"]).alias("start"),
                                                      (c["row_stop"] + a["row"]).alias("row_stop"), (c["row_start"] + a["row"]).alias("row_start"))).cast(f"array<{_CUT}>")
    return F.struct((a["stop"] + b["stop"]).alias("stop"), (a["row"] + b["row"]).alias("row"), (a["pos"] + b["pos"]).alias("pos"),
                    F.concat(a["cuts"], moved).alias("cuts"))


def _intervals(state: Column) -> Column:
    """Stretches of the stream that hold a row and its ancestors: token and row bounds, ends exclusive."""
    zero = F.lit(0).cast("bigint")
    starts = F.concat(F.array(F.struct(zero.alias("start"), zero.alias("row_start"))),
                      F.transform(state["cuts"], lambda c: F.struct(c["start"].alias("start"), c["row_start"].alias("row_start"))))
    stops = F.concat(F.transform(state["cuts"], lambda c: F.struct(c["stop"].alias("stop"), c["row_stop"].alias("row_stop"))),
                     F.array(F.struct(state["stop"].alias("stop"), state["row"].alias("row_stop"))))
    both = F.zip_with(starts, stops, lambda a, b: F.struct(a["start"].alias("first_token"), b["stop"].alias("next_token"),
                                                           a["row_start"].alias("first_row"), b["row_stop"].alias("next_row")))
    return F.filter(both, lambda x: x["first_token"] < x["next_token"])


def format_chats(talks: DataFrame, ranks: bytes | None = None, height: int = HEIGHT) -> tuple[DataFrame, DataFrame]:
    """The token stream and the threads through it, both stored.

    ``talks(conv_id, turn, role, text)``: turns in order, null first, equal numbers in the order of a digest of role and
    text; null roles and texts count as empty; rows without ``conv_id`` form one conversation.  Other columns are not read.

    Stream rows ``(row, depth, first_token, ids, position_ids, attends, loss_from, loss_to)`` are numbered depth-first and stored
    in that order.  ``attends`` lists the intervals of the stream that the row's tokens see: its ancestors and, up to the token
    itself, its own row.  ``position_ids`` count along the path.  The loss span counts tokens inside the row.
    Thread rows are ``(conv_id, n_turns, attends)``: the intervals that make up one conversation.
    """
    if ranks is None:
        with open(default_ranks_path(), "rb") as f:
            ranks = f.read()
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    one = F.lit(1).cast("bigint")
    rows = stage(talks.select(F.coalesce(F.col("conv_id").cast("bigint"), F.lit(NO_ID)).alias("chain"), "turn", role.alias("role"), text.alias("text"),
                              turn_digest(role, text).alias("digest"), one.alias("one")), "chat-turns")
    pieces = stage(_distinct_turns(rows, ranks), "chat-pieces")

    placed = running(rows.select("chain", "turn", "digest", "one"), ["chain"], [F.col("turn"), F.col("digest")], ["one"])
    turns = stage(placed.select("chain", F.col("before_one").alias("i"), "digest", F.struct(
        "digest", (F.col("before_one") + 1 == F.col("all_one")).alias("ends")).alias("load")), "chat-numbered")
    most = turns.agg(F.max("i")).first()[0] or 0
    walk = stage(walks(turns, most, height), "chat-walks")
    nodes = walk.groupBy("key", "parent", "i", F.col("load.digest").alias("digest")).agg(F.min("chain").alias("chain"))
    nodes = stage(lookup_join(nodes, pieces.select("digest", F.size("ids").cast("bigint").alias("tokens")), ["digest"]).withColumn("rows", one), "chat-nodes")

    paths = walk.select("chain", "i", "key")
    below = subtree_sums(paths, nodes.select("key", "chain", "i", "tokens", "rows"), ["tokens", "rows"], most, height)
    sized = nodes.select("key", F.coalesce("parent", F.unhex(F.lit(""))).alias("parent"), F.col("tokens").alias("own"), "chain").join(below, "key")
    order = running(stage(sized, "chat-sized"), ["parent"], [F.col("tokens").desc(), F.col("chain")], ["tokens", "rows"])
    skip, skip_rows = F.col("before_tokens"), F.col("before_rows")
    cut = F.struct(F.lit(0).cast("bigint").alias("stop"), skip.alias("start"), F.lit(0).cast("bigint").alias("row_stop"), skip_rows.alias("row_start"))
    state = F.struct((skip + F.col("own")).alias("stop"), (skip_rows + 1).alias("row"), F.col("own").alias("pos"),
                     F.filter(F.array(cut), lambda c: c["start"] > 0).alias("cuts")).cast(_STATE)
    states = stage(order.select("key", state.alias("v")), "chat-states")
    laid = stage(chain_scan(lookup_join(walk, states, ["key"]).select("chain", "i", "v", "load"), _join, most, height).select(
        "chain", "i", "load", "after"), "chat-laid")

    stream = nodes.select("chain", "i", "tokens").join(laid, ["chain", "i"]).select(
        (F.col("after.row") - 1).alias("row"), F.col("i").alias("depth"), (F.col("after.stop") - F.col("tokens")).alias("first_token"),
        F.col("load.digest").alias("digest"), F.sequence(F.col("after.pos") - F.col("tokens"), F.col("after.pos") - 1).alias("position_ids"),
        _intervals(F.col("after")).alias("attends"))
    stream = lookup_join(stream, pieces, ["digest"]).select(
        "row", "depth", "first_token", "ids", "position_ids", "attends", "loss_from", "loss_to")
    stream = stage(stream.repartitionByRange("row").sortWithinPartitions("row"), "chat-stream")
    threads = laid.filter("load.ends").select(F.when(F.col("chain") != NO_ID, F.col("chain")).alias("conv_id"), (F.col("i") + 1).alias("n_turns"),
                                              _intervals(F.col("after")).alias("attends"))
    return stream, stage(threads, "chat-threads")


def read_turns(stream: DataFrame, ranks: bytes | None = None) -> DataFrame:
    """Turns back from the tokens: ``(row, role, text, learned, chars)``; ``learned`` is the text under the loss span, if any."""
    if ranks is None:
        with open(default_ranks_path(), "rb") as f:
            ranks = f.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer(ranks)
        for batch in batches:
            out = []
            for row, ids, begin, end in zip(*[batch.column(k).to_pylist() for k in range(4)]):
                shown = coder.decode_bytes(ids).decode()
                found = _TURN.fullmatch(shown)
                if found is None:
                    raise ValueError(f"row {row} of the stream is not one turn")
                learned = None if begin is None else unescape(coder.decode_bytes(ids[begin:end]).decode())
                out.append((row, unescape(found[1]), unescape(found[2]), learned, len(shown)))
            kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate(kinds)], ["row", "role", "text", "learned", "chars"])

    return stream.select("row", "ids", "loss_from", "loss_to").mapInArrow(run, "row bigint, role string, text string, learned string, chars bigint")


def read_chats(stream: DataFrame, threads: DataFrame, ranks: bytes | None = None) -> DataFrame:
    """Digests of every conversation as its intervals of the stream give it back.

    ``(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)``.  A conversation's turns pass one
    hash in order; only its state is kept.
    """
    spans = threads.select(F.coalesce("conv_id", F.lit(NO_ID)).alias("conv_id"), F.inline("attends"))
    runs = spans.select("conv_id", "first_row", "next_row", F.explode(F.expr(f"sequence(first_row div {RUN}, (next_row - 1) div {RUN})")).alias("run"))
    listed = runs.select("conv_id", F.explode(F.sequence(F.greatest(F.col("first_row"), F.col("run") * RUN),
                                                         F.least(F.col("next_row"), (F.col("run") + 1) * RUN) - 1)).alias("row"))
    turns = lookup_join(listed, stage(read_turns(stream, ranks), "chat-read"), ["row"])
    dealt = turns.select("conv_id", "row", "role", "text", "learned", "chars").repartition("conv_id").sortWithinPartitions("conv_id", "row")
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, n, all_hash, n_loss, loss_hash, chars = None, 0, None, 0, None, 0

        def rows(done: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], t) for k, t in enumerate(kinds)], names)

        for batch in batches:
            done = []
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for c, _, role, text, learned, size in zip(*[part.column(k).to_pylist() for k in range(6)]):
                    if c != conv:
                        if n:
                            done.append((conv, n, all_hash.hexdigest(), n_loss, loss_hash.hexdigest(), chars))
                        conv, n, all_hash, n_loss, loss_hash, chars = c, 0, hashlib.sha256(), 0, hashlib.sha256(), 0
                    n += 1
                    chars += size
                    all_hash.update(f"{role}\n{text}\n".encode())
                    if learned is not None:
                        n_loss += len(learned)
                        loss_hash.update(learned.encode())
            yield rows(done)
        if n:
            yield rows([(conv, n, all_hash.hexdigest(), n_loss, loss_hash.hexdigest(), chars)])

    done = dealt.mapInArrow(run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
    return done.withColumn("conv_id", F.when(F.col("conv_id") != NO_ID, F.col("conv_id")))
