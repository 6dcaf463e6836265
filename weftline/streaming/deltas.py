"""Reassembly of streamed model answers from their delta lines."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from weftline.functions import text as X
from weftline.functions.vectors import let
from weftline.operators import model_outputs as M
from weftline.operators.lookup import lookup_join
from weftline.session import ship_package

PREFIX = "data: "
DONE = "[DONE]"
BLOCK = 1024  # deltas joined in one first-level group


def delta_text(line: Column) -> Column:
    """Text of one ``data:`` line; null for other lines, bad JSON and empty deltas."""
    data = F.substr(line, F.lit(len(PREFIX) + 1))
    text = F.try_variant_get(F.try_parse_json(data), "$.choices[0].delta.content", "string")
    return F.when(line.startswith(PREFIX), F.nullif(text, F.lit("")))


def shape_message(raw: Column) -> Column:
    """(kind, text, stop_reason) of a whole answer.

    With a final channel its text counts, cut at the first stop token; a text starting with
    ``[`` is a tool call when it parses.  Without one the unmarked text is the answer.
    """
    final = X.after_first(raw, M.FINAL)
    body = F.regexp_extract(final, r"(?s)^(.*?)(?:<\|return\|>|<\|end\|>|<\|start\|>|$)", 1)
    stripped = M.final_text(raw)
    rest = F.when(F.contains(stripped, F.lit("<|message|>")), X.strip(X.after_last(stripped, "<|message|>"))).otherwise(
        stripped)

    def classify(t: Column) -> Column:
        tool = final.isNotNull() & M.is_tool_array(t)
        text = F.when(final.isNotNull() & X.strip(t).startswith("["), X.strip(t)).otherwise(t)
        return F.struct(F.when(tool, "tool").otherwise("text").alias("kind"), text.alias("text"),
                        F.when(tool, "tool_use").otherwise("end_turn").alias("stop_reason"))

    return let(F.when(final.isNotNull(), body).otherwise(rest), classify)


def reassemble(lines: DataFrame) -> DataFrame:
    """Answers from (msg_id, seq, line) rows; lines behind ``[DONE]`` do not count.

    Deltas are joined in two levels, so a long answer is pre-joined before its parts meet.
    """
    ends = lines.filter(F.rtrim("line") == PREFIX + DONE).groupBy("msg_id").agg(F.min("seq").alias("_end"))
    live = lookup_join(lines, ends, ["msg_id"], "left").filter(F.col("_end").isNull() | (F.col("seq") < F.col("_end")))
    deltas = live.select("msg_id", "seq", delta_text(F.rtrim("line")).alias("text")).filter("text IS NOT NULL")

    def joined(order: str) -> Column:
        parts = F.sort_array(F.collect_list(F.struct(order, "text")))
        return F.array_join(F.transform(parts, lambda p: p["text"]), "")

    blocks = deltas.groupBy("msg_id", F.expr(f"seq div {BLOCK}").alias("block")).agg(joined("seq").alias("text"))
    whole = blocks.groupBy("msg_id").agg(joined("block").alias("raw"))
    return whole.select("msg_id", shape_message(F.col("raw")).alias("m")).select("msg_id", "m.*")


class AnswerProcessor(StatefulProcessor):
    """Lines of one answer until it is whole.

    Lines are appended to a list state, which is never read or written again before the answer ends, so a batch
    writes its own lines however long the answer is.  ``[DONE]`` may come early: the answer goes out when every
    number below its own has come, or at the timer.  A timer of ``timeout_ms`` starts anew with each batch of lines; when it
    rings, an open answer goes out as far as it came, and an answer that went out is forgotten.  Until then late
    lines of an answer that went out are dropped.
    """

    def __init__(self, timeout_ms: int):
        self.timeout_ms = timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.lines = handle.getListState("lines", "seq bigint, text string")
        # end: number of [DONE] (-1: not seen); missing: numbers below it that have not come; closed: went out; timer: set for then
        self.mark = handle.getValueState("mark", "end bigint, missing bigint, closed boolean, timer bigint")

    def _answer(self, key: tuple, end: int) -> pd.DataFrame:
        # a number that comes twice counts once
        kept = {seq: text for seq, text in self.lines.get() if end < 0 or seq < end}
        self.lines.clear()
        return pd.DataFrame({"msg_id": [key[0]], "raw": ["".join(kept[s] for s in sorted(kept))]})

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        end, missing, closed, timer = self.mark.get() if self.mark.exists() else (-1, 0, False, 0)
        come = []
        for pdf in rows:
            if closed:
                continue
            for seq, text, done in zip(pdf["seq"], pdf["text"], pdf["done"]):
                if done:
                    end = int(seq) if end < 0 else min(end, int(seq))
                    missing = -1  # counted anew below
                else:
                    come.append((int(seq), text if isinstance(text, str) else ""))
        if come:
            self.lines.appendList(come)
        if not closed and end >= 0:
            if missing > len(come):
                missing -= sum(s < end for s, _ in come)
            else:
                missing = end - len({s for s, _ in self.lines.get() if s < end})
            if missing <= 0:
                yield self._answer(key, end)
                closed = True
        if timer:
            self.handle.deleteTimer(timer)
        timer = timerValues.getCurrentProcessingTimeInMs() + self.timeout_ms
        self.handle.registerTimer(timer)
        self.mark.update((end, missing, closed, timer))

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        end, _, closed, _ = self.mark.get()
        if not closed:
            yield self._answer(key, end)
        self.mark.clear()

    def close(self) -> None:
        pass


def reassemble_stream(lines: DataFrame, timeout_ms: int = 60_000) -> DataFrame:
    """Streaming form: one row per answer when it is whole, or after a silent timeout (see :class:`AnswerProcessor`).

    ``seq`` counts the lines of an answer from 0, comments and broken lines included.  The query needs the RocksDB state
    store; a session of :func:`weftline.session.build_session` has it.  Timers run by the clock, so the query wants a
    trigger by time; with ``availableNow`` it would wait for timers without end.
    """
    ship_package(lines.sparkSession)
    cleaned = lines.select("msg_id", "seq", delta_text(F.rtrim("line")).alias("text"), (F.rtrim("line") == PREFIX + DONE).alias("done"))
    whole = cleaned.groupBy("msg_id").transformWithStateInPandas(
        AnswerProcessor(timeout_ms), "msg_id string, raw string", "append", "processingTime")
    return whole.select("msg_id", shape_message(F.col("raw")).alias("m")).select("msg_id", "m.*")
