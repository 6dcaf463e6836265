"""Streaming jobs: replay gives the same stores, deltas give the same answers as a batch."""

from __future__ import annotations

import json

from weftline.streaming import deltas, ingest

FINAL = "<|channel|>final<|message|>"


def test_ingest_twice(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()

    def put(name, docs):
        (source / name).write_text("\n".join(map(json.dumps, docs)))

    def run():
        q = ingest.ingest_stream(spark, str(source), str(tmp_path / "app"), str(tmp_path / "key"), str(tmp_path / "ck"))
        q.awaitTermination(120)
        assert q.exception() is None

    put("1.json", [{"user_id": "u", "document_id": "d", "text": "a" * 300}, {"document_id": "e", "text": "short"},
                   {"document_id": "", "text": "no id"}, {"document_id": "x", "text": ""}])
    run()
    put("2.json", [{"user_id": "u", "document_id": "d", "text": "b" * 10}])
    run()
    run()  # nothing new
    keyed = {(r["user_id"], r["document_chunk"]): r["chunk_text"] for r in spark.read.parquet(str(tmp_path / "key")).collect()}
    assert keyed == {("u", "d#0"): "b" * 10, ("u", "d#1"): "a" * 76, ("default", "e#0"): "short"}
    assert spark.read.parquet(str(tmp_path / "app")).count() == 4
    again = spark.createDataFrame([("u", "d", "b" * 10)], ingest.DOCUMENT_SCHEMA)
    ingest.write_batch(again, 1, str(tmp_path / "app"), str(tmp_path / "key"))  # replay of batch 1
    assert spark.read.parquet(str(tmp_path / "app")).count() == 4


def data_line(text):
    return "data: " + json.dumps({"choices": [{"delta": {"content": text}}]})


MESSAGES = {
    "plain": [data_line("<|channel|>analysis<|message|>hm<|end|><|start|>assistant<|channel|>fi"), ": comment",
              data_line("nal<|message|>Hello"), "data: {bad", data_line(" world<|return|>junk"), "data: [DONE]", data_line("late")],
    "tool": [data_line(FINAL + ' [{"type": "tool_use", '), data_line('"name": "Read", "input": {}}]<|end|>'), "data: [DONE]"],
    "broken tool": [data_line(FINAL + "[not json"), "data: [DONE]"],
    "no final": [data_line("<|channel|>analysis<|message|>thinking only"), data_line(""), "data: [DONE]"],
}
EXPECTED = {
    "plain": ("text", "Hello world", "end_turn"),
    "tool": ("tool", '[{"type": "tool_use", "name": "Read", "input": {}}]', "tool_use"),
    "broken tool": ("text", "[not json", "end_turn"),
    "no final": ("text", "thinking only", "end_turn"),
}
SCHEMA = "msg_id string, seq bigint, line string"


def test_batch_reassembly(spark, monkeypatch):
    monkeypatch.setattr(deltas, "BLOCK", 2)
    rows = [(m, i, line) for m, lines in MESSAGES.items() for i, line in enumerate(lines)]
    got = deltas.reassemble(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert {r["msg_id"]: (r["kind"], r["text"], r["stop_reason"]) for r in got} == EXPECTED


def run_batches(spark, folder, batches, timeout_ms=60_000):
    """Each list of (msg_id, seq, line) rows is a file that one start of the query reads; rows out so far."""
    source = folder / "in"
    source.mkdir(exist_ok=True)
    for rows in batches:
        n = len(list(source.iterdir()))
        (source / f"{n}.json").write_text("\n".join(json.dumps({"msg_id": m, "seq": i, "line": x}) for m, i, x in rows))
        stream = spark.readStream.schema(SCHEMA).json(str(source))
        q = (deltas.reassemble_stream(stream, timeout_ms).writeStream.format("parquet").option("path", str(folder / "out")).outputMode("append")
             .option("checkpointLocation", str(folder / "ck")).trigger(once=True).start())  # timers keep other triggers busy without end
        assert q.awaitTermination(60)
        assert q.exception() is None
    return {r["msg_id"]: (r["kind"], r["text"], r["stop_reason"]) for r in spark.read.parquet(str(folder / "out")).collect()}


def test_stream_reassembly_over_batches(spark, tmp_path):
    rows = [(m, i, line) for m, lines in MESSAGES.items() for i, line in enumerate(lines) if line != data_line("late")]
    assert run_batches(spark, tmp_path, [[r for r in rows if keep(r[1])] for keep in (lambda i: i < 2, lambda i: i >= 2)]) == EXPECTED


def test_stream_survives_restarts_and_disorder(spark, tmp_path):
    """The query starts anew in mid-answer; [DONE] comes before lines that precede it; late and repeated lines change nothing."""
    rows = {m: [(m, i, x) for i, x in enumerate(lines)] for m, lines in MESSAGES.items()}
    batches = [[r[-1] if r[-1][2] == "data: [DONE]" else r[-2] for r in rows.values()],  # every [DONE] first
               [x for r in rows.values() for x in r[1:2]],
               [x for r in rows.values() for x in reversed(r[1:])],  # again, and the rest but the first lines
               [x for r in rows.values() for x in r[:1]]]
    partial = run_batches(spark, tmp_path, batches[:3])
    assert partial == {}
    assert run_batches(spark, tmp_path, batches[3:]) == EXPECTED
    assert run_batches(spark, tmp_path, [[("plain", 9, data_line("later still")), ("plain", 10, "data: [DONE]")]]) == EXPECTED


def test_silent_answers_go_out_at_the_timer(spark, tmp_path):
    open_rows = [("x", i, data_line(t)) for i, t in enumerate(["Hel", "lo"])]
    got = run_batches(spark, tmp_path, [open_rows, [("y", 0, data_line("tick"))], [("y", 1, "data: [DONE]")]], timeout_ms=1)
    assert got["x"] == ("text", "Hello", "end_turn")


def test_state_written_per_batch_does_not_grow_with_the_answer(spark, tmp_path):
    """Bytes of the change log of each batch, for batches of one size of an answer that gets longer and longer."""
    per, n = 200, 8
    batches = [[("long", b * per + k, data_line(f"w{b * per + k:06d} ")) for k in range(per)] for b in range(n)]
    run_batches(spark, tmp_path, batches)
    logs = {}
    for f in (tmp_path / "ck" / "state").rglob("*.changelog"):
        version = int(f.name.split(".")[0].split("_")[0])
        logs[version] = logs.get(version, 0) + f.stat().st_size
    sizes = [logs[v] for v in sorted(logs)]
    assert len(sizes) >= n
    assert max(sizes[1:n]) < 1.5 * min(sizes[1:n])
    done = run_batches(spark, tmp_path, [[("long", per * n, "data: [DONE]")]])
    assert done["long"][1].split() == [f"w{k:06d}" for k in range(per * n)]
