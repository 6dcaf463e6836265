"""Chunks, tokens, summaries, brands, model outputs, plugs: edge rows."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from weftline.functions import plugs
from weftline.functions import text as X
from weftline.functions import vectors as V
from weftline.operators import answers, brands, chunking, corpus_search, images, metrics, model_outputs, summaries, tabular, tokens


def one(spark, value, make):
    return spark.createDataFrame([(value,)], "x string").select(make(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("n", [0, 1, 31, 224, 225, 256, 257, 1000])
def test_chunks_rebuild_the_text(spark, n):
    text = "".join(chr(97 + i % 26) if i % 50 else "😀" for i in range(n))
    got = one(spark, text, chunking.fixed_chunks)
    assert got == [text[s:s + 256] for s in range(0, n, 224)]
    assert "".join(c[:224] for c in got[:-1]) + (got[-1] if got else "") == text


def test_chunk_overlap_must_be_smaller():
    with pytest.raises(ValueError):
        chunking.fixed_chunks("x", 10, 10)


def test_separator_chunks(spark):
    text = "a" * 600 + "\n\n" + "b" * 398 + "\n\n" + "c" * 1500 + "\n\n\n\n d "
    assert one(spark, text, chunking.separator_chunks) == ["a" * 600 + "\n\n" + "b" * 398, "c" * 1500, "d"]
    assert one(spark, "", chunking.separator_chunks) == []


def test_line_check(spark):
    docs = spark.createDataFrame([(1, "two words\n\none\n  padded line  \n")], "d int, text string")
    got = chunking.check_lines(chunking.lines(docs, ["d"]), ["d", "line_no"]).orderBy("line_no").collect()
    assert [(r["text"], r["line_id"]) for r in got] == [("two words", 0), ("", None), ("one", None), ("padded line", 1)]


@pytest.mark.parametrize("text", ["don't stop", "3com router's", "LEGO city", "o'neill x-ray"])
def test_title_case_is_pythons(spark, text):
    assert one(spark, text, X.title_case) == text.title()


def test_capitalize(spark):
    assert one(spark, "hELLO wORLD", X.capitalize) == "Hello world"


def test_cosine_edges(spark):
    df = spark.createDataFrame([([0.0, 0.0], [1.0, 2.0]), ([1.0, 1.0, 5.0], [1.0, 1.0])], "a array<double>, b array<double>")
    got = [r["c"] for r in df.select(V.cosine("a", "b").alias("c")).collect()]
    assert got[0] == 0.0 and abs(got[1] - 2 / (27 ** 0.5 * 2 ** 0.5)) < 1e-12


def test_encode_decode(spark):
    docs = spark.createDataFrame([(1, "Hello, world -- it's (fine)!"), (2, "")], "d int, text string")
    rows = tokens.token_rows(docs, ["d"])
    vocab = tokens.vocabulary(rows, (tokens.END_OF_TEXT, tokens.UNKNOWN))
    back = tokens.decode(tokens.require_known(tokens.encode(rows, vocab, None)), vocab, ["d"]).collect()
    assert [r["text"] for r in back] == ["Hello, world -- it' s( fine)!"]
    other = tokens.token_rows(spark.createDataFrame([(1, "Hello moon")], "d int, text string"), ["d"])
    with pytest.raises(KeyError):
        tokens.require_known(tokens.encode(other, vocab, None))
    assert tokens.decode(tokens.encode(other, vocab), vocab, ["d"]).first()["text"] == "Hello <|unk|>"


@pytest.mark.parametrize("n", [0, 3, 4, 5, 11])
def test_token_windows(spark, n):
    df = spark.createDataFrame([(list(range(n)),)], "ids array<int>")
    got = df.select(tokens.token_windows(F.col("ids"), 4, 2).alias("w")).first()["w"] or []
    want = [(i, list(range(i, i + 4)), list(range(i + 1, i + 5))) for i in range(0, n - 4, 2)]
    assert [(w["start"], w["input"], w["target"]) for w in got] == want


def test_summary_edges(spark):
    docs = spark.createDataFrame(
        [(1, ""), (2, None), (3, "The of. And it!"), (4, 'Cats chase mice. Dogs sleep. Cats eat mice and cats play. "Birds fly."')],
        "d int, text string")
    got = {r["d"]: r for r in summaries.summarize(docs, "d", n_sentences=2).collect()}
    assert got[1]["summary"] == "" and got[1]["error"] == summaries.EMPTY_TEXT and got[2]["error"] == summaries.EMPTY_TEXT
    assert got[3]["num_sentences"] == 2 and got[3]["summary"] == "The of. And it!" or got[3]["top_keywords"]
    assert got[4]["summary"].startswith("Cats") and got[4]["num_sentences"] == 4 and got[4]["error"] is None


@pytest.mark.parametrize("title, brand", [
    (None, ""), ("", ""), ("12345", ""), ("Widget by Acme", "Widget"), ("acme widget® deluxe", "acme widget"),
    ("LEGO Minecraft The Fortress", "LEGO Minecraft"),
])
def test_pattern_brand_edges(spark, title, brand):
    got = spark.createDataFrame([(title,)], "x string").select(
        brands.model_or_pattern(F.lit(""), F.col("x")).alias("y")).first()["y"]
    assert got == brand or (title or "").startswith(got)


def test_hybrid_brand_order(spark):
    df = spark.createDataFrame([("LEGO levi's set", ["Levi Co"]), ("Fisher-Price Laugh Toy", ["Toy 1", "Mattel"]),
                                ("Disney Princess Doll", []), ("", [])], "t string, c array<string>")
    got = [r["b"] for r in df.select(brands.hybrid_brand(F.col("t"), ["lego", "levi's"], F.col("c")).alias("b")).collect()]
    assert got == ["Levi'S", "Mattel", "Disney Princess", None]


FINAL, ANALYSIS = "<|channel|>final<|message|>", "<|channel|>analysis<|message|>"


@pytest.mark.parametrize("raw, final", [
    ("plain", "plain"), (f"x{FINAL}one<|end|>{FINAL} two <|return|>tail", "two"), (f"{FINAL}a<|start|>b", "a"), ("a<|end|>b", "a")])
def test_final_text(spark, raw, final):
    assert one(spark, raw, model_outputs.final_text) == final


def test_tool_calls_edges(spark):
    def calls(raw):
        return [(c["name"], json.loads(c["args"])) for c in one(spark, raw, model_outputs.tool_calls)]

    assert calls('<read>{"path": "a"}</read> <tool_call>{"tool": "glob", "args": {"pat": "*"}}</tool_call>') == [
        ("read", {"path": "a"}), ("glob", {"pat": "*"})]
    assert calls('<tool_call>{"tool": "grep", "args": {"pat": "{x}"}} trailing') == [("grep", {"pat": "{x}"})]
    assert calls('<tool_call>{"tool": "bash", "args": {}}</tool_call>') == []
    assert calls("<read>not json</read>") == []
    assert calls('<tool_call>{"tool": "read"}</tool_call>') == [("read", {})]


def test_request_conversion(spark):
    body = {"system": [{"type": "text", "text": "Be"}, {"type": "image"}, {"type": "text", "text": "kind"}],
            "messages": [{"role": "user", "content": str(i)} for i in range(3)] + [
                {"role": "assistant", "content": [{"type": "tool_use", "name": "Read", "input": {}}]},
                {"role": "user", "content": [{"type": "text", "text": "a"}, {"type": "text", "text": "b"}]},
                {"role": "assistant", "content": f"hidden{FINAL}shown<|end|>"}],
            "max_tokens": 5, "stop": ["x"]}
    got = one(spark, json.dumps(body), lambda c: model_outputs.convert_request(c, "SUFFIX"))
    assert [m["role"] for m in got["messages"]] == ["system", "user", "assistant", "user", "assistant"]
    assert got["messages"][0]["content"] == "Be kind\n\nSUFFIX"
    assert json.loads(got["messages"][2]["content"]) == [{"type": "tool_use", "name": "Read", "input": {}}]
    assert [got["messages"][i]["content"] for i in (1, 3, 4)] == ["2", "ab", "shown"]
    assert (got["stream"], got["max_tokens"], got["temperature"], got["stop"]) == (False, 5, 1.0, ["x"])
    empty = one(spark, "{}", lambda c: model_outputs.convert_request(c, "S"))
    assert empty["messages"][0]["content"] == model_outputs.FALLBACK_SYSTEM + "\n\nS" and len(empty["messages"]) == 1


def test_response_conversion(spark):
    def convert(message, **more):
        return one(spark, json.dumps({"choices": [{"message": message}], **more}), model_outputs.convert_response)

    calls = [{"function": {"name": "Read", "arguments": '{"p": 1}'}}, {"function": {"name": "Bash", "arguments": "oops"}}]
    got = convert({"content": None, "tool_calls": calls}, usage={"prompt_tokens": 3, "completion_tokens": 4})
    assert got["stop_reason"] == "tool_use" and (got["input_tokens"], got["output_tokens"]) == (3, 4)
    assert [b["input"] for b in json.loads(got["tools"])] == [{"p": 1}, {}]
    assert convert({"content": f"{ANALYSIS}think<|end|>{FINAL}answer<|return|>"})["text"] == "answer"
    assert convert({"content": "<|start|>assistant<|channel|>analysis<|message|>only thoughts<|end|>"})["text"] == "only thoughts"


def test_reading_and_editing(spark):
    body = "".join(f"l{i}\n" for i in range(1000))
    shown = one(spark, body, lambda c: corpus_search.read_slice(c))
    assert shown.startswith("   1| l0\n") and shown.endswith(" 800| l799\n... (200 more lines)")
    assert one(spark, "a\nb", lambda c: corpus_search.read_slice(c, 5)).startswith("error: offset 5 out of range")
    text, status = corpus_search.replace_exact(F.col("x"), F.lit("a.b"), F.lit("$1"))
    got = spark.createDataFrame([("xa.by",), ("aXb",), ("a.ba.b",)], "x string").select(text.alias("t"), status.alias("s")).collect()
    assert [tuple(r) for r in got] == [("x$1y", "ok"), ("aXb", "error: old_string not found"),
                                       ("a.ba.b", "error: old_string appears 2 times (use all=true)")]


def test_unknown_tool_and_glob(spark):
    corpus = spark.createDataFrame([("a/x.py", "one\ntwo"), ("a/b/y.py", "three"), ("node_modules/z.py", "")], "path string, text string")
    calls = spark.createDataFrame([(1, "read", '{"path": "a/x.py", "offset": 1}'), (2, "glob", '{"pat": "a/**/*.py"}'),
                                   (3, "grep", '{"pat": "t[wh]"}'), (4, "fly", "{}"), (5, "read", '{"path": "no"}')],
                                  "call_id int, name string, args string")
    got = sorted((r["call_id"], r["output"]) for r in corpus_search.run_calls(calls, corpus, pattern_block=1).collect())
    assert got == [(1, "   2| two"), (2, "a/b/y.py"), (2, "a/x.py"), (3, "a/b/y.py:1:three"), (3, "a/x.py:2:two"),
                   (4, "error: unknown tool 'fly'"), (5, "error: not a file: no")]
    assert [r["path"] for r in corpus_search.list_paths(corpus, "**/*.py").collect()] == ["a/b/y.py", "a/x.py"]


def test_plugs(spark):
    df = spark.createDataFrame([("ab",), ("fail",)], "prompt string")

    def factory():
        def answer(prompts):
            if "fail" in prompts:
                raise RuntimeError("no")
            return [p.upper() for p in prompts]
        return answer

    got = {r["prompt"]: (r["answer"], r["answer_error"]) for r in plugs.generate(df, "prompt", factory).collect()}
    assert got == {"ab": ("AB", None), "fail": (None, "Error: no")}
    assert df.select(plugs.score("prompt", lambda: lambda ts: [float(len(x)) for x in ts]).alias("s")).first()["s"] == 2.0
    assert df.select(plugs.token_count("prompt", lambda: lambda ts: [len(x) for x in ts]).alias("s")).first()["s"] == 2
    assert df.select(plugs.embed("prompt", lambda: lambda ts: [[1.0]] * len(ts)).alias("s")).first()["s"] == [1.0]


def test_steps_compose(spark):
    """Retrieve, format, generate and shape as a chain of transforms."""
    hits = spark.createDataFrame([("q", 1, "d", 0, "best"), ("q", 2, "d", 3, "next")],
                                 "question string, rank int, document_id string, chunk_index int, chunk_text string")
    block = answers.context_block(F.col("document_id"), F.col("chunk_index"), F.col("chunk_text"))
    chained = (
        hits.transform(lambda d: answers.assemble_context(d, block))
        .withColumn("prompt", answers.fill_prompt(answers.USER_PROMPT, F.col("context"), F.col("question")))
        .withColumn("top_text", F.lit("best"))
        .transform(lambda d: answers.answer_records(d, lambda: lambda ps: [p[:7] for p in ps]))
    )
    row = chained.first()
    assert row["answer"] == "Context" and row["chunks_used"] == 2
    assert row["context_used"] == "[d, chunk 0]\nbest\n\n[d, chunk 3]\nnext"


def test_zero_ranges_and_empty_tables(spark):
    same = spark.createDataFrame([(5.0,), (5.0,)], "p double")
    s = tabular.fit_scaling(same, "p")
    assert (s.iqr, s.span) == (1.0, 1.0)
    assert same.select(s.invert(s.apply(F.col("p"))).alias("x")).first()["x"] == 5.0
    none = spark.createDataFrame([], "label int, pred int")
    m = metrics.binary_metrics(none, "label", "pred").first()
    assert (m["precision"], m["recall"]) == (1.0, 1.0)
    assert brands.extraction_stats(spark.createDataFrame([], "brand string")).first()["success_rate"] is None
    with pytest.raises(ValueError):
        tabular.exact_sample(same, ["p"], 3)


def test_patches_are_undone(spark):
    pixels = spark.range(2 * 3 * 36).select(
        F.expr("id div 108").alias("img"), F.expr("id div 36 % 3").alias("c"), F.expr("id % 36 div 6").alias("y"),
        F.expr("id % 6").alias("x"), F.col("id").cast("double").alias("value"))
    patches = images.patchify(pixels, 3, 6)
    first = patches.filter("img = 0 and patch = 1").first()["values"]
    assert first[:4] == [3.0, 4.0, 5.0, 9.0] and len(first) == 27
    back = images.unpatchify(patches, 3, 6)
    assert back.exceptAll(pixels.select(back.columns)).count() == 0 and back.count() == 216
    with pytest.raises(ValueError):
        images.patchify(pixels, 4, 6)


def test_moving_average_keeps_short_groups(spark):
    df = spark.createDataFrame([("a", i, float(i)) for i in range(5)] + [("b", 0, 7.0), ("b", 1, 9.0)], "g string, t int, v double")
    got = sorted((r["g"], r["t"], r["smooth"]) for r in tabular.moving_average(df, "g", ["t"], "v").collect())
    assert got == [("a", 2, 1.0), ("a", 3, 2.0), ("a", 4, 3.0), ("b", 0, 7.0), ("b", 1, 9.0)]


def test_registered_function_types(spark):
    from weftline.functions.registry import register

    register(spark)
    got = spark.sql("SELECT * FROM weft_chunks(repeat('x', 300))").collect()
    assert [(r["chunk_index"], len(r["chunk_text"])) for r in got] == [(0, 256), (1, 76)]
    assert isinstance(spark.sql("SELECT chunk_text FROM weft_chunks('')").schema[0].dataType, StringType)


def test_numbers_of_repeated_and_null_keys(spark):
    text = "ab " * 200
    rows = [(1, text), (1, text), (1, "one two"), (None, "x y z"), (None, "x y z"), (2, ""), (3, None), (2, "a b\n\n c \nd e\n")]
    docs = spark.createDataFrame(rows, "k bigint, text string").repartition(4)
    got = chunking.indexed_chunks(docs, "k").collect()
    assert sorted(int(r["id"][4:]) for r in got) == list(range(10))
    assert [(r["metadata"]["file_path"], r["document"]) for r in sorted(got, key=lambda r: int(r["id"][4:]))][:2] == [(None, "x y z")] * 2
    per_row = {r["id"]: r["document"] for r in got}
    long = sorted(int(i[4:]) for i, d in per_row.items() if d.startswith("ab ") or d.startswith("b "))
    assert len([r for r in got if r["metadata"]["chunk"] == 2]) == 2 and long
    lines = chunking.checked_lines(docs, ["k"]).collect()
    assert sorted(r["line_id"] for r in lines if r["reason"] is None) == list(range(7))
    assert sorted((r["line_no"], r["text"], r["reason"] is None) for r in lines if r["k"] == 2) == [
        (0, "a b", True), (1, "", False), (2, "c", False), (3, "d e", True)]
    unique = docs.filter("k = 2")
    old = chunking.check_lines(chunking.lines(unique, ["k"]), ["k", "line_no"])
    columns = ["k", "line_no", "text", "reason", "line_id"]
    assert sorted(map(str, old.select(*columns).collect())) == sorted(map(str, chunking.checked_lines(unique, ["k"]).select(*columns).collect()))


def test_plugs_see_bounded_parts_of_a_batch(spark):
    """One Arrow batch of many long texts becomes Python objects slice by slice, nulls and order kept."""
    def sizes():
        return lambda texts: [sum(len(t or "") for t in texts)] * len(texts)

    df = spark.range(400, numPartitions=1).select("id", F.when(F.col("id") % 9 > 0, F.repeat(F.lit("ab 1 "), 4_000)).alias("t")).cache()
    together = df.select("id", plugs.score("t", sizes).alias("s")).collect()
    assert max(r["s"] for r in together) <= 1 << 20 and [r["id"] for r in together] == list(range(400))
    spans = plugs.annotate(df, "t", lambda: lambda ts: [[(str(sum(map(len, ts))), "N")] for _ in ts]).collect()
    assert max(int(r["entities"][0]["text"]) for r in spans) <= 1 << 20 and [r["id"] for r in spans] == list(range(400))
    few = df.select("id", plugs.lexicon_score("t", {"ab": 2.0, "1": 4.0}).alias("s"), plugs.embed(F.substring("t", 1, 100)).alias("e"),
                    chunking.separator_chunks("t", " ", 5).alias("c")).collect()
    assert all((r["s"], r["e"] is None, r["c"] is None) == ((None, True, True) if r["id"] % 9 == 0 else (3.0, False, False)) for r in few)
    assert few[1]["c"][:2] == ["ab 1", "ab 1"] and len(few[1]["c"]) == 4_000
