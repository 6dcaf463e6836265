"""The pipeline, stage by stage, against the operators' own brute-force rules."""

from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline
from weftline.llm import minhash, pii, unigram
from weftline.session import ship_package

from .test_corpus_operators import brute_hits, brute_near

DATA = "/root/testdata/sf0.001"


def test_stages_and_run(spark):
    ship_package(spark)
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, items = docs.columns, [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    model = unigram.UnigramModel.from_file(unigram.default_model_path())
    for name, fn in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        out = fn(spark, docs, DATA).cache()
        after = {r["doc_id"]: r for r in out.collect()}
        assert set(after) <= set(before)
        if name != "tokens":
            assert out.columns == columns
        if name == "near_duplicates":
            near = brute_near([(i, r["text"]) for i, r in before.items()], corpus_pipeline.NEAR_PERCENT)
            assert set(after) == {i for i, (_, c) in near.items() if c == i}
        if name == "decontamination":
            counts = {i: brute_hits(r["text"], items) for i, r in before.items()}
            assert set(after) == {i for i, (n, h, _) in counts.items() if not (h > 0 and 20 * h >= n)}
        if name == "personal_data":
            assert all(after[i]["text"] == pii.masked(r["text"], [(s, e, k) for s, k, e, _ in pii.find_spans(r["text"])]) for i, r in before.items())
            assert all(r["n_chars"] == len(r["text"]) for r in after.values())
        if name == "tokens":
            assert all(after[i]["ids"] == model.encode(r["text"]) and after[i]["round_trip"] for i, r in before.items())
        docs = out
    whole = corpus_pipeline.run(spark, DATA)
    assert {(r["doc_id"], tuple(r["ids"])) for r in whole.select("doc_id", "ids").collect()} == {(i, tuple(r["ids"])) for i, r in after.items()}
    assert whole.filter(F.col("round_trip")).count() == len(after)


def test_clean_documents_stay(spark):
    """No stage drops what its rule does not name."""
    ship_package(spark)
    rows = [(10**6 + i, f"plain words number {i} " + " ".join(f"u{i}v{k}" for k in range(30)), "en", "src1", 0) for i in range(20)]
    rows += [(None, "text without an id and more words here", "en", "src1", 0), (2 * 10**6, None, None, None, None), (2 * 10**6 + 1, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for _, fn in corpus_pipeline.STAGES[1:4]:
        docs = fn(spark, docs, DATA)
    assert docs.count() == len(rows)


def test_near_copies_from_80_percent_go(spark):
    """Copies with a similarity of 0.80 to 0.85 go in the stage, not in op6; below 0.80 they stay."""
    ship_package(spark)
    rows = []
    for i in range(40):
        base = [f"b{i}w{k}" for k in range(204)]
        for j, cuts in enumerate((0, 4, 5)):  # 200 shingles, 5 of them lost per changed word: 180/220 and 175/225
            copy = list(base)
            for k in range(cuts):
                copy[20 + 30 * k] = f"c{i}j{j}k{k}"
            rows.append((10 * i + j, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = {r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, DATA).collect()}
    assert kept == {i for i, (_, c) in brute_near(rows, 80).items() if c == i} == {10 * i + j for i in range(40) for j in (0, 2)}
    assert all(r["kept"] for r in minhash.near_duplicates(docs).collect())
