"""The registered queries without SQL against brute force on the smallest tables."""

from __future__ import annotations

import hashlib
import zlib

import pytest

from weftline.llm import main_text, pii, unigram
from weftline.llm.queries import QUERIES, SQL

from .test_corpus_operators import brute_spans

DATA = "/root/testdata/sf0.001"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def documents(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}


def test_one_query_per_operator():
    assert [q.split("_")[0] for q in QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert set(SQL) < set(QUERIES)


def test_personal_data_digests(spark):
    texts = documents(spark)
    got = QUERIES["op8_personal_data"](spark, DATA).collect()
    assert {g["doc_id"] for g in got} == set(texts)
    for g in got:
        joined = ",".join(f"{k}:{s}:{e}" for s, k, e in brute_spans(texts[g["doc_id"]]))
        assert g["base_sha256"] == sha(joined)
        assert g["spans"] == ",".join(f"{k}:{s}:{e}" for s, k, e, _ in pii.find_spans(texts[g["doc_id"]]))


def test_piece_digests(spark):
    texts, m = documents(spark), unigram.UnigramModel.from_file(unigram.default_model_path())
    for g in QUERIES["op7_sentencepiece"](spark, DATA).collect():
        ids = m.encode(texts[g["doc_id"]])
        assert (g["n_tokens"], g["ids_sha256"]) == (len(ids), sha(",".join(map(str, ids))))
        assert g["round_trip"] and g["decoded_sha256"] == sha(texts[g["doc_id"]])


def test_main_text_columns(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    model = main_text.trained_model()
    got = QUERIES["op9_main_text"](spark, DATA).collect()
    assert len(got) == len(pages)
    for g in got:
        page = pages[g["page_id"]]
        assert (g["url"], g["text"], g["n_chars"]) == (page["url"], main_text.extract(page["html"], model), len(g["text"]))


@pytest.mark.parametrize("name", ["op3_toxicity", "op10_quality"])
def test_scores(spark, name):
    got = QUERIES[name](spark, DATA).collect()
    assert {g["doc_id"] for g in got} == set(documents(spark))
    cut = 0.7 if name == "op3_toxicity" else 0.5
    for g in got:
        assert g["held_out"] == (zlib.crc32(str(g["doc_id"]).encode()) % 3 == 1)
        assert 0 <= g["score"] <= 1 and g["predicted"] == int(g["score"] >= cut)
