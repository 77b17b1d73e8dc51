from __future__ import annotations

import sentencepiece

from loomcart.llm import tokencount
from loomcart.llm.registry import queries, tokenizer_file

MODEL = tokenizer_file("piece_bpe_32k.model")


def test_query_equals_library(spark):
    folder = "/root/testdata/sf0.001"
    processor = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = {r["doc_id"]: r for r in queries()["op8_token_counts"](spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        n = len(processor.encode(d["text"] or ""))
        got = rows[d["doc_id"]]
        assert (got["n_tokens"], got["n_bytes"], got["over_limit"]) == (n, len((d["text"] or "").encode()), n > 4096)


def test_only_misses_are_encoded(spark, tmp_path):
    cache = str(tmp_path / "cache")
    schema = "doc_id long, text string, digest string"
    first = spark.createDataFrame([(1, "a b", "x"), (1, "a b", "x"), (2, None, "x"), (None, "", None), (3, "</s> long " * 9000, "")], schema)
    got = sorted((str(r["doc_id"]), r["n_tokens"]) for r in tokencount.count_tokens(first, cache, MODEL).collect())
    assert [g[0] for g in got] == ["1", "1", "2", "3", "None"]
    assert got[2][1] == got[4][1] == 0
    version = tokencount.tokenizer_version(MODEL)
    before = spark.read.parquet(f"{cache}/version={version}").select("digest").distinct().count()
    assert before == 3
    second = spark.createDataFrame([(7, "a b", "x"), (8, "new", "x")], schema)
    tokencount.count_tokens(second, cache, MODEL).collect()
    assert spark.read.parquet(f"{cache}/version={version}").select("digest").distinct().count() == 4
    assert tokencount.count_tokens(first.limit(0), cache, MODEL).collect() == []


def test_repeated_rows_are_encoded_once(spark, tmp_path):
    cache = str(tmp_path / "cache")
    rows = [(7, "one text under one id")] * 2000 + [(None, "")] * 500 + [(i, "text of many") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert tokencount.count_tokens(docs, cache, MODEL).count() == 2800
    stored = spark.read.parquet(f"{cache}/version={tokencount.tokenizer_version(MODEL)}")
    assert stored.count() == stored.select("digest").distinct().count() == 3
    assert tokencount.count_tokens(docs, cache, MODEL).count() == 2800
    assert spark.read.parquet(f"{cache}/version={tokencount.tokenizer_version(MODEL)}").count() == 3
