"""The pipeline's stages against plain code, stage by stage, each on its own input."""

from __future__ import annotations

import re

import corpus_pipeline
from loomcart.llm import langid
from loomcart.session import materialise
from tests.llm.test_minhash import brute as components
from tests.llm.test_packing import check
from tests.llm.test_repeats import brute as repeats

FOLDER = "/root/testdata/sf0.001"


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def contaminated(text, windows):
    own = words(text)
    return any(tuple(own[i : i + n]) in windows for n in {len(w) for w in windows} for i in range(len(own) - n + 1))


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names = docs.columns
    given = [tuple(r) for r in docs.collect()]
    bench = [words(r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    windows = {tuple(w[i : i + 10]) for w in bench for i in range(max(len(w) - 9, 1)) if w}
    assert len(corpus_pipeline.STAGES) == 5
    for name, stage in corpus_pipeline.STAGES:
        out = materialise(stage(spark, docs, FOLDER), name)
        got = [tuple(r) for r in out.collect()]
        if name == "language_id":
            model = langid.learn(docs.where(~langid.held_out("doc_id")))
            rejected = {r["doc_id"] for r in langid.identify(docs, model).where("rejected").collect()}
            want = [r for r in given if r[0] not in rejected]
            assert len(want) > 0.97 * len(given)
        elif name == "near_duplicates":
            alone = {d for d, _, _, kept in components([(r[0], r[1]) for r in given], 80) if kept}
            want = [r for r in given if r[0] in alone]
            assert len(want) < len(given)
        elif name == "suffix_array":
            kept = {i: bytes(k).decode("utf-8", "ignore") for i, _, _, _, k in repeats([(r[0], r[1]) for r in given], 50, lambda t: list(t.encode()))}
            want = [(r[0], kept[str(r[0])], r[2], r[3], len(kept[str(r[0])])) for r in given]
        elif name == "decontaminate":
            want = [r for r in given if not contaminated(r[1], windows)]
            assert len(want) < len(given)
        else:
            assert check(out.collect(), [(r[0], r[1]) for r in given]) < 0.05
            break
        assert out.columns == names
        assert sorted(got) == sorted(want)
        docs, given = out, got


def test_hard_rows(spark, tmp_path):
    schema = spark.read.parquet(f"{FOLDER}/documents.parquet").schema
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "the same words of a text again", "en", None, 3), (3, "the same words of a text again", "en", "s", 30), (3, "the same words of a text again", "en", "s", 30), (4, "x" * 200_000, "en", "s", 1)]
    rows += [(i, f"filler {i * i} sentence {i} about {i * 7} nothing {i * 3} much", "en", "s", 1) for i in range(10, 20)]
    spark.read.parquet(f"{FOLDER}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, data in (("rows", rows), ("none", [])):
        docs = spark.createDataFrame(data, schema)
        for stage, (_, function) in enumerate(corpus_pipeline.STAGES):
            docs = materialise(function(spark, docs, str(tmp_path)), f"{name}-{stage}")
        assert set(docs.select("doc_id").distinct().toPandas()["doc_id"]) == ({3, 4, *range(10, 20)} if data else set())


def test_rows_with_one_id_or_none_are_documents_of_their_own(spark):
    schema = spark.read.parquet(f"{FOLDER}/documents.parquet").schema
    first, second = (" ".join(f"{w}{i * i}" for i in range(n)) for w, n in (("a", 40), ("b", 60)))
    rows = [(7, first), (9, second), (None, first), (None, second), (None, "clean words without a copy"), (None, None), (None, None)]
    rows += [(11, "one text under one id"), (11, "one text under one id"), (11, "another text under that id"), (12, "another text under that id")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], schema)
    got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicates(spark, docs, FOLDER).collect()]
    want = [(7, first), (9, second), (None, "clean words without a copy"), (None, None), (None, None)]
    want += [(11, "one text under one id"), (11, "another text under that id")]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_bytes_of_two_broken_characters_do_not_join(spark):
    schema = spark.read.parquet(f"{FOLDER}/documents.parquet").schema
    middle = "".join(f" word{i}" for i in range(20))
    texts = {1: f"one \u00a9{middle}\u00c3 end", 2: f"before \u0129{middle}\u00e4 after"}  # C2 A9 .. C3 83, C4 A9 .. C3 A4
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts.items()], schema)
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in corpus_pipeline.repeated_passages(spark, docs, FOLDER).collect()}
    assert got == {1: (texts[1], len(texts[1])), 2: ("before  after", 13)}
