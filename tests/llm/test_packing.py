from __future__ import annotations

import random
import zlib

import numpy as np
from tokenizers import Tokenizer

from loomcart.llm import packing
from loomcart.llm.registry import queries, tokenizer_file

RANKS, MODEL = tokenizer_file("byte_bpe_50k.tiktoken"), tokenizer_file("byte_bpe_50k.json")


def check(rows, texts, window=1024):
    """Every id in one piece, sequences without gaps; returns the padded share."""
    library = Tokenizer.from_file(MODEL)
    pieces: dict = {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
    for doc, text in texts:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        at = 0
        for r in sorted(pieces.pop(doc), key=lambda r: r["start"]):
            part = ids[r["start"] : r["start"] + r["length"]]
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(part.tobytes()))
            at += r["length"]
        assert at == len(ids)
    assert not pieces
    fill: dict = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == fill.get(r["sequence_id"], 0)
        fill[r["sequence_id"]] = r["offset"] + r["length"]
    assert set(fill) == set(range(len(fill))) and max(fill.values(), default=0) <= window
    used = sum(fill.values())
    padded = sum(n if n & (n - 1) == 0 else window for n in fill.values())
    return (padded - used) / max(used, 1)


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert check(queries()["op9_packing"](spark, folder).collect(), texts) < 0.01


def test_edge_rows(spark):
    texts = [(1, None), (2, ""), (3, "a <|endoftext|> b"), (4, "\x85 é　 x  \n" * 5), (5, "word " * 30_000), (None, "null id")]
    docs = spark.createDataFrame([(*t, 1, 2) for t in texts], "doc_id long, text string, length int, rank int")
    rows = packing.pack(docs, RANKS, MODEL, keep_ids=True).collect()
    check(rows, texts)
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in rows)
    twice = spark.createDataFrame([(7, "same text")] * 3, "doc_id long, text string")
    again = packing.pack(twice, RANKS, MODEL).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in again}) == 3
    assert packing.pack(docs.limit(0), RANKS, MODEL).collect() == []


def test_ranks_in_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 7)
    texts = [(i, "w " * (i % 9)) for i in range(150)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    check(packing.pack(docs, RANKS, MODEL, window=16).collect(), texts, 16)


def test_plan_places_every_piece():
    r = random.Random(4)
    for window in (8, 64, 1024):
        for total in (0, 3, 500, 50_000):
            wanted: dict[int, int] = {}
            for _ in range(total):
                size = min(window, 1 + int(r.expovariate(3 / window)))
                wanted[size] = wanted.get(size, 0) + 1
            got: dict[int, int] = {}
            padding = 0
            for lengths, number in packing.plan(wanted, window):
                assert number > 0 and sum(lengths) <= window
                padding += number * (window - sum(lengths))
                for size in lengths:
                    got[size] = got.get(size, 0) + number
            assert got == wanted
            if total == 50_000:
                assert padding < 0.01 * sum(k * v for k, v in wanted.items())


def test_long_runs_equal_the_library(spark):
    texts = [(i, f"begin {c * 2_000_000} end {c}") for i, c in enumerate(" \n\tx7\u3000")]
    texts += [(20, " " * 9_999 + "a" + " " * 10_000 + "b"), (21, "ab " * 700_000), (22, " \n" * 500_000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    assert check(packing.pack(docs, RANKS, MODEL).collect(), texts) < 0.05


def test_equal_rows_are_spread(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 100)
    docs = spark.createDataFrame([(None, "")] * 1000, "doc_id long, text string").repartition(4)
    seen = []
    real = packing.Window.partitionBy

    def spied(*names):
        seen.append(names)
        return real(*names)

    monkeypatch.setattr(packing.Window, "partitionBy", spied)
    found = packing.pack(docs, RANKS, MODEL)
    rows = found.collect()
    assert sorted((r["sequence_id"], r["offset"]) for r in rows) == [(i // 1024, i % 1024) for i in range(1000)]
    assert ("length", "salt") in seen
    salts = spark.range(1000).select(packing.F.pmod(packing.F.xxhash64("id"), packing.F.lit(11)).alias("s")).groupBy("s").count()
    assert salts.agg({"count": "max"}).first()[0] < 200
