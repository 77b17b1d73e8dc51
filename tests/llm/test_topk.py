from __future__ import annotations

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from loomcart.llm import topk


def brute(rows, k, every):
    """The best documents of each query, by BM25 from its definition."""
    words = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for _, t in rows]
    average = sum(map(len, words)) / len(rows)
    df: dict = {}
    for w in words:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    holders: dict = {}
    for i, w in enumerate(words):
        for t in set(w):
            holders.setdefault(t, []).append((i, w.count(t)))
    out = {}
    for (q, text), w in zip(rows, words):
        if q is None or q % every or not w:
            continue
        scores: dict = {}
        for t in set(w):
            idf = math.log1p((len(rows) - df[t] + 0.5) / (df[t] + 0.5))
            for i, tf in holders[t]:
                scores[i] = scores.get(i, 0) + idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(words[i]) / average))
        best = sorted((-round(s, 6), 2**63 - 1 if rows[i][0] is None else rows[i][0]) for i, s in scores.items())[:k]
        out[q] = [(round(-s, 4)) for s, _ in best], {(d, round(-s, 4)) for s, d in sorted((-round(s, 6), rows[i][0]) for i, s in scores.items() if rows[i][0] is not None)}
    return out


def compare(got, want, k):
    found: dict = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append(r)
    assert set(found) == set(want)
    for q, rows in found.items():
        scores, known = want[q]
        assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1)) and len(rows) == len(scores) <= k
        assert [r["score"] for r in rows] == pytest.approx(scores, abs=2e-4)
        for r in rows:
            assert r["doc_id"] is None or any((r["doc_id"], round(r["score"] + e, 4)) in known for e in (0, 1e-4, -1e-4))


def test_query(spark):
    from loomcart.llm.registry import queries

    folder = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    compare(queries()["op10_topk"](spark, folder).collect(), brute(rows, 10, 50), 10)


@pytest.mark.parametrize(("seed", "limit"), [(1, 1 << 20), (2, -1)])
def test_many_shards(spark, monkeypatch, seed, limit):
    for name, value in (("SHARD_BYTES", 3000), ("CHUNK_BYTES", 1000), ("QUERY_BLOCK", 7), ("BLOCK", 4), ("DENSE", 3), ("BATCH", 5), ("GROUP", 3), ("HELD", 2)):
        monkeypatch.setattr(topk, name, value)
    r = random.Random(seed)
    rows = [(i, " ".join(r.choice(["The", "the", "a", "B", "c9", "é"] + [f"w{r.randint(0, 60)}"] * 4) for _ in range(r.randint(0, 40)))) for i in range(200)]
    rows += [(3, rows[3][1]), (500, None), (None, "the a w1"), (501, "")]
    docs = spark.createDataFrame([(*row, 1) for row in rows], "doc_id long, text string, score int").repartition(3)
    compare(topk.top_k(docs, F.col("doc_id") % 5 == 0, k=4, broadcast_bytes=limit).collect(), brute(rows, 4, 5), 4)


def test_neither_shards_nor_query_blocks_are_shuffled_for_each_other(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 5)
    docs = spark.range(100).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("w"), F.col("id") % 7).alias("text"))
    found = topk.top_k(docs, F.col("doc_id") % 2 == 0, k=3, broadcast_bytes=-1)
    search = found._jdf.queryExecution().executedPlan().toString().split("MapInArrow")[1]
    assert "CartesianProduct" in search and "Exchange" not in search
    assert found.count() == 50 * 3


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert topk.top_k(docs, F.col("doc_id") % 50 == 0).collect() == []
    alone = spark.createDataFrame([(50, None), (100, "...")], "doc_id long, text string")
    assert topk.top_k(alone, F.col("doc_id") % 50 == 0).collect() == []
