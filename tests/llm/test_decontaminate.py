from __future__ import annotations

import hashlib
import random
import time

import pytest
from pyspark.sql import functions as F

from loomcart.llm.decontaminate import decontaminate, without_contaminated
from tests.llm.test_pipeline import words


def brute(docs, items, window):
    cut = [(str(i) if i is not None else None, w) for i, t in items if (w := words(t))]
    windows: dict = {}
    for item, w in cut:
        for k in range(max(len(w) - window, 0) + 1):
            windows.setdefault(tuple(w[k : k + window]), set()).add(item)
    out = []
    for doc, text in docs:
        own = words(text)
        hit, found = set(), set()
        for n in {len(w) for w in windows}:
            for k in range(len(own) - n + 1):
                if (names := windows.get(tuple(own[k : k + n]))) is not None:
                    hit |= set(range(k, k + n))
                    found |= names - {None}
        listed = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((str(doc), len(own), len(hit), len(found), listed, bool(hit)))
    return sorted(out)


def tables(seed):
    r = random.Random(seed)
    word = lambda: r.choice(["The", "the", "a", "Été", "été", "b7", "ＡＢ", "x_y"])
    items = [(i % 17 if i != 5 else None, r.choice([" ", "\n", "--"]).join(word() for _ in range(r.choice([0, 1, 3, 9, 10, 11, 30])))) for i in range(25)]
    docs = []
    for i in range(60):
        parts = [word() for _ in range(r.randint(0, 60))]
        for _ in range(r.randint(0, 2)):
            parts.append(r.choice(items)[1])
        docs.append((r.randint(0, 40), " ".join(parts)))
    docs += [(1, None), (2, ""), (None, items[3][1] + " tail"), docs[0], docs[0], (77, "a b7 " * 20_000)]
    return docs, [*items, (40, None), (41, ""), (42, "!!")]


@pytest.mark.parametrize(("seed", "limit"), [(1, 1 << 20), (2, -1)])
def test_hard_tables(spark, seed, limit):
    docs, items = tables(seed)
    d = spark.createDataFrame([(*row, "x", "y", 1) for row in docs], "doc_id long, text string, items string, item_id string, digest int")
    b = spark.createDataFrame([(*row, 3) for row in items], "item_id long, text string, doc_id int")
    found = decontaminate(d, b, broadcast_bytes=limit)
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in found.collect())
    want = brute(docs, items, 10)
    assert got == want
    clean = without_contaminated(d, found)
    assert clean.columns == d.columns
    assert clean.count() == sum(not row[-1] for row in want)


def test_spans(spark):
    d = spark.createDataFrame([(1, "zero one two three four one two")], "doc_id long, text string")
    b = spark.createDataFrame([("q", "One, two"), ("r", "two three")], "item_id string, text string")
    row = decontaminate(d, b).first()
    assert [(s["start"], s["stop"]) for s in row["spans"]] == [(1, 4), (5, 7)] and row["items"] == ["q", "r"]


@pytest.mark.parametrize("name", ["docs", "items"])
def test_empty_tables(spark, name):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string").where(F.lit(name != "docs"))
    b = spark.createDataFrame([(1, "a b")], "item_id long, text string").where(F.lit(name != "items"))
    got = decontaminate(d, b).collect()
    assert [(r["n_words"], r["n_hit"]) for r in got] == ([(2, 0)] if name == "items" else [])


def test_work_grows_with_words_and_hits(spark):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet").collect()]
    docs = [(1, " ".join(t for _, t in items) * 4), (2, "no hit at all"), (3, items[0][1])]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    start = time.perf_counter()
    got = {r["doc_id"]: r for r in decontaminate(d, b).collect()}
    assert time.perf_counter() - start < 30
    assert got[1]["n_items"] == len(items) and not got[2]["contaminated"] and got[3]["n_hit"] == got[3]["n_words"]
    assert len(got[1]["spans"]) < 10


def test_rows_without_marks_go_to_many_keys(spark):
    rows = [(None, "")] * 3000 + [(i, f"word{i} word{i + 1} common words of all the items here and more") for i in range(300)]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    b = spark.createDataFrame([(1, "common words of all the items here and more words"), (2, "of all the")], "item_id long, text string")
    got = decontaminate(d, b, broadcast_bytes=-1).collect()
    assert len(got) == 3300 and sum(r["contaminated"] for r in got) == 300
