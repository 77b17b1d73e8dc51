from __future__ import annotations

import random
import zlib

from loomcart.llm import sharding
from loomcart.llm.registry import queries


def check(rows, texts, shards, slack):
    """Slots without gaps, sizes near equal, sizes and sums of the texts; returns the number of groups that were cut."""
    assert len(rows) == len(texts)
    slots: dict = {}
    size = [0] * shards
    groups: dict = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
        size[r["shard"]] += r["size"]
        groups.setdefault((r["size"], r["text_crc32"]), set()).add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    wanted = sorted((str(d), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in texts)
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in rows) == wanted
    assert max(abs(s - sum(size) / shards) for s in size) <= slack
    return sum(len(g) > 1 for g in groups.values())


def test_query(spark):
    for scale in ("sf0.001", "sf0.01"):
        folder = f"/root/testdata/{scale}"
        texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
        rows = queries()["op11_sharding"](spark, folder).collect()
        longest = max(len((t or "").encode()) + 1 for _, t in texts)
        assert check(rows, texts, 8, longest) <= 7
        assert {r["law"] for r in rows} == {"bytes"} and {r["grown_shard"] for r in rows} == {None}


def test_hot_group_is_cut_others_stay_whole(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BLOCK_BITS", 3)
    r = random.Random(1)
    texts = [(i, "copied by many " * 4) for i in range(9000)]  # a third of the bytes
    texts += [(10_000 + i, f"{'x' * r.randint(0, 150)} {i // 3}") for i in range(12_000)]
    docs = spark.createDataFrame([(*t, "b", 7) for t in texts], "doc_id long, text string, size string, shard int").repartition(5)
    rows = sharding.shard_records(docs, 8).collect()
    total = sum(row["size"] for row in rows)
    assert check(rows, texts, 8, total / 8 * (sharding.WHOLE + 2 * sharding.TOLERANCE)) == 1
    again = sharding.shard_records(docs, 8).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_many_rounds(spark, monkeypatch):
    for name, value in (("RANGES", 4), ("SAMPLES", 2)):
        monkeypatch.setattr(sharding, name, value)
    r = random.Random(2)
    texts = [(i, "word " * int(r.expovariate(0.05))) for i in range(3000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    assert check(sharding.shard_records(docs, 5).collect(), texts, 5, 3000) < 5


def test_hard_rows(spark, tmp_path):
    schema = "doc_id long, text string, shard string, _row int"
    for texts in ([], [(1, None)], [(None, ""), (None, None), (3, "é"), (3, "é")], [(1, "x" * 3_000_000)] + [(i, "a") for i in range(40)], [(5, "same")] * 900):
        docs = spark.createDataFrame([(*t, "s", 1) for t in texts], schema)
        largest = max((len((t or "").encode()) + 1 for _, t in texts), default=0)
        check(sharding.shard_records(docs, 8).collect(), texts, 8, max(largest, 1) * 8)
    folder = str(tmp_path / "shards")
    sharding.write_shards(sharding.shard_records(docs, 4, carry=["text", "shard"]), folder)
    back = spark.read.parquet(folder)
    assert back.count() == 900 and {(r["shard"], r["count"]) for r in back.groupBy("shard").count().collect()} == {(i, 225) for i in range(4)}
    assert back.select("carried.text", "carried.shard").distinct().collect() == [("same", "s")]


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(i, "t" * i) for i in range(50)], "doc_id long, text string")
    plan = sharding.shard_records(docs, 8)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
