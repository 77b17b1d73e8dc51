from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest

from loomcart.llm import pairbound

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k):
    """item -> the best documents, from the definition."""
    texts = [words(t) for _, t in docs]
    n_docs, total = sum(map(bool, texts)), sum(map(len, texts))
    out = {}
    for item, text in set(items):
        scores = [0] * len(docs)
        for term in set(words(text)):
            df = sum(term in w for w in texts)
            weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
            for i, w in enumerate(texts):
                if tf := w.count(term):
                    m = 100 - 50 + (50 * len(w) * n_docs) // total
                    scores[i] += weight * (1_000_000_000 * tf // (1000 * tf + 20 * m))
        best = sorted((-s, d is None, d or 0) for s, (d, _) in zip(scores, docs) if s > 0)[:k]
        if best:
            out.setdefault(item, []).append([(None if none else d, -s) for s, none, d in best])
    return {k: sorted(v, key=str) for k, v in out.items()}


def got(rows):
    out: dict = {}
    lists: dict = {}
    for r in sorted(rows, key=lambda r: (str(r["item_id"]), r["rank"])):
        lists.setdefault(r["item_id"], []).append((r["rank"], r["doc_id"], r["score"]))
    for item, found in lists.items():
        assert [r for r, _, _ in found] == list(range(1, len(found) + 1))
        out[item] = [[(d, s) for _, d, s in found]]
    return out


@pytest.mark.parametrize(("seed", "block"), [(1, 10_000), (2, 20)])
def test_many_shards_and_blocks(spark, monkeypatch, seed, block):
    for name, value in (("SHARD_BYTES", 3000), ("CHUNK_BYTES", 800), ("BLOCK_TERMS", block)):
        monkeypatch.setattr(pairbound, name, value)
    r = random.Random(seed)
    word = lambda: r.choice(["The", "the", "a", "B", "c9", "é", "x_y"] + [f"w{r.randint(0, 60)}"] * 4)
    docs = [(i, " ".join(word() for _ in range(r.randint(0, 40)))) for i in range(300)]
    docs += [docs[3], docs[3], (500, None), (None, "the a w1 w2"), (501, ""), (502, "w1 " * 50)]
    items = [(i, " ".join(word() for _ in range(r.randint(0, 12)))) for i in range(20)]
    items += [items[2], (None, "the w3 w4"), (77, None), (78, "nowhere"), (79, "")]
    table = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, score int, rank int").repartition(3)
    asked = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, doc_id string")
    assert got(pairbound.ranked_search(table, asked, k=7).collect()) == brute(docs, items, 7)


def test_bounds_hold_and_pairs_skip_more():
    r = np.random.default_rng(3)
    for _ in range(30):
        size = 400
        lists = {}
        for t in range(8):
            places = np.flatnonzero(r.random(size) < r.choice([0.02, 0.1, 0.5])).astype(np.uint32)
            lists[t] = (places, r.integers(1, 1000 - 100 * t, len(places)))
        joint = {}
        for a, b in zip(range(8), range(1, 8)):
            both, i, j = np.intersect1d(lists[a][0], lists[b][0], return_indices=True)
            joint[a, b] = (both, lists[a][1][i] + lists[b][1][j])
        most = lambda found: {key: int(v.max()) if len(v) else 0 for key, (_, v) in found.items()}
        shard = pairbound.Shard(np.arange(size), lists, joint, most(lists), most(joint))
        full = np.zeros(size, np.int64)
        for places, values in lists.values():
            full[places] += values
        rest = pairbound.bounds_of_rest(list(range(8)), shard)
        alone = pairbound.bounds_of_rest(list(range(8)), shard, with_pairs=False)
        assert all(p <= a for p, a in zip(rest, alone)) and full.max() <= rest[0]
        work = []
        for with_pairs in (True, False):
            places, scores, done = pairbound.search_shard(shard, list(range(8)), 5, 0, with_pairs)
            assert (scores == full[places]).all() and set(np.flatnonzero(full >= np.sort(full)[-5])) <= set(places)
            work.append(done)
        assert work[0] <= sum(len(p) for p, _ in lists.values())
        test_bounds_hold_and_pairs_skip_more.total = [x + y for x, y in zip(getattr(test_bounds_hold_and_pairs_skip_more, "total", [0, 0]), work)]
    assert test_bounds_hold_and_pairs_skip_more.total[0] < test_bounds_hold_and_pairs_skip_more.total[1]


def test_long_text_and_empty_tables(spark):
    docs = [(1, "word " * 400_000 + "rare"), (2, "rare word"), (3, "x")]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    asked = spark.createDataFrame([(1, "Rare WORD")], "item_id long, text string")
    assert got(pairbound.ranked_search(table, asked).collect()) == brute(docs, [(1, "rare word")], 50)
    assert pairbound.ranked_search(table.limit(0), asked).collect() == []
    assert pairbound.ranked_search(table, asked.limit(0)).collect() == []
    assert pairbound.ranked_search(spark.createDataFrame([(1, None), (2, "...")], "doc_id long, text string"), asked).collect() == []
