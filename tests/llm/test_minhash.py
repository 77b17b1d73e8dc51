from __future__ import annotations

import random

import numpy as np
import pytest

from loomcart.llm import minhash

UPPER = {chr(c): chr(c + 32) for c in range(65, 91)}


def brute(rows, percent):
    """Sizes and smallest reachable ids, by comparing all sets that share a shingle."""
    sets: dict = {}
    sizes = []
    for doc, text in rows:
        words = "".join(UPPER.get(c, c) for c in text or "").encode().split()
        k = min(5, len(words))
        found = frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if words else frozenset()
        sizes.append(len(found))
        if found:
            sets.setdefault(found, set()).add(doc)
    docs = {d for d, _ in rows}
    parent = {d: d for d in docs}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(x, y):
        a, b = sorted((root(x), root(y)))
        parent[b] = a

    holders: dict = {}
    for found, members in sets.items():
        first = min(members)
        for d in members:
            join(first, d)
        for shingle in found:
            holders.setdefault(shingle, []).append(found)
    pairs = {(id(a), id(b)): (a, b) for h in holders.values() for i, a in enumerate(h) for b in h[:i]}
    for a, b in pairs.values():
        if 100 * len(a & b) >= percent * len(a | b):
            join(min(sets[a]), min(sets[b]))
    return sorted((d, n, root(d), root(d) == d) for (d, _), n in zip(rows, sizes))


def corpus(seed, groups, size):
    r = random.Random(seed)
    rows, doc = [], 100
    for _ in range(groups):
        base = [f"w{r.randint(0, 3000)}" for _ in range(r.choice([3, 20, 120, 300]))]
        for _ in range(r.randint(1, size)):
            words = list(base)
            for _ in range(int(len(words) * r.choice([0, 0, 0.005, 0.01, 0.02, 0.05]))):
                words[r.randrange(len(words))] = f"x{r.randint(0, 10**9)}"
            rows.append((doc, r.choice([" ", "\n"]).join(words).title() if r.random() < 0.3 else " ".join(words)))
            doc += r.choice([1, 1, 3])
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "groups", "size", "crowd", "block"), [(1, 25, 6, 16, 4096), (2, 3, 150, 4, 4096), (3, 3, 150, 4, 20)])
def test_components(spark, monkeypatch, seed, groups, size, crowd, block):
    monkeypatch.setattr(minhash, "CROWD", crowd)
    monkeypatch.setattr(minhash, "BLOCK", block)
    rows = corpus(seed, groups, size) + [(1, None), (2, ""), (3, " \t"), (4, None)]
    docs = spark.createDataFrame([(*row, "x", "y") for row in rows], "doc_id long, text string, node string, n string")
    got = sorted(tuple(r) for r in minhash.near_duplicates(docs).collect())
    assert got == brute(rows, 85)


def test_whole_table(spark):
    from loomcart.llm.registry import queries

    folder = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in queries()["op7_minhash"](spark, folder).collect())
    assert got == brute(rows, 85)


def test_edge_rows(spark):
    long = "a b c d e f g h " * 20_000
    rows = [(5, "one two"), (5, "one two"), (5, "other words here"), (7, "ONE two"), (9, "Other words here"), (None, "one two"), (None, "lonely"), (8, long), (6, long + "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(docs).collect())
    assert [g for g in got if g[0] in "579"] == [("5", 1, 5, True)] * 3 + [("7", 1, 5, False), ("9", 1, 5, False)]
    assert [g[2] for g in got if g[0] == "None"] == [5, 5]
    assert [g[2] for g in got if g[0] == "8"] == [6]
    assert minhash.near_duplicates(docs.limit(0)).collect() == []


def test_components_of_a_chain(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(101, 100), (100, 102), (7, 7)]
    got = {r["node"]: r["component"] for r in minhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {101: 100, 102: 100}


def test_pruning_keeps_links():
    r = np.random.default_rng(1)
    a = r.integers(0, 256, (20_000, minhash.KEPT), dtype=np.uint8)
    b = np.where(r.random(a.shape) < 0.85, a, r.integers(0, 256, a.shape, dtype=np.uint8))
    assert minhash.survivors(a, b, 0.85, 1e-6).all()
    far = np.where(r.random(a.shape) < 0.4, a, r.integers(0, 256, a.shape, dtype=np.uint8))
    assert not minhash.survivors(a, far, 0.85, 1e-6).any()


def test_bands_follow_the_threshold():
    assert minhash.banding(85) == (40, 8)
    for percent in range(1, 101):
        bands, rows = minhash.banding(percent)
        assert (1 - (percent / 100) ** rows) ** bands <= minhash.BAND_MISS
        assert bands * rows <= minhash.HASHES or percent < 4
    with pytest.raises(ValueError):
        minhash.banding(0)


def test_links_at_a_lower_threshold(spark):
    rows = []
    for i in range(60):
        base = [f"w{i}x{j}" for j in range(104)]
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(base[:80] + [f"v{i}x{j}" for j in range(20)]))]  # 76 of 120 shingles
    got = sorted(tuple(r) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), percent=60).collect())
    assert got == brute(rows, 60)
    assert sum(kept for *_, kept in got) == 60


def test_the_grid_carries_no_texts(spark, monkeypatch):
    """Texts of one template at similarity 0.80, none linked at 85: blocks meet by ids and signatures only."""
    monkeypatch.setattr(minhash, "BLOCK", 100)
    grids, texts = [], []
    real = minhash.materialise

    def spied(df, label, **kw):
        out = real(df, label, **kw)
        if label == "screened":
            grids.append("packed" in df.columns)
            texts.append(out.count())
        return out

    monkeypatch.setattr(minhash, "materialise", spied)
    template = [f"t{i}" for i in range(180)]
    rows = [(i, " ".join(template + [f"own{i}x{j}" for j in range(20)])) for i in range(500)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r["doc_id"] for r in got if r["kept"]) == list(range(500))
    assert grids == [False] and texts == [0]


@pytest.mark.parametrize("block", [4096, 30])
def test_components_at_80(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "CROWD", 4)
    monkeypatch.setattr(minhash, "BLOCK", block)
    rows = corpus(7, 4, 120)
    got = sorted(tuple(r) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), percent=80).collect())
    assert got == brute(rows, 80)
