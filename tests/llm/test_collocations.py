from __future__ import annotations

import random
import re

import numpy as np
import pytest

from loomcart.llm import collocations


def brute(rows, least, longest, top, percent=100):
    """From the definition, in plain Python."""
    pieces: dict = {}
    for lang, text in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        own = pieces.setdefault("und" if lang is None else lang, [])
        own += [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", text)]
    out = []
    for lang, own in pieces.items():
        f: dict = {}
        for words in own:
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    key = tuple(words[i : i + size])
                    f[key] = f.get(key, 0) + 1
        n = sum(map(len, own))
        many = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in many.items():
            longer = [q for q in many if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if any(100 * many[q] >= percent * a for q in longer):
                continue
            score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


def texts(seed, number):
    r = random.Random(seed)
    stock = ["The end of the", "a b a b a b", "x x x x x x x", "é ü\tö é ü ö", "new  york city", "one\rtwo\x0bthree"]
    word = lambda: r.choice(stock + [f"w{int(r.expovariate(0.2))}"] * 6)
    mark = lambda: r.choice([" ", " ", " ", ". ", ",", "\n", "  "])
    return [(r.choice(["en", "fr", None]), "".join(word() + mark() for _ in range(r.randint(0, 60)))) for _ in range(number)]


@pytest.mark.parametrize(("seed", "broadcast"), [(1, 1 << 20), (1, -1), (2, 300), (2, -1)])
def test_against_brute_force(spark, monkeypatch, seed, broadcast):
    settings = (("CHUNK_BYTES", 3000), ("TILE", 4), ("DENSE_TILES", 3), ("BIN_POSITIONS", 500), ("HELD", 200), ("BROADCAST_BYTES", broadcast))
    for name, value in settings:
        monkeypatch.setattr(collocations, name, value)
    rows = texts(seed, 150) + [("en", None), (None, ""), ("de", ". ,")]
    docs = spark.createDataFrame([(*r, "p", 1) for r in rows], "lang string, text string, phrase string, id int").repartition(3)
    assert rows_of(collocations.collocations(docs, least=10, top=50)) == brute(rows, 10, 5, 50)
    assert rows_of(collocations.collocations(docs, least=7, longest=3, top=9, inside_percent=60)) == brute(rows, 7, 3, 9, 60)


def test_cells_dense_and_sparse():
    r = np.random.default_rng(1)
    left = np.append(r.integers(0, 600, 200_000), r.integers(0, 100_000, 50_000))
    right = np.append(r.zipf(1.5, 200_000) % 700, r.integers(0, 90_000, 50_000))
    cells, counts = collocations.cells_of(left, right, 100_000)
    want = np.unique(left * 100_000 + right, return_counts=True)
    order = np.argsort(cells)
    assert (cells[order] == want[0]).all() and (counts[order] == want[1]).all()


def test_hard_rows(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert collocations.collocations(empty).collect() == []
    rows = [("en", "w " * 300_000 + "x" * 2_000_000)] + [("en", "same text of all")] * 400 + [(None, None)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert rows_of(collocations.collocations(docs)) == brute(rows, 100, 5, 2000)
