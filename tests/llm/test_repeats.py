"""Substring and suffix-array dedup against brute force on small hard texts."""

from __future__ import annotations

import random

import pytest

from loomcart.llm import superkmer
from loomcart.llm.substring import substring_dedup
from loomcart.llm.suffixarray import match_levels, suffix_array_dedup

SCHEMA = "doc_id long, text string, kept string, pack string"


def brute(rows, window, split):
    ids = [2**63 - 1 if r[0] is None else r[0] for r in rows]
    tokens = [split(r[1] or "") for r in rows]
    first: dict = {}
    for doc, t in zip(ids, tokens):
        for i in range(len(t) - window + 1):
            w = tuple(t[i : i + window])
            first[w] = min(first.get(w, doc), doc)
    out = []
    for row, doc, t in zip(rows, ids, tokens):
        gone = [False] * len(t)
        for i in range(len(t) - window + 1):
            if first[tuple(t[i : i + window])] < doc:
                gone[i : i + window] = [True] * window
        kept = [x for x, g in zip(t, gone) if not g]
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((str(row[0]), len(t), sum(gone), spans, kept))
    return sorted(out, key=str)


def texts(seed):
    r = random.Random(seed)
    vocabulary = ["a", "bb", "é", "ccc", "d\x00d", "zz"]
    passages = [[r.choice(vocabulary) for _ in range(r.randint(5, 60))] for _ in range(6)]
    rows = [(3, None, "x", "y"), (4, "", None, None), (5, " \t ", "", ""), (6, "a", "", ""), (None, "a bb " * 40, "", "")]
    for i in range(60):
        words = [r.choice(vocabulary) for _ in range(r.randint(0, 30))]
        for _ in range(r.randint(0, 3)):
            at = r.randint(0, len(words))
            words[at:at] = r.choice(passages)
        rows.append((r.randint(0, 40), r.choice([" ", "\n", "  "]).join(words), "x", "y"))
    return rows + [(7, "a " * 5000, "", ""), (90, "a " * 3000 + "bb", "", ""), rows[-1], (None, "a bb " * 50, "", "")]


@pytest.mark.parametrize(("seed", "hot"), [(1, 20_000), (2, 3)])
def test_words(spark, seed, hot):
    rows = texts(seed)
    got = substring_dedup(spark.createDataFrame(rows, SCHEMA).repartition(3), hot=hot).collect()
    want = [
        (i, n, g, b" ".join(k).decode()) for i, n, g, _, k in brute(rows, 13, lambda t: t.encode().split())
    ]
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept"]) for r in got) == sorted(want)


@pytest.mark.parametrize(("seed", "hot"), [(3, 20_000), (4, 3)])
def test_bytes(spark, seed, hot):
    rows = texts(seed)
    got = suffix_array_dedup(spark.createDataFrame(rows, SCHEMA).repartition(3), hot=hot).collect()
    want = sorted((i, n, g, s, bytes(k)) for i, n, g, s, k in brute(rows, 50, lambda t: list(t.encode())))
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in got) == want


def test_long_texts_in_steps(spark, monkeypatch):
    monkeypatch.setattr(superkmer, "STEP", 97)
    rows = texts(5)
    spec = superkmer.Spec(13, 3, True)
    whole = b"".join(b" ".join((r[1] or "").encode().split()) + b" " for r in rows if (r[1] or "").split())
    import numpy as np

    buffer = np.frombuffer(whole, np.uint8)
    token = np.concatenate([[0], np.flatnonzero(buffer == 32) + 1])
    lengths = [len((r[1] or "").split()) for r in rows]
    pack = superkmer.Pack(buffer, np.zeros(len(rows)), np.ones(len(rows), bool), np.concatenate([[0], np.cumsum(lengths)]), token)
    starts, counts, _ = superkmer.super_kmers(pack, spec)
    covered = sorted(x for s, c in zip(starts, counts) for x in range(s, s + c))
    ends = np.cumsum(lengths)
    want = [i for i in range(len(token) - 13) if not ((ends > i) & (ends < i + 13)).any()]
    assert covered == want


def test_levels_do_not_depend_on_batches():
    r = random.Random(9)
    parts = [bytes(r.choice(b"ab") for _ in range(r.randint(8, 60))) for _ in range(80)]
    docs = [r.randint(0, 30) for _ in parts]
    def hits(batch):
        return sorted((i, f + j) for i, f, n in match_levels(parts, docs, 8, batch) for j in range(n))
    first: dict = {}
    for p, d in zip(parts, docs):
        for i in range(len(p) - 7):
            first[p[i : i + 8]] = min(first.get(p[i : i + 8], d), d)
    want = sorted((k, i) for k, (p, d) in enumerate(zip(parts, docs)) for i in range(len(p) - 7) if first[p[i : i + 8]] < d)
    assert hits(10_000) == hits(100) == hits(7) == want


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert substring_dedup(empty).collect() == [] == suffix_array_dedup(empty).collect()
