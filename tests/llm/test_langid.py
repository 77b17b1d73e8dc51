from __future__ import annotations

import math
import random
import zlib

import regex
import xxhash
import zstandard

from loomcart.llm import langid

FR = "le chat noir est assis sur la grande table de la cuisine et regarde par la fenêtre "
EN = "the black cat sits on the large kitchen table and looks out of the window all day "


def test_held_out_accuracy(spark):
    from loomcart.llm.registry import queries

    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    rows = queries()["op2_language_id"](spark, folder).join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r["held_out"] and r["lang"] is not None]
    assert sum(r["lang"] == r["lang_pred"] for r in held) > 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert sum(r["rejected"] for r in rows) < 0.01 * len(rows)


def test_edge_rows(spark):
    model = {"en": langid.prepare(EN * 20), "fr": langid.prepare(FR * 20)}
    rows = [(1, EN, "x"), (1, EN, "x"), (2, FR.upper(), "x"), (3, None, "x"), (4, "", "x"), (5, "12 34 !", "x"), (None, FR * 3000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang_pred string")
    got = sorted((str(r["doc_id"]), r["lang_pred"], r["rejected"]) for r in langid.identify(docs, model).collect())
    assert got == [
        ("1", "en", False), ("1", "en", False), ("2", "fr", False), ("3", "und", True), ("4", "und", True),
        ("5", "und", True), ("None", "fr", False),
    ]
    assert langid.identify(docs.limit(0), model).collect() == []


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([], "text string, lang string")
    assert langid.learn(empty) == {}
    docs = spark.createDataFrame([(1, EN)], "doc_id long, text string")
    assert langid.identify(docs, {}).first()["lang_pred"] == "und"


def test_equal_totals_are_rejected():
    assert langid.decide(["de", "en"], [10, 10])[0::2] == ("de", True)
    assert langid.decide(["de", "en"], [10, 12])[0::2] == ("de", False)


def test_narrow_margins_are_rejected():
    assert langid.decide(["de", "en"], [50_000, 50_001])[2]
    assert langid.decide(["de", "en"], [50_000, 60_000], 50_001)[2]
    assert not langid.decide(["de", "en"], [50_000, 60_000], 60_000)[2]


def test_noise_mixed_and_unlearned_texts_are_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labelled = docs.where(docs["doc_id"].isNotNull() & ~langid.held_out("doc_id"))
    model = langid.learn(labelled)
    r = random.Random(4)
    noise = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz     ") for _ in range(n)) for n in (100, 500, 3000, 100_000)]
    italian = "il gatto nero è seduto sulla grande tavola della cucina e guarda dalla finestra mentre la pioggia cade sopra i tetti "
    polish = "czarny kot siedzi na dużym stole w kuchni i patrzy przez okno podczas gdy deszcz pada na dachy starego miasta "
    texts = {lang: [row["text"] for row in labelled.where(labelled["lang"] == lang).orderBy("doc_id").limit(60).collect()] for lang in model}
    mixed = []
    for a, b in zip(model, [*model][1:]):
        one, two = " ".join(texts[a])[:20_000], " ".join(texts[b])[:20_000]
        best = None
        for share in range(0, 101, 2):  # where the two languages weigh the same
            text = "".join(one[i : i + 2 * share] + " " + two[i : i + 200 - 2 * share] + " " for i in range(0, 20_000, 200))
            totals = langid.sizes(langid.prepare(text), langid._compressors(model, langid.LEVEL))
            gap = abs(totals[[*model].index(a)] - totals[[*model].index(b)])
            best = min(best or (gap, text), (gap, text))
        mixed.append(best[1])
    rows = [(i, t) for i, t in enumerate([*noise, italian, italian * 50, polish, polish * 50, *mixed])]
    got = langid.identify(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    assert [row["doc_id"] for row in got if not row["rejected"]] == []
    clean = langid.identify(labelled.where("octet_length(text) >= 32"), model).collect()
    assert sum(row["rejected"] for row in clean) < 0.01 * len(clean)


def brute(rows):
    """Dictionaries and predictions in plain Python: (doc_id, held_out, language, score, rejected)."""
    learned: dict = {}
    for doc, text, lang in rows:
        if zlib.crc32(str(doc).encode()) % 3 != 1 and lang is not None and text and len(text.encode()) <= 4096:
            h = xxhash.xxh64_intdigest(text.encode(), 42)
            learned.setdefault(lang, {})[h - 2**64 if h >= 2**63 else h] = text
    model = {}
    for lang in sorted(learned):
        content, size = b"", 0
        for _, text in sorted(learned[lang].items()):
            size += len(text.encode()) + 2
            if size > 128 * 1024:
                break
            content += b" " + text.lower().encode() + b"\n"
        model[lang] = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    out = []
    for doc, text, _ in rows:
        held = zlib.crc32(str(doc).encode()) % 3 == 1
        if text is None or not regex.search(r"\p{L}", text):
            out.append((doc, held, "und", 0.0, True))
            continue
        raw = b" " + text.lower().encode()
        blocks = [raw[i : i + 4096] for i in range(0, len(raw), 4096)]
        total = {}
        for lang, shared in model.items():
            one = zstandard.ZstdCompressor(level=12, dict_data=shared, write_content_size=False, write_checksum=False, write_dict_id=False)
            total[lang] = sum(len(one.compress(b)) for b in blocks)
        bare = zstandard.ZstdCompressor(level=12, write_content_size=False, write_checksum=False)
        (best, lang), (second, _), *_ = sorted((n, lang) for lang, n in total.items())
        second = min(second, sum(len(bare.compress(b)) for b in blocks))
        score = 1 / sum(math.exp((best - n) / 4) for n in total.values())
        out.append((doc, held, lang, round(score, 9), second - best < max(2, 0.02 * best)))
    return sorted(out)


def test_query_equals_plain_python(spark):
    from loomcart.llm.registry import queries

    for scale in ("sf0.001", "sf0.01"):
        folder = f"/root/testdata/{scale}"
        rows = [(r["doc_id"], r["text"], r["lang"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
        got = queries()["op2_language_id"](spark, folder).collect()
        assert sorted((r["doc_id"], r["held_out"], r["lang_pred"], round(r["score"], 9), r["rejected"]) for r in got) == brute(rows)
