from __future__ import annotations

import hashlib

from hypothesis import given
from hypothesis import strategies as st

from loomcart.llm import chat

TEXTS = st.text(alphabet=st.sampled_from("ab\\#<>/:\n é"), max_size=30)


@given(st.lists(st.tuples(TEXTS, TEXTS), max_size=5))
def test_round_trip(messages):
    formatted, spans = chat.render([("assistant" if i % 2 else role, text) for i, (role, text) in enumerate(messages)])
    assert chat.parse(formatted) == [("assistant" if i % 2 else role, text) for i, (role, text) in enumerate(messages)]
    said = [chat.unescape(formatted[a:b]) for a, b in spans]
    assert said == [text for i, (role, text) in enumerate(messages) if i % 2 or role == "assistant"]


def test_fold():
    log = [
        (0, "message", "user", "hi"), (1, "delta", "assistant", "he"), (1, "delta", "assistant", "llo"),
        (2, "message", "user", "thanks"), (1, "regenerate", "assistant", ""), (1, "delta", "assistant", "good day"),
        (0, "edit", "user", "hi there"), (9, "edit", "user", "lost"),
    ]
    assert chat.fold(log) == [("user", "hi there"), ("assistant", "good day")]


def test_log_rows(spark):
    rows = [
        (1, 0, 0, "message", "user", "a", "z"), (1, 1, 1, None, "assistant", None, "z"), (1, 2, 1, "delta", "assistant", "b", "z"),
        (1, 2, 1, "delta", "assistant", "b", "z"), (None, None, None, "message", None, "c" * 200_000, None),
    ]
    schema = "conv_id long, seq long, turn long, kind string, role string, text string, formatted string"
    log = spark.createDataFrame(rows, schema)
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_chats(log)).collect()}
    assert got[1]["n_turns"] == 2 and got[1]["loss_chars"] == 2
    assert got[1]["turns_sha256"] == hashlib.sha256(b"user\na\nassistant\nbb\n").hexdigest()
    assert got[None]["n_turns"] == 1 and got[None]["loss_chars"] == 0
    assert chat.format_chats(log.limit(0)).collect() == []


def test_query(spark):
    from loomcart.llm.registry import HARD_TEXT, queries

    folder = "/root/testdata/sf0.001"
    rows = {r["conv_id"]: r for r in queries()["op5_chat_format"](spark, folder).collect()}
    table = spark.read.parquet(f"{folder}/conversations.parquet").collect()
    want: dict[int, list] = {-7: [("user", HARD_TEXT), ("assistant", HARD_TEXT)]}
    for r in sorted(table, key=lambda r: (r["conv_id"], r["turn"])):
        want.setdefault(r["conv_id"], []).append((r["role"], r["text"] or ""))
    assert set(rows) == set(want)
    for conv, turns in want.items():
        loss = "".join(t for role, t in turns if role == "assistant")
        assert rows[conv]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert rows[conv]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert rows[conv]["loss_chars"] == len(loss)
