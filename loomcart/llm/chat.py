"""Chat formatting from an event log.

Events of a conversation are folded in order into its final messages, and these are rendered with turn markers. Every
character of a text that could begin a marker is escaped by a backslash, so the output can be read back exactly.

Event kinds: ``message`` opens a whole message; ``delta`` appends to the last message of its turn, or opens one;
``edit`` replaces the text of the last message of its turn; ``regenerate`` empties it and drops the messages of later
turns, which answered it. A delta, edit or regeneration follows what its turn holds so far; an edit or regeneration
of a turn without a message changes nothing.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcart.session import ship_package

OPEN, CLOSE = "### ", "</turn>\n"
_IN_TEXT = re.compile(r"[\\#<]")
_IN_ROLE = re.compile(r"[\\#<:\n]")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"### ([^\\#<:\n]*(?:\\.[^\\#<:\n]*)*):\n([^\\#<]*(?:\\.[^\\#<]*)*)</turn>\n", re.DOTALL)
ASSISTANT = "assistant"


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(messages: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation, and the character ranges of the assistant's texts in it."""
    parts, spans, at = [], [], 0
    for role, text in messages:
        head = OPEN + _IN_ROLE.sub(r"\\\g<0>", role) + ":\n"
        body = _IN_TEXT.sub(r"\\\g<0>", text)
        if role == ASSISTANT:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, CLOSE]
        at += len(head) + len(body) + len(CLOSE)
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation."""
    found, at = [], 0
    while at < len(formatted):
        turn = _TURN.match(formatted, at)
        if not turn:
            raise ValueError(f"no turn at character {at}")
        found.append((unescape(turn[1]), unescape(turn[2])))
        at = turn.end()
    return found


def fold(events: Iterable[tuple[int, str, str, str]]) -> list[tuple[str, str]]:
    """Final messages, by turn, from (turn, kind, role, text) in the order of the log."""
    turns: dict[int | None, list[list]] = {}
    for turn, kind, role, text in events:
        own = turns.setdefault(turn, [])
        if kind == "message" or kind == "delta" and not own:
            own.append([role, [text]])
        elif kind == "delta":
            own[-1][1].append(text)
        elif kind == "edit" and own:
            own[-1][1] = [text]
        elif kind == "regenerate" and own:
            own[-1][1] = []
            for later in [t for t in turns if turn is not None and t is not None and t > turn]:
                del turns[later]
    ordered = sorted(turns, key=lambda t: (t is not None, t or 0))
    return [(role, "".join(text)) for turn in ordered for role, text in turns[turn]]


def format_chats(log: DataFrame) -> DataFrame:
    """One row per conversation of an event log (conv_id, seq, turn, kind, role, text): ``conv_id, n_turns, formatted,
    loss_spans``.

    The log is dealt out by conversation and sorted by (seq, turn, kind, role, text); a task holds one conversation's
    messages at a time. Null role or text counts as empty, a null kind as ``message``; null sequence numbers and turns
    come first; null conversation ids form one conversation. Repeated rows are events like others. An empty log gives no row.
    """
    ship_package(log.sparkSession)

    def fold_all(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((r["conv_id"], r["turn"], r["kind"], r["role"], r["text"]) for b in batches for r in b.to_pylist())
        out: list[dict] = []
        size = 0
        for conv, events in itertools.groupby(rows, key=lambda r: r[0]):
            messages = fold(e[1:] for e in events)
            formatted, spans = render(messages)
            out.append({"conv_id": conv, "n_turns": len(messages), "formatted": formatted, "loss_spans": [{"start": a, "stop": b} for a, b in spans]})
            size += len(formatted)
            if size > 4 << 20:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    span = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
    arrow = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("formatted", pa.string()), ("loss_spans", pa.list_(span))])
    events = log.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("seq").cast("long").alias("seq"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("kind", F.lit("message")).alias("kind"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return (
        events.repartition("conv_id")
        .sortWithinPartitions("conv_id", "seq", "turn", "kind", "role", "text")
        .mapInArrow(fold_all, "conv_id long, n_turns long, formatted string, loss_spans array<struct<start:long,stop:long>>")
    )


def read_back(chats: DataFrame) -> DataFrame:
    """Digests of what formatted conversations hold, from the formatted text alone."""
    ship_package(chats.sparkSession)

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                turns = parse(row["formatted"])
                loss = "".join(unescape(row["formatted"][s["start"] : s["stop"]]) for s in row["loss_spans"])
                said = "".join(f"{role}\n{text}\n" for role, text in turns)
                out.append(
                    {
                        "conv_id": row["conv_id"],
                        "n_turns": len(turns),
                        "turns_sha256": hashlib.sha256(said.encode()).hexdigest(),
                        "loss_chars": len(loss),
                        "loss_sha256": hashlib.sha256(loss.encode()).hexdigest(),
                        "formatted_chars": len(row["formatted"]),
                    }
                )
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    names = ["conv_id long", "n_turns long", "turns_sha256 string", "loss_chars long", "loss_sha256 string", "formatted_chars long"]
    kinds = {"long": pa.int64(), "string": pa.string()}
    arrow = pa.schema([(n.split()[0], kinds[n.split()[1]]) for n in names])
    return chats.select("conv_id", "formatted", "loss_spans").mapInArrow(digest, ", ".join(names))
