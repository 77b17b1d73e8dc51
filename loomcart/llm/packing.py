"""Packing documents into sequences of a fixed window by non-negative least squares.

A document is cut into whole windows and one remainder. Shallow combinations of up to three lengths that fill a window
exactly are enumerated; least squares with non-negative repeat counts fits them to the histogram of lengths; the counts
are rounded, and what is left is packed greedily, largest length first. The plan is made from the histogram, which has
one number for each length, so its size does not depend on the corpus. Pieces get their places by their rank among the
pieces of their length.
"""

from __future__ import annotations

import base64
import itertools
import os
import re
import zlib
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomcart.llm.common import text_chunks
from loomcart.session import materialise, ship_package

END = 0  # the id behind every document
SPECIAL = "<|endoftext|>"
#: Characters of white space in a row that the fast reader's expression is spared; it ends with an error at about a million.
LONG_RUN = 10_000
_RUN = re.compile(rf"\s{{{LONG_RUN}}}")
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Combinations of three lengths tried for each smallest length.
TRIPLES = 8
ROUNDS = 60
#: Pieces of one length that are ranked in one group.
GROUP = 100_000


@cache
def _encoders(ranks_file: str, json_file: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import tiktoken
    from tokenizers import Tokenizer

    with open(ranks_file, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), Tokenizer.from_file(json_file)


def encode(text: str, ranks_file: str, json_file: str) -> np.ndarray:
    """The ids that ``tokenizers`` gives for the JSON file without added special tokens, and the end id.

    The same vocabulary as ranks is read several times faster by ``tiktoken`` and gives the same ids; texts that hold a
    special token's string, which only ``tokenizers`` knows, or a very long run of white space are left to it.
    """
    fast, full = _encoders(ranks_file, json_file)
    if SPECIAL in text or (len(text) >= LONG_RUN and _RUN.search(text)):
        ids = np.array(full.encode(text, add_special_tokens=False).ids, np.uint32)
    else:
        ids = fast.encode_to_numpy(text, disallowed_special=())
    return np.append(ids, np.uint32(END)).astype("<u4")


def combinations(window: int) -> list[tuple[int, ...]]:
    """The whole window, every pair and, for each smallest length, some triples that fill it; smallest lengths first."""
    found = [(window,)]
    for a in range(1, window // 2 + 1):
        found.append((a, window - a))
    for a in range(1, window // 3 + 1):
        room = window - a
        choices = np.unique(np.linspace(a, room // 2, TRIPLES).astype(int))
        found += [(a, int(b), int(room - b)) for b in choices]
    return found


def repeat_counts(lengths: np.ndarray, combos: list[tuple[int, ...]]) -> np.ndarray:
    """Non-negative least squares of the histogram by coordinate descent: each combination's count in turn takes the
    value that fits best, given the others."""
    left = lengths.astype(float)
    counts = np.zeros(len(combos))
    uses = [np.unique(c, return_counts=True) for c in combos]
    norms = [float((m * m).sum()) for _, m in uses]
    for _ in range(ROUNDS):
        moved = 0.0
        for i, (at, m) in enumerate(uses):
            best = max(0.0, counts[i] + float((left[at] * m).sum()) / norms[i])
            if best != counts[i]:
                left[at] -= m * (best - counts[i])
                moved = max(moved, abs(best - counts[i]))
                counts[i] = best
        if moved < 0.25:
            break
    return counts


def plan(histogram: dict[int, int], window: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, how often) for a histogram of lengths from 1 to the window; every piece is placed once."""
    left = np.zeros(window + 1, np.int64)
    for length, count in histogram.items():
        left[length] = count
    combos = combinations(window)
    counts = repeat_counts(left, combos)
    out = []
    for i in np.argsort(-counts, kind="stable"):
        at, m = np.unique(combos[i], return_counts=True)
        number = int(min(round(counts[i]), (left[at] // m).min()))
        if number > 0:
            left[at] -= m * number
            out.append((combos[i], number))
    while left.any():
        rest, used = window, []
        size = int(np.flatnonzero(left)[-1])
        free = left.copy()
        while size:
            times = int(min(rest // size, free[size]))
            used += [size] * times
            rest -= size * times
            free[size] -= times
            fitting = np.flatnonzero(free[: rest + 1])
            size = int(fitting[-1]) if len(fitting) else 0
        at, m = np.unique(used, return_counts=True)
        number = int((left[at] // m).min())
        left[at] -= m * number
        out.append((tuple(used), number))
    return out


def _slots(planned: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length: first rank, first sequence and offset of every run of slots."""
    runs: dict[int, list[tuple[int, int, int]]] = {}
    sequence = 0
    for lengths, number in planned:
        for offset, length in zip(itertools.accumulate((0, *lengths)), lengths):
            runs.setdefault(length, []).append((number, sequence, offset))
        sequence += number
    return {
        length: (np.cumsum([0] + [r[0] for r in own])[:-1], np.array([r[1] for r in own]), np.array([r[2] for r in own]))
        for length, own in runs.items()
    }


def _cut(ranks_file: str, json_file: str, window: int, keep_ids: bool):
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())]
    schema = pa.schema(fields + [("ids", pa.list_(pa.int32()))] * keep_ids)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in text_chunks(batches, "text", 2 << 20):
            out: dict[str, list] = {name: [] for name in schema.names}
            for doc, text in zip(table["doc_id"].to_pylist(), table["text"].to_pylist()):
                ids = encode(text or "", ranks_file, json_file)
                for start in range(0, len(ids), window):
                    part = ids[start : start + window]
                    row = (doc, start, len(part), zlib.crc32(part), len(ids), *([part.tolist()] * keep_ids))
                    for values, value in zip(out.values(), row):
                        values.append(value)
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    return cut


def pack(
    docs: DataFrame,
    ranks_file: str,
    json_file: str,
    window: int = 1024,
    keep_ids: bool = False,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """A row for each piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``, and ``ids`` on demand.

    Null and empty texts are one piece of the end id. Repeated rows and null ids have pieces of their own; columns other
    than id and text are ignored; an empty table gives no piece. Sequences are numbered from 0 without gaps.
    """
    spark = docs.sparkSession
    ship_package(spark)
    kinds = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * keep_ids
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    cut = source.mapInArrow(_cut(ranks_file, json_file, window, keep_ids), kinds)
    # The written number tells equal rows apart and spreads them.
    pieces = materialise(cut.withColumn("_row", F.monotonically_increasing_id()), "pieces")

    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most ``window`` rows
    slots = _slots(plan(histogram, window))
    # Ranks are counted in groups of bounded size, so that a frequent length is not one group.
    groups = 1 + sum(histogram.values()) // GROUP
    grouped = pieces.withColumn("salt", F.pmod(F.xxhash64("_row"), F.lit(groups)))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    sizes = grouped.groupBy("length", "salt").agg(F.count("*").alias("size"))
    bases = sizes.select("length", "salt", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "salt").orderBy("_row")
    ranked = (
        grouped.withColumn("place", F.row_number().over(within))
        .join(bases, ["length", "salt"])
        .select(*cut.columns, (F.col("base") + F.col("place") - 1).alias("rank"))
    )
    where = cut.columns.index("length")

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column(where).to_numpy(), batch.column(batch.num_columns - 1).to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for size in np.unique(length):
                own = np.flatnonzero(length == size)
                first, start, at = slots[int(size)]
                run = np.searchsorted(first, rank[own], "right") - 1
                sequence[own] = start[run] + rank[own] - first[run]
                offset[own] = at[run]
            columns = batch.columns[:-1] + [pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "sequence_id", "offset"])

    return ranked.mapInArrow(place, f"{kinds}, sequence_id long, offset long")
