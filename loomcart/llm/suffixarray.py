"""Suffix-array dedup over bytes with a logarithmic family of indexes.

The positions of a bucket come in batches. A new batch gets its suffix array: positions in the order of the bytes that
follow, as deep as a match must be long. It is merge-scanned against every level that exists; of equal suffixes those of
the smallest document stay, the others are matches. Then the batch becomes a level, and levels of equal size merge, so a
family over n positions has about log n levels and each position is merged about log n times.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame

from loomcart.llm import superkmer

GRAM_BYTES = 16
BATCH = 1 << 18


@dataclass
class Level:
    """Sorted suffixes cut at the depth, with document and position number; one document for each distinct suffix."""

    keys: np.ndarray
    docs: np.ndarray
    refs: np.ndarray

    def only(self, mask: np.ndarray) -> Level:
        return Level(self.keys[mask], self.docs[mask], self.refs[mask])


@dataclass
class LevelFamily:
    """Levels from large to small; ``matched`` gathers the position numbers found in a smaller document too."""

    levels: list[Level] = field(default_factory=list)
    matched: list[np.ndarray] = field(default_factory=list)

    def _settle(self, keys: np.ndarray, docs: np.ndarray, refs: np.ndarray) -> Level:
        """A level from sorted suffixes; those of larger documents are matches and leave."""
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        at = np.flatnonzero(new)
        least = np.repeat(np.minimum.reduceat(docs, at), np.diff(np.append(at, len(keys))))
        self.matched.append(refs[docs > least])
        return Level(keys, docs, refs).only(docs == least)

    def _scan(self, batch: Level, level: Level) -> tuple[Level, Level]:
        """Both without the suffixes that the other has in a smaller document."""
        low = np.searchsorted(level.keys, batch.keys, "left")
        inside = np.minimum(low, len(level.keys) - 1)
        both = level.keys[inside] == batch.keys
        theirs = level.docs[inside]
        lost = both & (theirs < batch.docs)
        self.matched.append(batch.refs[lost])
        won = np.flatnonzero(both & (theirs > batch.docs))
        if len(won):
            high = np.searchsorted(level.keys, batch.keys[won], "right")
            depth = np.zeros(len(level.keys) + 1, np.int64)
            np.add.at(depth, low[won], 1)
            np.add.at(depth, high, -1)
            gone = np.cumsum(depth[:-1]) > 0
            self.matched.append(level.refs[gone])
            level = level.only(~gone)
        return batch.only(~lost), level

    def add(self, keys: np.ndarray, docs: np.ndarray, refs: np.ndarray) -> None:
        """One batch of suffixes, in any order."""
        order = np.argsort(keys, kind="stable")
        batch = self._settle(keys[order], docs[order], refs[order])
        for i, level in enumerate(self.levels):
            if len(level.keys) and len(batch.keys):
                batch, self.levels[i] = self._scan(batch, level)
        self.levels.append(batch)
        while len(self.levels) > 1 and len(self.levels[-1].keys) * 2 > len(self.levels[-2].keys):
            small, large = self.levels.pop(), self.levels.pop()
            keys = np.concatenate([large.keys, small.keys])
            order = np.argsort(keys, kind="stable")  # two sorted runs: a merge
            docs, refs = np.concatenate([large.docs, small.docs]), np.concatenate([large.refs, small.refs])
            self.levels.append(Level(keys[order], docs[order], refs[order]))


def match_levels(texts: list[bytes], docs: list[int], depth: int, batch: int = BATCH) -> Iterator[tuple[int, int, int]]:
    """(text, first position, number of positions) wherever ``depth`` bytes also start in a smaller document's text."""
    family = LevelFamily()
    buffer = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    first = np.concatenate([[0], np.cumsum(sizes)])
    number = sizes - depth + 1
    ends = np.cumsum(number)
    ids = np.array(docs, np.int64)
    view = np.lib.stride_tricks.sliding_window_view(buffer, depth)
    for begin in range(0, int(ends[-1]), batch):
        position = np.arange(begin, min(begin + batch, int(ends[-1])))
        text = np.searchsorted(ends, position, "right")
        start = first[text] + position - (ends[text] - number[text])
        keys = np.ascontiguousarray(view[start]).view(f"S{depth}").reshape(-1)
        family.add(keys, ids[text], position)
    hit = np.sort(np.concatenate(family.matched)) if family.matched else np.empty(0, np.int64)
    if not len(hit):
        return
    text = np.searchsorted(ends, hit, "right")
    new = np.ones(len(hit), bool)
    new[1:] = (hit[1:] != hit[:-1] + 1) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    runs = np.diff(np.append(at, len(hit)))
    offset = hit[at] - (ends[text[at]] - number[text[at]])
    yield from zip(text[at].tolist(), offset.tolist(), runs.tolist())


def suffix_array_dedup(
    docs: DataFrame,
    depth: int = 50,
    doc_id: str = "doc_id",
    text: str = "text",
    *,
    hot: int = superkmer.HOT,
    carry: Sequence[str] = (),
    as_text: bool = False,
) -> DataFrame:
    """Removes every byte covered by ``depth`` bytes that also start in a document with a smaller id.

    Texts are their UTF-8 bytes; matches never cross documents and are judged on the input. Result, one row per input
    row: ``doc_id, n_bytes, n_removed, n_spans, kept`` (binary). Null texts are empty; texts shorter than ``depth`` lose
    nothing. Rows with one id are one document for the comparison, a null id counts as the largest; extra columns are
    ignored, but for those in ``carry``, which come along in the struct ``carried``; an empty table gives an empty result.
    With ``as_text``, ``kept`` is a string without characters that lost a byte.
    """
    spec = superkmer.Spec(depth, min(GRAM_BYTES, depth), words=False)

    def match(texts: list[bytes], ids: list[int]) -> Iterator[tuple[int, int, int]]:
        return match_levels(texts, ids, depth)

    found = superkmer.remove_repeats(docs, spec, match, doc_id=doc_id, text=text, hot=hot, carry=carry, as_text=as_text)
    return found.withColumnRenamed("n_tokens", "n_bytes")
