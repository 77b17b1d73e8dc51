"""Substring dedup over words: super-k-mers travel as packed strings to their minimisers' buckets, where windows are
sorted and counted exactly."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcart.llm import superkmer

GRAM_WORDS = 3


def match_sorted(texts: list[bytes], docs: list[int], window: int) -> Iterator[tuple[int, int, int]]:
    """(text, first window, number of windows) wherever an equal window lies in a text of a smaller document."""
    entries = []
    for i, text in enumerate(texts):
        words = text.split(b" ")
        entries += [(b" ".join(words[j : j + window]), docs[i], i, j) for j in range(len(words) - window + 1)]
    entries.sort()
    last, smallest = None, 0
    for phrase, doc, i, j in entries:
        if phrase != last:
            last, smallest = phrase, doc  # sorted by document within a phrase
        elif doc > smallest:
            yield i, j, 1


def substring_dedup(
    docs: DataFrame, window: int = 13, doc_id: str = "doc_id", text: str = "text", hot: int = superkmer.HOT
) -> DataFrame:
    """Removes words covered by a window of ``window`` words that also starts in a document with a smaller id.

    Words are runs of bytes other than blanks and 09-0D, as they stand; windows are judged on the input. Result, one row
    per input row: ``doc_id, n_words, n_removed, kept`` with the kept words joined by one blank. Null or empty texts and
    texts of fewer words than the window lose nothing. Rows with one id are one document for the comparison, a null id
    counts as the largest; extra columns are ignored; an empty table gives an empty result.
    """
    spec = superkmer.Spec(window, min(GRAM_WORDS, window), words=True)

    def match(texts: list[bytes], ids: list[int]) -> Iterator[tuple[int, int, int]]:
        return match_sorted(texts, ids, window)

    found = superkmer.remove_repeats(docs, spec, match, doc_id=doc_id, text=text, hot=hot)
    return found.select("doc_id", F.col("n_tokens").alias("n_words"), "n_removed", F.decode("kept", "UTF-8").alias("kept"))
