"""Ranked search by MaxScore with bounds on pairs of terms.

Documents are indexed in shards. For the queries of a block every shard gets the impacts of their terms (a document's part
of the score), and for each pair of terms that stand side by side in a query, by falling weight, an intersection list with
the joint impact of its documents and their maximum. A document with both terms cannot score more on them than the joint
maximum, one with a single term not more than that term's, so the bound of a pair is mostly below the sum of two. A query
adds its terms from the heaviest; once the combined bound of those left is below the k-th best score, documents that hold
none of the terms so far are skipped, and the others are dropped as soon as what is left cannot lift them over it.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomcart.llm.common import LAST_ID, UPPER, Numbers, expand, squeeze, text_chunks
from loomcart.session import discard, materialise, ship_package

SHARD_BYTES = 16 << 20
CHUNK_BYTES = 4 << 20
#: Terms of the queries that are searched in one pass over the index, each query's counted; they travel by broadcast.
BLOCK_TERMS = 16_384
_WORDS = bytes(b + 32 if chr(b) in UPPER else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms_of(text: str) -> list[bytes]:
    """Runs of letters, digits and non-ASCII characters, A-Z in lower case."""
    return text.encode().translate(_WORDS).split()


# Index

_BLOBS = ("ids", "lengths", "vocabulary", "counts", "places", "freqs")
_INDEX = pa.schema([("docs", pa.int64()), ("tokens", pa.int64())] + [(c, pa.binary()) for c in _BLOBS])
_INDEX_SQL = "docs long, tokens long, " + ", ".join(f"{c} binary" for c in _BLOBS)


def _build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = Numbers()
    ids: list[int] = []
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    lengths: list[int] = []
    size = 0

    def close() -> pa.RecordBatch:
        code, freq = (np.concatenate(c) for c in zip(*parts))
        order = np.argsort(code)  # by term, then by document
        code, freq = code[order], freq[order]
        blobs = {
            "ids": squeeze(np.array(ids, np.int64)),
            "lengths": squeeze(np.array(lengths, np.int64)),
            "vocabulary": zstandard.compress(b"\n".join(number), 1),
            "counts": squeeze(np.bincount(code >> 32, minlength=len(number)).astype(np.uint32)),
            "places": squeeze((code & 0xFFFFFFFF).astype(np.uint32)),
            "freqs": squeeze(freq.astype(np.uint32)),
        }
        n = np.array(lengths)
        row = {"docs": int((n > 0).sum()), "tokens": int(n.sum())} | blobs
        return pa.RecordBatch.from_pydict({k: [v] for k, v in row.items()}, schema=_INDEX)

    for table in text_chunks(batches, "text", CHUNK_BYTES):
        words = [terms_of(t or "") for t in table["text"].to_pylist()]
        counts = [len(w) for w in words]
        term = np.fromiter((number[w] for own in words for w in own), np.int64, sum(counts))
        place = np.repeat(np.arange(len(ids), len(ids) + len(counts)), counts)
        parts.append(np.unique(term << 32 | place, return_counts=True))
        ids += [LAST_ID if i is None else i for i in table["doc_id"].to_pylist()]
        lengths += counts
        size += table["text"].nbytes
        if size >= SHARD_BYTES:
            yield close()
            number, ids, parts, lengths, size = Numbers(), [], [], [], 0
    if ids:
        yield close()


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Index shards, a row each, with every document and every term; the terms are kept as they are."""
    ship_package(docs.sparkSession)
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return source.mapInArrow(_build, _INDEX_SQL)


def _vocabulary(blob: bytes) -> list[bytes]:
    joined = zstandard.decompress(blob)
    return joined.split(b"\n") if joined else []


def _frequencies(numbers: dict[bytes, int]):
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                counts = expand(row["counts"], np.uint32)
                found = [(numbers[t], int(counts[i])) for i, t in enumerate(_vocabulary(row["vocabulary"])) if t in numbers]
                yield pa.RecordBatch.from_pydict({"term": [t for t, _ in found], "df": [n for _, n in found]}, pa.schema([("term", pa.int64()), ("df", pa.int64())]))

    return count


# Impacts and pairs of a block of queries


@dataclass(frozen=True)
class Block:
    """Queries searched together: their terms, weights, and each query's terms by falling weight."""

    terms: list[bytes]
    weights: list[int]
    queries: list[tuple[int, list[int]]]  # number of the query, its terms
    docs: int
    tokens: int

    def pairs(self) -> list[tuple[int, int]]:
        return sorted({p for _, own in self.queries for p in pairwise(own)})


def weight_of(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


def impacts_of(freqs: np.ndarray, lengths: np.ndarray, weight: int, docs: int, tokens: int) -> np.ndarray:
    """What a term adds to the score of documents that hold it ``freqs`` times."""
    norm = 50 + (50 * lengths * docs) // tokens
    return weight * ((1_000_000_000 * freqs) // (1000 * freqs + 20 * norm))


_LISTS = ("ids", "terms", "starts", "places", "impacts", "pairs", "pair_starts", "pair_places", "joint")
_LISTS_SQL = ", ".join(f"{c} binary" for c in _LISTS)


def _lists(block: Block):
    """Rows of the index -> the shard's impacts for the block's terms, and its pair lists."""
    numbers = {t: i for i, t in enumerate(block.terms)}
    pairs = block.pairs()

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                counts = expand(row["counts"], np.uint32).astype(np.int64)
                places, freqs = expand(row["places"], np.uint32), expand(row["freqs"], np.uint32).astype(np.int64)
                lengths = expand(row["lengths"], np.int64)
                ends = np.cumsum(counts)
                own: dict[int, tuple[np.ndarray, np.ndarray]] = {}
                for i, t in enumerate(_vocabulary(row["vocabulary"])):
                    if t in numbers and block.weights[numbers[t]] > 0:
                        at = slice(ends[i] - counts[i], ends[i])
                        own[numbers[t]] = (places[at], impacts_of(freqs[at], lengths[places[at]], block.weights[numbers[t]], block.docs, block.tokens))
                both: dict[int, tuple[np.ndarray, np.ndarray]] = {}
                for n, (a, b) in enumerate(pairs):
                    if a in own and b in own:
                        shared, i, j = np.intersect1d(own[a][0], own[b][0], assume_unique=True, return_indices=True)
                        both[n] = (shared, own[a][1][i] + own[b][1][j])

                def blobs(lists: dict[int, tuple[np.ndarray, np.ndarray]]) -> list[bytes]:
                    keys = sorted(lists)
                    starts = np.cumsum([0] + [len(lists[k][0]) for k in keys])
                    joined = [np.concatenate([lists[k][c] for k in keys]) if keys else np.empty(0) for c in (0, 1)]
                    return [squeeze(v) for v in (np.array(keys, np.int64), starts.astype(np.int64), joined[0].astype(np.uint32), joined[1].astype(np.int64))]

                values = [row["ids"], *blobs(own), *blobs(both)]
                yield pa.RecordBatch.from_pydict({c: pa.array([v], pa.binary()) for c, v in zip(_LISTS, values)})

    return make


# Search

NONE = (np.empty(0, np.uint32), np.empty(0, np.int64))


@dataclass(frozen=True)
class Shard:
    """Impacts by term and joint impacts by pair, each with the places of the documents."""

    ids: np.ndarray
    lists: dict[int, tuple[np.ndarray, np.ndarray]]
    joint: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]
    most: dict[int, int]
    joint_most: dict[tuple[int, int], int]


def open_shard(row: dict, pairs: list[tuple[int, int]]) -> Shard:
    def lists(names: Iterable[str]) -> dict:
        keys, starts, places, values = (expand(row[c], kind) for c, kind in zip(names, (np.int64, np.int64, np.uint32, np.int64)))
        return {int(k): (places[a:b], values[a:b]) for k, a, b in zip(keys, starts, starts[1:])}

    own = lists(_LISTS[1:5])
    joint = {pairs[n]: v for n, v in lists(_LISTS[5:]).items()}
    top = lambda found: {k: int(v.max()) if len(v) else 0 for k, (_, v) in found.items()}
    return Shard(expand(row["ids"], np.int64), own, joint, top(own), top(joint))


def bounds_of_rest(terms: list[int], shard: Shard, with_pairs: bool = True) -> list[int]:
    """For every i the most that the terms from i on can add to a document: the least sum over ways to take neighbours
    as pairs."""
    rest = [0] * (len(terms) + 2)
    for i in reversed(range(len(terms))):
        own = shard.most.get(terms[i], 0)
        rest[i] = own + rest[i + 1]
        if with_pairs and i + 1 < len(terms):
            pair = max(own, shard.most.get(terms[i + 1], 0), shard.joint_most.get((terms[i], terms[i + 1]), 0))
            rest[i] = min(rest[i], pair + rest[i + 2])
    return rest[: len(terms) + 1]


def kth(values: np.ndarray, k: int) -> int:
    """The k-th largest value, 0 where there are fewer."""
    return int(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else 0


def search_shard(shard: Shard, terms: list[int], k: int, least: int, with_pairs: bool = True) -> tuple[np.ndarray, np.ndarray, int]:
    """Places and scores of all documents of the shard that may belong to the best ``k``, given that a score below
    ``least`` does not, and the number of postings that were added or looked up."""
    rest = bounds_of_rest(terms, shard, with_pairs)
    least = max(least, 1)
    if with_pairs:
        least = max([least, *(kth(shard.joint.get(p, NONE)[1], k) for p in pairwise(terms))])
    scores = np.zeros(len(shard.ids), np.int64)
    work = at = 0
    while at < len(terms) and rest[at] >= least:
        places, values = shard.lists.get(terms[at], NONE)
        scores[places] += values
        work += len(places)
        at += 1
        if len(scores) >= k and rest[at] < rest[0]:
            least = max(least, kth(scores, k))
    left = np.flatnonzero(scores)
    for i in range(at, len(terms)):
        left = left[scores[left] + rest[i] >= least]
        places, values = shard.lists.get(terms[i], NONE)
        if len(places) <= len(left):
            scores[places] += values  # documents that were dropped or skipped are not read again
            work += len(places)
        else:
            spot = np.minimum(np.searchsorted(places, left), len(places) - 1)
            same = places[spot] == left
            scores[left[same]] += values[spot[same]]
            work += len(left)
        least = max(least, kth(scores[left], k))
    left = left[scores[left] >= least]
    return left, scores[left], work


def _search(block: Block, k: int):
    pairs = block.pairs()

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The best of the task's shards so far; the next shard is pruned by them.
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                shard = open_shard(row, pairs)
                for query, terms in block.queries:
                    ids, scores = held.get(query, (np.empty(0, np.int64), NONE[1]))
                    least = int(scores[-1]) if len(scores) == k else 0
                    places, found, _ = search_shard(shard, terms, k, least)
                    if len(places):
                        ids, scores = np.append(ids, shard.ids[places]), np.append(scores, found)
                        order = np.lexsort((ids, -scores))[:k]
                        held[query] = (ids[order], scores[order])
        for query, (ids, scores) in held.items():
            yield pa.RecordBatch.from_pydict({"query": np.full(len(ids), query), "doc_id": ids, "score": scores})

    return search


def _split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        terms = [sorted(set(terms_of(t))) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(terms, pa.list_(pa.binary()))], ["item_id", "terms"])


def ranked_search(
    docs: DataFrame, items: DataFrame, k: int = 50, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """The best ``k`` documents of every item: ``item_id, rank, doc_id, score``.

    A term's weight is ``floor(1000 ln((2N+2)/(2df+1)))``, where N documents have a term and df hold this one. A score sums
    weight x ``10^9 tf div (1000 tf + 20 m)`` over the item's distinct terms, m being 50 and 50 times the document's length
    over the mean length, rounded down. Only scores above 0 are listed; equal ones by ascending id, null last. Null and
    empty texts have no terms, and items without terms no row. Every row of documents is one; repeated rows are listed
    each. Rows that repeat an item's id and text are one item, a null item id is one as any other. Extra columns are
    ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    index = materialise(build_index(docs, doc_id, text), "pair-index")
    total, tokens = (int(v or 0) for v in index.agg(F.sum("docs"), F.sum("tokens")).first())
    asked = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text")).dropna(subset=["text"]).distinct()
    split = asked.mapInArrow(_split, "item_id long, terms array<binary>").where(F.size("terms") > 0)
    queries = materialise(split.withColumn("query", F.monotonically_increasing_id()), "pair-queries")
    blocks = 1 + int(queries.agg(F.sum(F.size("terms"))).first()[0] or 0) // BLOCK_TERMS
    dealt = queries.withColumn("block", F.pmod(F.xxhash64("query"), F.lit(blocks)))
    results = []
    for number in range(blocks):  # each reads the whole index
        rows = dealt.where(F.col("block") == number).select("query", "terms").collect()
        if not rows or not tokens:
            continue
        known = Numbers()
        own = [(r["query"], [known[bytes(t)] for t in r["terms"]]) for r in rows]
        counted = index.select("vocabulary", "counts").mapInArrow(_frequencies(dict(known)), "term long, df long")
        df = {r["term"]: r["df"] for r in counted.groupBy("term").agg(F.sum("df").alias("df")).collect()}
        weights = [weight_of(total, df[i]) if i in df else 0 for i in range(len(known))]
        ordered = [(q, sorted((t for t in terms if weights[t] > 0), key=lambda t: (-weights[t], t))) for q, terms in own]
        block = Block(list(known), weights, ordered, total, tokens)
        lists = materialise(index.mapInArrow(_lists(block), _LISTS_SQL), "pair-lists")
        results.append(materialise(lists.mapInArrow(_search(block, k), "query long, doc_id long, score long"), "pair-found"))
        discard(lists)
    if not results:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    found = results[0]
    for other in results[1:]:
        found = found.unionByName(other)
    best = Window.partitionBy("query").orderBy(F.desc("score"), "doc_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    named = ranked.join(queries.select("query", "item_id"), "query")
    return named.select("item_id", "rank", F.when(F.col("doc_id") != LAST_ID, F.col("doc_id")).alias("doc_id"), "score")
