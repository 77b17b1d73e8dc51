"""Exact top-k search by BM25 over sharded inverted indexes with block-max pruning.

Documents are indexed in shards, where similar documents lie side by side. A block is a run of documents; for every term
it has a largest contribution. As in block-max WAND, a block is scored for a query only if the sum of its terms' block
maxima reaches the k-th best score found so far, so no document that belongs to the result can be missed. Queries are
scored in batches: frequent terms are a dense matrix of document contributions and one of block maxima, all others are
posting lists. Contributions use the statistics of the whole table, so the shards' lists merge exactly.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomcart.llm.common import LAST_ID, UPPER, text_chunks
from loomcart.session import materialise, ship_package

K1, B = 1.2, 0.75
SHARD_BYTES = 16 << 20
CHUNK_BYTES = 4 << 20
QUERY_BLOCK = 4096
BLOCK = 64
#: Neighbouring blocks that are scored at once.
GROUP = 8
#: Query blocks of at most this measured size are broadcast; of larger ones every task reads its part from their stored table.
BROADCAST_BYTES = 64 * 2**20
#: Shards that one task searches in turn, its best scores so far pruning the next, and query blocks it remembers.
SHARDS_PER_TASK, HELD = 6, 64
#: Terms of a shard kept as a dense matrix; the others are posting lists.
DENSE = 256
BATCH = 256
#: Queries of a batch whose posting lists are added up at once, few enough for a processor's cache.
POSTED = 8
#: Scores are compared and returned at this many decimals.
DIGITS = 6
_WORDS = bytes(b + 32 if chr(b) in UPPER else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms_of(text: bytes) -> np.ndarray:
    """64-bit hashes of the words of a text: runs of letters, digits and non-ASCII bytes, A-Z in lower case."""
    words = text.translate(_WORDS).split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _squeeze(values: np.ndarray) -> bytes:
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize)
    return zstandard.compress(planes.T.tobytes(), 1)


def _expand(blob: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(blob), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).reshape(-1).view(kind)


# Index

_INDEX_SQL = "shard string, docs long, tokens long, ids binary, lengths binary, terms binary, counts binary, places binary, freqs binary"
_INDEX = pa.schema(
    [("shard", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64())]
    + [(c, pa.binary()) for c in ("ids", "lengths", "terms", "counts", "places", "freqs")]
)


def _postings(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lengths, and term, document and frequency of every posting; last the most frequent term of each document."""
    parts = [np.sort(terms_of((t or "").encode())) for t in texts]
    lengths = np.array([len(p) for p in parts], np.int64)
    term = np.concatenate(parts) if parts else np.empty(0, np.uint64)
    doc = np.repeat(np.arange(len(parts)), lengths)
    at = np.flatnonzero(np.append(True, (term[1:] != term[:-1]) | (doc[1:] != doc[:-1]))[: len(term)])
    freq = np.diff(np.append(at, len(term)))
    term, doc = term[at], doc[at]
    top = np.zeros(len(parts), np.uint64)
    if len(term):
        first = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
        most = np.repeat(np.maximum.reduceat(freq, first), np.diff(np.append(first, len(doc))))
        top[doc[freq == most]] = term[freq == most]
    return lengths, term, doc, freq.astype(np.uint32), top


def _build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    size = 0
    for table in text_chunks(batches, "text", CHUNK_BYTES):
        held.append((table["doc_id"].to_pylist(), *_postings(table["text"].to_pylist())))
        size += table["text"].nbytes
        if size >= SHARD_BYTES:
            yield _shard(held)
            held, size = [], 0
    if held:
        yield _shard(held)


def _shard(held: list[tuple]) -> pa.RecordBatch:
    ids = np.array([LAST_ID if i is None else i for part in held for i in part[0]], np.int64)
    lengths, terms = np.concatenate([p[1] for p in held]), np.concatenate([p[2] for p in held])
    first = np.cumsum([0] + [len(p[0]) for p in held])
    docs, freqs = np.concatenate([p[3] + f for p, f in zip(held, first)]), np.concatenate([p[4] for p in held])
    order = np.lexsort((lengths, np.concatenate([p[5] for p in held])))  # similar documents side by side
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    docs = place[docs]
    by = np.lexsort((docs, terms))
    terms, docs, freqs = terms[by], docs[by].astype(np.uint32), freqs[by]
    at = np.flatnonzero(np.append(True, terms[1:] != terms[:-1])[: len(terms)])
    counts = np.diff(np.append(at, len(terms))).astype(np.uint32)
    return pa.RecordBatch.from_pydict(
        {
            "shard": [uuid.uuid4().hex],
            "docs": [len(ids)],
            "tokens": [int(lengths.sum())],
            "ids": [_squeeze(ids[order])],
            "lengths": [_squeeze(lengths[order])],
            "terms": [_squeeze(terms[at])],
            "counts": [_squeeze(counts)],
            "places": [_squeeze(docs)],
            "freqs": [_squeeze(freqs)],
        },
        schema=_INDEX,
    )


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Index shards of a table, one row each. Every row is indexed; null texts have no terms."""
    ship_package(docs.sparkSession)
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return source.mapInArrow(_build, _INDEX_SQL)


def _frequencies(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            terms, counts = _expand(row["terms"], np.uint64), _expand(row["counts"], np.uint32)
            yield pa.RecordBatch.from_pydict({"term": terms.view(np.int64), "df": counts.astype(np.int64)})


# Queries


def _query_terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in text_chunks(batches, "text", CHUNK_BYTES):
        for query, digest, text in zip(*[table[c].to_pylist() for c in ("query_id", "digest", "text")]):
            terms = np.unique(terms_of(text.encode())).view(np.int64)
            yield pa.RecordBatch.from_pydict(
                {"query_id": np.full(len(terms), query), "digest": np.full(len(terms), digest), "term": terms}
            )


_BLOCKS = pa.schema([("block", pa.int64())] + [(c, pa.binary()) for c in ("queries", "digests", "numbers", "terms", "weights")])
_BLOCKS_SQL = "block long, queries binary, digests binary, numbers binary, terms binary, weights binary"


def _pack_queries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each block of queries, from rows sorted by block and query."""
    held: list[pa.RecordBatch] = []

    def close() -> pa.RecordBatch:
        block, query, digest, term, weight = (np.concatenate([h.column(i).to_numpy() for h in held]) for i in range(5))
        at = np.flatnonzero(np.append(True, (query[1:] != query[:-1]) | (digest[1:] != digest[:-1])))
        number = np.diff(np.append(at, len(query)))
        values = (query[at], digest[at], number.astype(np.int64), term, weight)
        return pa.RecordBatch.from_pydict(
            {"block": [int(block[0])]} | {n: [_squeeze(v)] for n, v in zip(_BLOCKS.names[1:], values)}, schema=_BLOCKS
        )

    for batch in batches:
        blocks = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(blocks[1:] != blocks[:-1]) + 1).tolist(), len(blocks)]
        for a, b in zip(cuts, cuts[1:]):
            if a < b:
                if held and held[0].column(0)[0].as_py() != blocks[a]:
                    yield close()
                    held = []
                held.append(batch.slice(a, b - a))
    if held:
        yield close()


@dataclass
class Shard:
    """An opened index shard: contributions of the dense terms by document and by block, and posting lists."""

    ids: np.ndarray
    terms: np.ndarray
    first: np.ndarray
    places: np.ndarray
    impacts: np.ndarray
    dense: np.ndarray  # rows of ``terms`` that are dense
    matrix: np.ndarray  # documents, padded to whole blocks, by dense terms
    maxima: np.ndarray  # blocks by dense terms


def open_shard(row: dict, average: float) -> Shard:
    ids, lengths = _expand(row["ids"], np.int64), _expand(row["lengths"], np.int64)
    terms, counts = _expand(row["terms"], np.uint64), _expand(row["counts"], np.uint32).astype(np.int64)
    places, freqs = _expand(row["places"], np.uint32).astype(np.int64), _expand(row["freqs"], np.uint32).astype(float)
    first = np.append(0, np.cumsum(counts))
    norm = K1 * (1 - B + B * lengths / average)
    impacts = freqs * (K1 + 1) / (freqs + norm[places])
    blocks = -(-len(ids) // BLOCK)
    dense = np.sort(np.argsort(-counts, kind="stable")[:DENSE])
    matrix = np.zeros((blocks * BLOCK, len(dense)))
    for column, t in enumerate(dense):
        own = slice(first[t], first[t + 1])
        matrix[places[own], column] = impacts[own]
    maxima = matrix.reshape(blocks, BLOCK, len(dense)).max(axis=1)
    return Shard(ids, terms, first, places, impacts, dense, matrix, maxima)


Hits = tuple[np.ndarray, np.ndarray, np.ndarray]  # query number, document, score; sorted by all three, best first


def best_of(row: np.ndarray, ids: np.ndarray, value: np.ndarray, k: int) -> Hits:
    """The best k hits of each query."""
    order = np.lexsort((ids, -value, row))
    row, ids, value = row[order], ids[order], value[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    kept = place < k
    return row[kept], ids[kept], value[kept]


def search_batch(shard: Shard, queries: list[tuple[np.ndarray, np.ndarray]], k: int, held: Hits) -> Hits:
    """The best k for each query (terms, weights) among the shard's documents and the hits held so far."""
    width, blocks = len(shard.matrix), len(shard.maxima)
    slack = 10.0**-DIGITS
    asked, place = np.unique(np.concatenate([t for t, _ in queries]), return_inverse=True)
    at = np.minimum(np.searchsorted(shard.terms, asked), len(shard.terms) - 1)
    known = (shard.terms[at] == asked)[place]
    at = at[place][known]
    of = np.repeat(np.arange(len(queries)), [len(t) for t, _ in queries])[known]
    weight = np.concatenate([w for _, w in queries])[known]

    column = np.full(len(shard.terms), -1)
    column[shard.dense] = np.arange(len(shard.dense))
    full = column[at] >= 0
    weights = np.zeros((len(queries), len(shard.dense)))
    weights[of[full], column[at[full]]] = weight[full]
    rare = at[~full]
    number, rare_of, rare_weight = shard.first[rare + 1] - shard.first[rare], of[~full], weight[~full]
    # What posting lists give is known for every document; frequent terms are added block by block.
    scores = np.empty((len(queries), width))
    for begin in range(0, len(queries), POSTED):
        end = min(begin + POSTED, len(queries))
        own = slice(*np.searchsorted(rare_of, (begin, end)))
        n = number[own]
        post = np.repeat(shard.first[rare[own]] - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
        cells = np.repeat((rare_of[own] - begin) * width, n) + shard.places[post]
        sums = np.bincount(cells, np.repeat(rare_weight[own], n) * shard.impacts[post], (end - begin) * width)
        scores[begin:end] = sums.reshape(end - begin, width)
    bound = weights @ shard.maxima.T + scores.reshape(len(queries), blocks, BLOCK).max(axis=2)

    scored = np.zeros((len(queries), blocks), bool)
    best = np.zeros((len(queries), blocks))  # best score of every scored block
    least = np.full(len(queries), slack)
    found = np.bincount(held[0], minlength=len(queries))
    full_lists = np.flatnonzero(found == k)
    least[full_lists] = held[2][np.cumsum(found)[full_lists] - 1]  # the last of k held hits

    def score(which: np.ndarray, first: int, last: int) -> None:
        """Adds the frequent terms of the blocks from ``first`` to before ``last`` for queries that have none of them."""
        own = slice(first * BLOCK, last * BLOCK)
        scores[which, own] += weights[which] @ shard.matrix[own].T
        best[which, first:last] = scores[which, own].reshape(len(which), last - first, BLOCK).max(axis=2)
        scored[which, first:last] = True

    def raise_least(values: np.ndarray) -> None:
        """``values``: for every query the scores of different documents."""
        if values.shape[1] >= k:
            np.maximum(least, np.partition(values, values.shape[1] - k, axis=1)[:, values.shape[1] - k], out=least)

    top = np.argsort(-bound, axis=1)[:, :2]
    for block in np.unique(top):
        score(np.flatnonzero((top == block).any(axis=1)), block, block + 1)
    places = (top[:, :, None] * BLOCK + np.arange(BLOCK)).reshape(len(queries), -1)
    raise_least(np.take_along_axis(scores, places, axis=1))
    groups = [(g, min(g + GROUP, blocks)) for g in range(0, blocks, GROUP)]
    for turn, (first, last) in enumerate(sorted(groups, key=lambda g: -bound[:, g[0] : g[1]].max())):
        wanted = (bound[:, first:last] >= least[:, None] - slack) & ~scored[:, first:last]
        fresh = wanted.any(axis=1) & ~scored[:, first:last].any(axis=1)
        score(np.flatnonzero(fresh), first, last)
        for block in np.flatnonzero(wanted[~fresh].any(axis=0)):
            score(np.flatnonzero(wanted[:, block] & ~fresh), first + block, first + block + 1)
        if turn % 4 == 3:
            raise_least(best)
    raise_least(best)
    width = len(shard.ids)
    near = np.repeat(scored, BLOCK, axis=1)[:, :width] & (scores[:, :width] >= least[:, None] - slack)
    row, doc = np.nonzero(near)
    value = np.round(scores[row, doc], DIGITS)
    row, ids, value = row[value > 0], shard.ids[doc[value > 0]], value[value > 0]
    return best_of(*[np.concatenate(pair) for pair in zip(held, (row, ids, value))], k)


def _search(average: float, k: int, shared: Broadcast | None):
    """``shared`` holds the query blocks that every shard meets; without it each row brings its own."""
    schema = pa.schema([("query_id", pa.int64()), ("digest", pa.int64()), ("doc_id", pa.int64()), ("score", pa.float64())])

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray, list[Hits]]] = {}  # of the task's shards so far, by query block
        shard, opened = None, ""

        def give(block: int) -> pa.RecordBatch:
            queries, digests, hits = held.pop(block)
            rows = [np.concatenate([h[0] + i * BATCH for i, h in enumerate(hits)]), *[np.concatenate([h[j] for h in hits]) for j in (1, 2)]]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in (queries[rows[0]], digests[rows[0]], rows[1], rows[2])], schema=schema)

        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(j)[i].as_py() for j, name in enumerate(batch.schema.names)}
                if row["shard"] != opened:  # the rows of a shard follow each other
                    shard, opened = open_shard(row, average), row["shard"]
                if not len(shard.terms):
                    continue
                for asked in shared.value if shared else [row]:
                    ids, digests, numbers = (_expand(asked[c], np.int64) for c in ("queries", "digests", "numbers"))
                    terms, weights = _expand(asked["query_terms"], np.int64).view(np.uint64), _expand(asked["weights"], np.float64)
                    first = np.append(0, np.cumsum(numbers))
                    none = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
                    block = asked["block"]
                    if block not in held:
                        if len(held) >= HELD:
                            yield give(next(iter(held)))
                        held[block] = (ids, digests, [none] * -(-len(ids) // BATCH))
                    hits = held[block][2]
                    for n, begin in enumerate(range(0, len(ids), BATCH)):
                        own = range(begin, min(begin + BATCH, len(ids)))
                        batch_of = [(terms[first[q] : first[q + 1]], weights[first[q] : first[q + 1]]) for q in own]
                        hits[n] = search_batch(shard, batch_of, k, hits[n])
        for block in list(held):
            yield give(block)

    return search


def top_k(
    docs: DataFrame,
    queries: Column,
    k: int = 10,
    doc_id: str = "doc_id",
    text: str = "text",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The best ``k`` documents for every row of ``docs`` for which ``queries`` holds, its whole text being the query.

    BM25 over distinct query words, with document frequencies, number of rows and mean length of the whole table. Result:
    ``query_id, rank, doc_id, score``, scores rounded to 6 decimals, equal scores by document id (null last). A query may
    find itself; documents that share no word with it are never listed. A null condition is no query; queries without
    words give no row; rows that repeat a query's id and text are one query. Extra columns are ignored; an empty table
    gives an empty result. Terms are 64-bit hashes of words.
    """
    index = materialise(build_index(docs, doc_id, text), "index")
    rows, tokens, shards = index.agg(F.sum("docs"), F.sum("tokens"), F.count("*")).first()
    asked = docs.where(queries).select(
        F.col(doc_id).cast("long").alias("query_id"), F.xxhash64(text).alias("digest"), F.col(text).alias("text")
    ).where(F.col("query_id").isNotNull() & F.col("text").isNotNull())
    words = materialise(asked.mapInArrow(_query_terms, "query_id long, digest long, term long"), "query-terms").distinct()
    number = words.select("query_id", "digest").distinct().count()
    blocks = 1 + number // QUERY_BLOCK

    spread = index.select("terms", "counts").mapInArrow(_frequencies, "term long, df long")
    df = spread.join(words.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    total = float(rows or 0)
    weight = F.log1p((F.lit(total) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighted = words.join(df, "term").select(
        F.pmod(F.xxhash64("query_id", "digest"), F.lit(blocks)).cast("long").alias("block"), "query_id", "digest", "term", weight.alias("weight")
    )
    packed = (
        weighted.repartition("block").sortWithinPartitions("block", "query_id", "digest", "term")
        .mapInArrow(_pack_queries, _BLOCKS_SQL).withColumnRenamed("terms", "query_terms")
    )
    packed = materialise(packed, "query-blocks")
    # The stated queries meet every shard, in blocks.
    few = index.drop("docs", "tokens").coalesce(max(1, -(-int(shards) // SHARDS_PER_TASK)))
    size = packed.agg(F.sum(sum(F.length(c) for c in packed.columns[1:]))).first()[0] or 0
    if size <= broadcast_bytes:
        shared = docs.sparkSession.sparkContext.broadcast([r.asDict() for r in packed.collect()])
        cells = few
    else:
        # A task is some shards by some blocks, both read from where they are stored: neither is copied for the other.
        shared = None
        cells = few.hint("shuffle_replicate_nl").crossJoin(packed)
    average = max(float(tokens or 0) / max(total, 1.0), 1e-9)
    found = cells.mapInArrow(_search(average, k, shared), "query_id long, digest long, doc_id long, score double")

    best = Window.partitionBy("query_id", "digest").orderBy(F.desc("score"), "doc_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select(
        "query_id", F.col("rank").cast("long").alias("rank"), F.when(F.col("doc_id") != LAST_ID, F.col("doc_id")).alias("doc_id"), "score"
    )
