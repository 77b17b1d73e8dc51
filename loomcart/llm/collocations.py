"""Collocations: frequent phrases whose parts attract each other, by counting tiles of word pairs.

Words get numbers by falling frequency. A pair (phrase so far, next word) is a cell of a matrix that is cut into square
tiles. Frequent numbers are small, so few tiles hold most cells: those are counted directly into dense arrays, the cells
of all other tiles are sorted and run lengths counted. Frequent pairs are numbered by frequency in turn and meet the next
word, so a phrase grows by one word each round. A round keeps only the places where a phrase may still grow.

Tasks count before anything is shuffled, and cells are dealt by a hash, so a pair that fills a third of the corpus is one
number of each task. The numbers of words and pairs go to the texts by broadcast while their measured size is small; beyond
that the texts' own words or cells travel to the numbers and back, packed by chunk of text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomcart.llm.common import UPPER, Numbers, expand, squeeze, text_chunks
from loomcart.session import discard, materialise, ship_package

CHUNK_BYTES = 8 << 20
#: Side of a tile, how many tiles of a row or column may be dense, and the least share of cells met in a dense one.
TILE, DENSE_TILES, DENSE_SHARE = 256, 64, 0.125
#: Positions of text for each group of cells that is counted together.
BIN_POSITIONS = 1 << 20
#: Distinct words, or cells, that a task adds up before it sends them on.
HELD = 1 << 20
#: Frequent words, or pairs, are broadcast up to this measured size.
BROADCAST_BYTES = 16 << 20
NO_LANGUAGE = "und"
BREAK = -1  # stands between pieces and for what is not frequent
# Line breaks of every kind end a piece, as the marks do: they all become one.
_PIECES = bytes(b + 32 if chr(b) in UPPER else 10 if b in b".,;:!?\n\x0b\x0c\r" else b for b in range(256))


# Words


def _pieces(text: str) -> Iterator[list[bytes]]:
    """The words of every piece; two blanks in a row have an empty word between them."""
    for piece in text.encode().translate(_PIECES).replace(b"\t", b" ").split(b"\n"):
        yield piece.split(b" ")


def _by_language(table: pa.Table) -> dict[str, list[str]]:
    texts: dict[str, list[str]] = {}
    for lang, text in zip(table["lang"].to_pylist(), table["text"].to_pylist()):
        if text:
            texts.setdefault(NO_LANGUAGE if lang is None else lang, []).append(text)
    return texts


def _numbered(texts: list[str], number: Numbers) -> np.ndarray:
    """The words as they are numbered; ``b"\\n"``, which is no word, stands behind every piece."""
    code: list[int] = []
    end = number[b"\n"]
    for text in texts:
        for words in _pieces(text):
            code.extend(map(number.__getitem__, words))
            code.append(end)
    codes = np.array(code, np.int64)
    return codes[codes != number[b""]]


def _word_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``lang, phrase, f``; a word comes once for every ``HELD`` distinct ones of the task."""
    held: dict[str, tuple[Numbers, np.ndarray]] = {}

    def close() -> Iterator[pa.RecordBatch]:
        for lang, (number, counts) in held.items():
            words = [w.decode() for w in number if w not in (b"", b"\n")]
            f = [n for w, n in zip(number, counts.tolist()) if w not in (b"", b"\n")]
            columns = {"lang": pa.array([lang] * len(f), pa.string()), "phrase": pa.array(words, pa.string()), "f": pa.array(f, pa.int64())}
            yield pa.RecordBatch.from_pydict(columns)

    for table in text_chunks(batches, "text", CHUNK_BYTES):
        for lang, texts in _by_language(table).items():
            number, counts = held.get(lang, (Numbers(), np.zeros(0, np.int64)))
            found = np.bincount(_numbered(texts, number), minlength=len(number))
            found[: len(counts)] += counts
            held[lang] = (number, found)
        if sum(len(number) for number, _ in held.values()) >= HELD:
            yield from close()
            held = {}
    yield from close()


def by_frequency(df: DataFrame, order: list[str], label: str) -> DataFrame:
    """``df`` with ``id`` from 0 by falling ``f``, ties by ``order``; sorted in ranges, the driver sees one count for each."""
    ordered = materialise(df.orderBy(F.desc("f"), *order).withColumn("_at", F.monotonically_increasing_id()), label)
    counted = ordered.groupBy(F.shiftright("_at", 33).alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    base = np.cumsum([0] + [r["n"] for r in counted])
    first = F.expr("map(" + ", ".join(f"{r['part']}L, {b}L" for r, b in zip(counted, base)) + ")") if counted else F.lit(None)
    number = F.element_at(first, F.shiftright("_at", 33)) + F.col("_at").bitwiseAND((1 << 33) - 1) if counted else F.lit(0).cast("long")
    return ordered.withColumn("id", number).drop("_at")


# Sequences: for each place the number of the phrase that begins there, and of the word that follows it

_SEQUENCE = pa.schema([("chunk", pa.int64()), ("symbols", pa.binary()), ("follow", pa.binary())])
_SEQUENCE_SQL = "chunk long, symbols binary, follow binary"
Sequence = tuple[np.ndarray, np.ndarray]


def compact(symbols: np.ndarray, follow: np.ndarray) -> Sequence:
    """Only phrases beside another one, since a longer phrase begins with two; one ``BREAK`` stands where some are gone."""
    there = np.concatenate([[False], symbols >= 0, [False]])
    kept = there[1:-1] & (there[:-2] | there[2:])
    ends = ~kept & np.concatenate([[False], kept[:-1]]) if len(kept) else kept
    symbols = np.where(kept, symbols, BREAK)
    return symbols[kept | ends], follow[kept | ends]


def _packed(chunk: int, sequence: Sequence) -> pa.RecordBatch:
    values = [chunk, *[squeeze((a + 1).astype(np.int64)) for a in sequence]]
    return pa.RecordBatch.from_pydict({c: [v] for c, v in zip(_SEQUENCE.names, values)}, schema=_SEQUENCE)


def _opened(row: dict) -> Sequence:
    return expand(row["symbols"], np.int64) - 1, expand(row["follow"], np.int64) - 1


def _of_words(ids: np.ndarray) -> Sequence:
    return compact(ids, np.append(ids[1:], BREAK)[: len(ids)])


def growing(sequence: Sequence) -> np.ndarray:
    """Places where a phrase of one word more may be frequent: both its beginning and its end are phrases."""
    symbols, follow = sequence
    return np.flatnonzero((symbols[:-1] >= 0) & (symbols[1:] >= 0) & (follow[:-1] >= 0))


def grown(sequence: Sequence, cells: np.ndarray, ids: np.ndarray, width: int) -> Sequence:
    """The next round's sequence, from the frequent cells in order and their ids."""
    symbols, follow = sequence
    at = growing(sequence)
    own = symbols[at] * width + follow[at]
    longer = np.full(len(symbols), BREAK, np.int64)
    if len(cells):
        spot = np.minimum(np.searchsorted(cells, own), len(cells) - 1)
        longer[at] = np.where(cells[spot] == own, ids[spot], BREAK)
    return compact(longer, np.append(follow[1:], BREAK)[: len(follow)])


class _Known(dict):
    def __missing__(self, word: bytes) -> int:
        return BREAK


def _sequences_by_broadcast(shared: Broadcast):
    """``shared``: a table of ``lang, phrase, id``."""

    def number(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, _Known] = {}
        for lang, phrase, i in zip(*[shared.value[c].to_pylist() for c in ("lang", "phrase", "id")]):
            known.setdefault(lang, _Known())[phrase.encode()] = i
        empty, task, turn = -2, TaskContext.get().partitionId(), 0
        for table in text_chunks(batches, "text", CHUNK_BYTES):
            code: list[int] = []
            for lang, texts in _by_language(table).items():
                own = known.get(lang, _Known())
                own[b""] = empty
                for text in texts:
                    for words in _pieces(text):
                        code.extend(map(own.__getitem__, words))
                        code.append(BREAK)
            ids = np.array(code, np.int64)
            sequence = _of_words(ids[ids != empty])
            if len(sequence[0]):
                yield _packed(task << 32 | turn, sequence)
            turn += 1

    return number


_CHUNK_SQL = "chunk long, lang string, words array<string>, codes binary"
_CHUNK = pa.schema([("chunk", pa.int64()), ("lang", pa.string()), ("words", pa.list_(pa.string())), ("codes", pa.binary())])


def _chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of a chunk's languages, and its texts as numbers of these words."""
    task, turn = TaskContext.get().partitionId(), 0
    for table in text_chunks(batches, "text", CHUNK_BYTES):
        for lang, texts in _by_language(table).items():
            number = Numbers()
            codes = _numbered(texts, number)
            words = [w for w in number if w not in (b"", b"\n")]
            place = np.full(len(number), BREAK, np.int64)
            place[[number[w] for w in words]] = np.arange(len(words))
            row = (task << 32 | turn, lang, [w.decode() for w in words], squeeze(place[codes].astype(np.int32)))
            turn += 1
            yield pa.RecordBatch.from_pydict({c: [v] for c, v in zip(_CHUNK.names, row)}, schema=_CHUNK)


def _as_sequences(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunk, its codes, the number of its words, and places and ids of the frequent ones -> the chunk's sequence."""
    for batch in batches:
        for i in range(batch.num_rows):
            chunk, codes, size, known = (batch.column(c)[i] for c in ("chunk", "codes", "size", "known"))
            found = np.full(size.as_py() + 1, BREAK, np.int64)  # the last entry is what BREAK points to
            found[known.values.field("place").to_numpy()] = known.values.field("id").to_numpy()
            sequence = _of_words(found[expand(codes.as_py(), np.int32)])
            if len(sequence[0]):
                yield _packed(chunk.as_py(), sequence)


def _sequences(source: DataFrame, many: DataFrame) -> DataFrame:
    """Sequences of the words of ``source`` (``lang, text``), given the frequent ones with their ids."""
    size = many.agg(F.sum(F.octet_length("phrase") + F.octet_length("lang") + 16)).first()[0] or 0
    if size <= BROADCAST_BYTES:
        shared = source.sparkSession.sparkContext.broadcast(many.select("lang", "phrase", "id").toArrow())
        return materialise(source.mapInArrow(_sequences_by_broadcast(shared), _SEQUENCE_SQL), "phrase-sequences")
    chunks = materialise(source.mapInArrow(_chunks, _CHUNK_SQL), "phrase-chunks")
    met = chunks.select("chunk", "lang", F.posexplode("words").alias("place", "phrase"))
    known = met.join(many.select("lang", "phrase", "id"), ["lang", "phrase"])
    known = known.groupBy("chunk").agg(F.collect_list(F.struct("place", "id")).alias("known"))  # a chunk's words
    coded = chunks.select("chunk", "codes", F.size("words").alias("size")).join(known, "chunk")
    sequences = materialise(coded.mapInArrow(_as_sequences, _SEQUENCE_SQL), "phrase-sequences")
    discard(chunks)
    return sequences


# Cells of pairs


def cells_of(left: np.ndarray, right: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct cells ``left * width + right`` and how often each occurs."""
    a, b = left // TILE, right // TILE
    near = (a < DENSE_TILES) & (b < DENSE_TILES)
    tile = (a[near] * DENSE_TILES + b[near]).astype(np.int64)
    filled = np.bincount(tile, minlength=DENSE_TILES * DENSE_TILES)
    dense = filled >= DENSE_SHARE * TILE * TILE
    direct = dense[tile]
    x, y, tile = left[near][direct], right[near][direct], tile[direct]
    order = np.argsort(tile.astype(np.uint16), kind="stable")
    x, y = x[order], y[order]
    ends = np.cumsum(filled[dense])
    out = []
    for number, size, end in zip(np.flatnonzero(dense), filled[dense], ends):
        i, j = int(number) // DENSE_TILES * TILE, int(number) % DENSE_TILES * TILE
        own = slice(end - size, end)
        count = np.bincount((x[own] - i) * TILE + (y[own] - j), minlength=TILE * TILE)
        cell = np.flatnonzero(count)
        out.append(((i + cell // TILE) * width + j + cell % TILE, count[cell]))
    rest = np.ones(len(left), bool)
    rest[np.flatnonzero(near)[direct]] = False
    out.append(np.unique(left[rest] * width + right[rest], return_counts=True))
    return np.concatenate([c for c, _ in out]), np.concatenate([n for _, n in out])


def bin_of(cells: np.ndarray, bins: int) -> np.ndarray:
    mixed = cells.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(33)) % np.uint64(bins)).astype(np.int64)


def _dealt(cells: np.ndarray, others: np.ndarray, bins: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(bin, its cells in order, their values)"""
    order = np.lexsort((cells, where := bin_of(cells, bins)))
    cells, others, where = cells[order], others[order], where[order]
    starts = np.flatnonzero(np.append(True, where[1:] != where[:-1])[: len(where)])
    for a, b in zip(starts, [*starts[1:], len(where)]):
        yield int(where[a]), cells[a:b], others[a:b]


_CELLS = pa.schema([("bin", pa.int64()), ("chunk", pa.int64()), ("cells", pa.binary()), ("values", pa.binary())])
_CELLS_SQL = "bin long, chunk long, cells binary, values binary"


def _rows_of(dealt: Iterable[tuple[int, np.ndarray, np.ndarray]], chunk: int) -> Iterator[pa.RecordBatch]:
    rows = [(b, chunk, squeeze(c), squeeze(v.astype(np.int64))) for b, c, v in dealt]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows), _CELLS)], schema=_CELLS)


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct cells in order with the sums of their counts."""
    cells, counts = (np.concatenate(c) for c in zip(*parts))
    order = np.argsort(cells, kind="stable")
    cells, counts = cells[order], counts[order]
    starts = np.flatnonzero(np.append(True, cells[1:] != cells[:-1])[: len(cells)])
    return cells[starts], np.add.reduceat(counts, starts) if len(starts) else counts


def _count_cells(width: int, bins: int):
    """Sequences -> counted cells, packed by bin; what a task holds is added up first."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for row in batch.to_pylist():
                sequence = _opened(row)
                at = growing(sequence)
                if len(at):
                    held.append(cells_of(sequence[0][at], sequence[1][at], width))
                if sum(len(c) for c, _ in held) >= HELD:
                    held = [_added(held)]
                    if len(held[0][0]) >= HELD:
                        yield from _rows_of(_dealt(*held[0], bins), 0)
                        held = []
        if held:
            yield from _rows_of(_dealt(*_added(held), bins), 0)

    return count


def _merge(width: int, least: int):
    """Rows of cells sorted by bin -> frequent pairs."""

    def frequent(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        cells, counts = _added(parts)
        cells, counts = cells[counts >= least], counts[counts >= least]
        return pa.RecordBatch.from_pydict({"left": cells // width, "word": cells % width, "f": counts})

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for batch in batches:
            for number, cells, counts in zip(*(batch.column(c).to_pylist() for c in ("bin", "cells", "values"))):
                if number != now and held:
                    yield frequent(held)
                    held = []
                now = number
                held.append((expand(cells, np.int64), expand(counts, np.int64)))
        if held:
            yield frequent(held)

    return merge


# The next round's sequences


def _grow_by_broadcast(shared: Broadcast, width: int):
    """``shared``: the frequent cells in order, and their ids."""

    def grow(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, ids = shared.value
        for batch in batches:
            for row in batch.to_pylist():
                longer = grown(_opened(row), cells, ids, width)
                if len(longer[0]):
                    yield _packed(row["chunk"], longer)

    return grow


def _own_cells(width: int, bins: int):
    """The distinct cells of every chunk, packed by bin."""

    def own(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sequence = _opened(row)
                at = growing(sequence)
                cells = np.unique(sequence[0][at] * width + sequence[1][at])
                yield from _rows_of(_dealt(cells, np.zeros(len(cells), np.int64), bins), row["chunk"])

    return own


def _pack_frequent(bins: int, width: int):
    """Frequent pairs with their ids -> rows of cells that stand before the chunks' own (chunk -1)."""

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, word, ids = (batch.column(i).to_numpy() for i in range(3))
            yield from _rows_of(_dealt(left * width + word, ids, bins), -1)

    return pack


def _match(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bin and chunk: the frequent cells come first, each chunk's cells among them get their ids."""
    now, parts, cells, ids = None, [], None, None
    for batch in batches:
        for number, chunk, packed, values in zip(*(batch.column(c).to_pylist() for c in _CELLS.names)):
            if number != now:
                now, parts, cells = number, [], None
            own = expand(packed, np.int64)
            if chunk < 0:
                parts.append((own, expand(values, np.int64)))
                continue
            if not parts:
                continue
            if cells is None:
                cells, ids = (np.concatenate(c) for c in zip(*parts))
                order = np.argsort(cells)
                cells, ids = cells[order], ids[order]
            spot = np.minimum(np.searchsorted(cells, own), len(cells) - 1)
            same = cells[spot] == own
            if same.any():
                yield pa.RecordBatch.from_pydict({"chunk": [chunk], "cells": [squeeze(own[same])], "ids": [squeeze(ids[spot[same]])]})


def _grow(width: int):
    """Chunks with the ids of their frequent cells -> the next round's."""

    def grow(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                cells = np.concatenate([expand(f["cells"], np.int64) for f in row["found"]])
                ids = np.concatenate([expand(f["ids"], np.int64) for f in row["found"]])
                order = np.argsort(cells)
                longer = grown(_opened(row), cells[order], ids[order], width)
                if len(longer[0]):
                    yield _packed(row["chunk"], longer)

    return grow


def _next_sequences(sequences: DataFrame, pairs: DataFrame, number: int, width: int, bins: int) -> DataFrame:
    """``sequences`` with the ``number`` frequent ``pairs`` as symbols."""
    if 16 * number <= BROADCAST_BYTES:
        table = pairs.select("left", "word", "id").toArrow()
        cells = table["left"].to_numpy() * width + table["word"].to_numpy()
        order = np.argsort(cells)
        shared = sequences.sparkSession.sparkContext.broadcast((cells[order], table["id"].to_numpy()[order]))
        return materialise(sequences.mapInArrow(_grow_by_broadcast(shared, width), _SEQUENCE_SQL), "phrase-sequences")
    packed = pairs.select("left", "word", "id").mapInArrow(_pack_frequent(bins, width), _CELLS_SQL)
    matched = (
        packed.unionByName(sequences.mapInArrow(_own_cells(width, bins), _CELLS_SQL)).repartition("bin").sortWithinPartitions("bin", "chunk")
        .mapInArrow(_match, "chunk long, cells binary, ids binary")
    )
    found = matched.groupBy("chunk").agg(F.collect_list(F.struct("cells", "ids")).alias("found"))
    return materialise(sequences.join(found, "chunk").mapInArrow(_grow(width), _SEQUENCE_SQL), "phrase-sequences")


# Phrases


def _phrases(pairs: DataFrame, before: DataFrame, first: bool) -> DataFrame:
    """Frequent pairs as phrases: words, counts of all their beginnings and ends, and the id of the phrase without its
    first word. ``before`` has the phrases of one word less."""
    left = before.select(
        F.col("id").alias("left"), "lang", F.col("phrase").alias("begin"), F.col("suffix").alias("inner"), F.col("f").alias("f_left"), F.col("heads")
    )
    joined = pairs.join(left, "left").withColumn("heads", F.concat("heads", F.array("f_left")))
    if first:  # the rest of a pair is a word
        rest = before.select(F.col("id").alias("word"), F.col("id").alias("suffix"), F.col("f").alias("f_rest"), F.col("tails"), F.col("phrase").alias("end"))
        joined = joined.join(rest, "word")
    else:
        rest = before.select(F.col("left").alias("inner"), "word", F.col("id").alias("suffix"), F.col("f").alias("f_rest"), F.col("tails"), F.col("last").alias("end"))
        joined = joined.join(rest, ["inner", "word"])
    return joined.select(
        "id", "left", "word", "suffix", "lang", "f", "heads", F.concat(F.array("f_rest"), "tails").alias("tails"),
        F.concat_ws(" ", "begin", "end").alias("phrase"), F.col("end").alias("last"),
    )


def _scored(phrases: DataFrame, totals: DataFrame, length: int) -> DataFrame:
    """The cut with the lowest score, by decimals of 38 digits: exact for corpora of up to 10^16 words."""

    def number(c: Column) -> Column:
        return c.cast("decimal(38,0)")

    def cut(k: int) -> Column:
        l, r = F.col("heads")[k - 1], F.col("tails")[k - 1]
        above = (number(F.lit(1000)) * F.col("f").cast("decimal(16,0)") * F.col("n").cast("decimal(16,0)")).cast("decimal(38,0)")
        below = (l.cast("decimal(16,0)") * r.cast("decimal(16,0)")).cast("decimal(38,0)")
        return F.struct(F.call_function("div", above, below).alias("score"), F.lit(k).alias("k"), l.alias("l"), r.alias("r"))

    cuts = F.array_min(F.array(*[cut(k) for k in range(1, length)]))
    return phrases.join(F.broadcast(totals), "lang").withColumn("cut", cuts).select(
        "lang", "phrase", F.col("f").alias("a"), F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score")
    )


def collocations(
    docs: DataFrame, least: int = 100, longest: int = 5, top: int = 2000, inside_percent: int = 100, lang: str = "lang", text: str = "text"
) -> DataFrame:
    """The ``top`` phrases of 2 to ``longest`` words of each language: ``lang, rank, phrase, a, l, r, n, score``.

    A-Z count as a-z. Texts are cut at ``.,;:!?`` and line breaks, pieces at blanks and tabs; phrases do not cross pieces.
    ``a`` counts a phrase, ``l`` and ``r`` the two parts of its weakest cut, ``n`` all words of the language, and ``score``
    is 1000 a n / (l r) rounded down; of equal cuts the first. Phrases met fewer than ``least`` times are no candidates;
    candidates inside a longer one that reaches ``inside_percent`` of their count are dropped. Order: score and count
    falling, then phrase by bytes. Null texts are empty, a null language is ``und``; every row counts, repeated or not;
    other columns are ignored; an empty table gives no row.
    """
    ship_package(docs.sparkSession)
    source = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    counted = source.mapInArrow(_word_counts, "lang string, phrase string, f long")
    words = materialise(counted.groupBy("lang", "phrase").agg(F.sum("f").alias("f")), "phrase-words", compression="zstd")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))  # a row for each language
    many = by_frequency(words.where(F.col("f") >= least), ["lang", "phrase"], "phrase-vocabulary")
    width = max(many.count(), 1)
    if width > 2**31:
        raise OverflowError("more frequent words than a pair's number can hold")
    bins = 1 + int(words.agg(F.sum("f")).first()[0] or 0) // BIN_POSITIONS
    sequences = _sequences(source, many)

    level = many.select(
        "id", "lang", "f", "phrase", F.col("id").alias("suffix"), F.lit(None).cast("long").alias("left"), F.lit(None).cast("long").alias("word"),
        F.array().cast("array<long>").alias("heads"), F.array().cast("array<long>").alias("tails"), F.col("phrase").alias("last"),
    )
    levels: list[DataFrame] = []
    for length in range(1, longest):
        cells = sequences.mapInArrow(_count_cells(width, bins), _CELLS_SQL)
        pairs = cells.repartition("bin").sortWithinPartitions("bin").mapInArrow(_merge(width, least), "left long, word long, f long")
        pairs = by_frequency(pairs, ["left", "word"], "phrase-pairs")
        phrases = materialise(_phrases(pairs, level, length == 1), f"phrases-{length + 1}")
        levels.append(phrases)
        number = phrases.count()
        if not number or length + 1 == longest:
            break
        if number * width >= 2**63:
            raise OverflowError("more frequent phrases than a cell's number can hold")
        after = _next_sequences(sequences, phrases, number, width, bins)
        discard(sequences)
        sequences, level = after, phrases

    out = None
    for i, phrases in enumerate(levels):
        if i + 1 < len(levels):  # what the phrases of one word more contain; longer ones cannot be more frequent than those
            longer = levels[i + 1]
            inside = longer.select(F.explode(F.array("left", "suffix")).alias("id"), F.col("f").alias("f_longer"))
            inside = inside.groupBy("id").agg(F.max("f_longer").alias("f_longer"))
            held = F.coalesce(100 * F.col("f_longer") >= inside_percent * F.col("f"), F.lit(False))
            phrases = phrases.join(inside, "id", "left").where(~held)
        scored = _scored(phrases, totals, i + 2)
        out = scored if out is None else out.unionByName(scored)
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = out.withColumn("rank", F.row_number().over(best).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
