"""Language identification by compression.

Each language has a zstandard raw-content dictionary of its own text, in lower case. A text is cut into blocks, every
block is compressed with every dictionary, and the language with the smallest total wins. Where the two best totals are
close, or the best one is close to the total without a dictionary, the prediction is marked as rejected: the text is of
several languages, of one that was not learned, or of none.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomcart.llm.common import text_chunks
from loomcart.session import ship_package

#: Bounds of the labelled sample: bytes of a language's dictionary, which holds whole texts, and of the longest text that
#: is drawn for it.
DICTIONARY_BYTES = 128 * 1024
LONGEST_SAMPLED = 4096
BLOCK_BYTES = 4096
LEVEL = 12
#: Bytes of difference that make one language e times as likely as another in the score.
SCALE = 4.0
#: The winner must be smaller than the second, and than the text without a dictionary, by this share of its bytes and by
#: so many bytes at least. Set on labelled rows that are not held out, of which 0.6 % are rejected, half of them of fewer
#: than 32 bytes.
MARGIN, MIN_MARGIN = 0.02, 2
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")


def held_out(doc_id: str) -> Column:
    """Whether a document is kept from learning; a null id is neither held out nor learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def prepare(text: str) -> bytes:
    """Lower case behind one blank, so that a first word is like any other."""
    return b" " + text.lower().encode()


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, bytes]:
    """Raw-content dictionaries by language, from a bounded sample of whole texts.

    Of each language the distinct texts of at most ``LONGEST_SAMPLED`` bytes are taken by rising hash, as many as fit into
    ``DICTIONARY_BYTES``. Rows without language or text are left out. An empty table gives no dictionary.
    """
    known = labelled.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")).where(
        F.col("lang").isNotNull() & (F.length("text") > 0)
    )
    drawn = known.where(F.octet_length("text") <= LONGEST_SAMPLED).select(
        "lang", F.xxhash64("text").alias("h"), (F.octet_length("text") + 2).cast("long").alias("bytes"), "text"
    )
    # Hashes small enough to hold about four times the sample go on, so that no task meets a whole language.
    sizes_of = drawn.groupBy("lang").agg(F.sum("bytes").alias("all_bytes"))
    place = F.col("h") / 2.0**64 + 0.5
    small = drawn.join(F.broadcast(sizes_of), "lang").where(place * F.col("all_bytes") < 4 * (DICTIONARY_BYTES + LONGEST_SAMPLED))
    so_far = Window.partitionBy("lang").orderBy("h").rowsBetween(Window.unboundedPreceding, 0)
    first = (
        small.groupBy("lang", "h").agg(F.max("bytes").alias("bytes"))
        .withColumn("end", F.sum("bytes").over(so_far))
        .where(F.col("end") <= DICTIONARY_BYTES)
        .select("lang", "h", "end")
    )
    rows = (
        small.join(F.broadcast(first), ["lang", "h"])  # rows of DICTIONARY_BYTES for each language
        .groupBy("lang", "end")
        .agg(F.min("text").alias("part"))
        .orderBy("lang", "end")
        .collect()
    )
    found: dict[str, bytearray] = {}
    for row in rows:
        found.setdefault(row["lang"], bytearray()).extend(prepare(row["part"]) + b"\n")
    return {lang: bytes(content) for lang, content in sorted(found.items())}


def _compressors(dictionaries: dict[str, bytes], level: int) -> list[zstandard.ZstdCompressor]:
    """One for each dictionary, and one without."""
    made = []
    for content in dictionaries.values():
        shared = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        shared.precompute_compress(level=level)
        made.append(
            zstandard.ZstdCompressor(
                level=level, dict_data=shared, write_content_size=False, write_checksum=False, write_dict_id=False
            )
        )
    return [*made, zstandard.ZstdCompressor(level=level, write_content_size=False, write_checksum=False)]


def sizes(text: bytes, compressors: list[zstandard.ZstdCompressor]) -> list[int]:
    """Compressed bytes of the whole text for each compressor."""
    blocks = [text[i : i + BLOCK_BYTES] for i in range(0, len(text), BLOCK_BYTES)]
    return [sum(len(c.compress(b)) for b in blocks) for c in compressors]


def decide(langs: list[str], totals: list[int], plain: int | None = None) -> tuple[str, float, bool]:
    """Language, score and whether the margin is too narrow; equal totals go to the first language by name.

    ``plain`` is the total without a dictionary. One language alone has no second and is taken for every text.
    """
    order = sorted(range(len(langs)), key=lambda i: (totals[i], langs[i]))
    best = totals[order[0]]
    score = 1.0 / sum(math.exp(-(t - best) / SCALE) for t in totals)
    if len(order) == 1:
        return langs[order[0]], score, False
    second = totals[order[1]] if plain is None else min(totals[order[1]], plain)
    return langs[order[0]], score, second - best < max(MIN_MARGIN, MARGIN * best)


def _judge(texts: list[str | None], langs: list[str], compressors: list) -> list[tuple[str, float, bool]]:
    out = []
    for value in texts:
        if not langs or value is None or not _LETTER.search(value):
            out.append((UNKNOWN, 0.0, True))
        else:
            *totals, plain = sizes(prepare(value), compressors)
            out.append(decide(langs, totals, plain))
    return out


def identify(docs: DataFrame, dictionaries: dict[str, bytes], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Predicted language of every row: ``doc_id, lang_pred, score, rejected``, in input rows.

    Whole texts are read. A null text, a text without a letter, or an empty model gives ``und``, score 0 and a
    rejection. Narrow margins are rejected with the language that is nearest. Repeated rows and null ids are rows like others; other columns are ignored.
    """
    ship_package(docs.sparkSession)
    langs = list(dictionaries)

    def predict(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = _compressors(dictionaries, LEVEL)
        for table in text_chunks(batches, "text", 4 << 20):
            out = _judge(table["text"].to_pylist(), langs, compressors)
            pred, score, rejected = zip(*out) if out else ((), (), ())
            yield from pa.table(
                {
                    "doc_id": table["doc_id"],
                    "lang_pred": pa.array(pred, pa.string()),
                    "score": pa.array(score, pa.float64()),
                    "rejected": pa.array(rejected, pa.bool_()),
                }
            ).to_batches()

    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return source.mapInArrow(predict, "doc_id long, lang_pred string, score double, rejected boolean")


def accepted(docs: DataFrame, dictionaries: dict[str, bytes], text: str = "text") -> DataFrame:
    """The rows, with all their columns, whose language is not rejected; nothing is shuffled."""
    ship_package(docs.sparkSession)
    langs = list(dictionaries)

    def choose(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = _compressors(dictionaries, LEVEL)
        for table in text_chunks(batches, text, 4 << 20):
            judged = _judge(table[text].to_pylist(), langs, compressors)
            yield from table.filter(pa.array([not rejected for _, _, rejected in judged], pa.bool_())).to_batches()

    return docs.mapInArrow(choose, docs.schema)
