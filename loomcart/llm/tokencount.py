"""Token counts with a cache of digests.

A count is stored under the digest of the content and the digest of the tokenizer's file and library version. Only
distinct contents without a stored count are encoded; their counts are appended to the cache.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import sentencepiece
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcart.llm.common import text_chunks
from loomcart.session import ship_package


def tokenizer_version(model: str) -> str:
    """Digest of the model file and the library that reads it."""
    with open(model, "rb") as file:
        return hashlib.sha256(file.read() + sentencepiece.__version__.encode()).hexdigest()


def _encoder(model: str):
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        processor = sentencepiece.SentencePieceProcessor(model_file=model)
        for table in text_chunks(batches, "text", 2 << 20):
            texts = table["text"].to_pylist()
            counts = [len(ids) for ids in processor.encode(texts, num_threads=1)] if texts else []
            yield from pa.table({"digest": table["digest"], "n_tokens": pa.array(counts, pa.int64())}).to_batches()

    return count


def read_cache(docs: DataFrame, cache: str, version: str) -> DataFrame:
    """Stored counts of one tokenizer version, one row for each digest."""
    spark = docs.sparkSession
    schema = "digest binary, n_tokens long"
    try:
        stored = spark.read.schema(schema).parquet(f"{cache}/version={version}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = spark.createDataFrame([], schema)
    return stored.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(
    docs: DataFrame, cache: str, model: str, limit: int = 4096, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every input row; new counts are appended to the folder ``cache``.

    Content is normalised only so far that null counts as empty, since any more could change the count; whole texts are
    encoded. Repeated rows, equal texts and null ids each keep their row. Columns other than id and text are ignored.
    """
    ship_package(docs.sparkSession)
    version = tokenizer_version(model)
    content = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).select(
        "doc_id", F.unhex(F.sha2("text", 256)).alias("digest"), F.octet_length("text").cast("long").alias("n_bytes"), "text"
    )
    # Rows of one content meet within each task first, so a content that fills the table is one row of each task.
    distinct = content.groupBy("digest").agg(F.first("text").alias("text"))
    missing = distinct.join(read_cache(docs, cache, version), "digest", "left_anti").select("digest", "text")
    counted = missing.mapInArrow(_encoder(model), "digest binary, n_tokens long")
    counted.write.mode("append").parquet(f"{cache}/version={version}")
    counts = read_cache(docs, cache, version)
    return (
        content.select("doc_id", "digest", "n_bytes")
        .join(counts, "digest")
        .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
    )
