"""From raw documents to packed sequences: five stages over the ``documents`` table, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcart.llm import decontaminate, langid, minhash, packing, suffixarray
from loomcart.llm.registry import tokenizer_file
from loomcart.session import discard, materialise

NEAR_PERCENT = 80  # of the five-word shingles of two documents together


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; learned from the labelled ones that are not held out."""
    labelled = docs.where(F.col("doc_id").isNotNull() & ~langid.held_out("doc_id"))
    return langid.accepted(docs, langid.learn(labelled))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of near-duplicates, that with the smallest id; documents without words stay.

    Each row is a document of its own, so repeated or missing ids join no texts. Null ids come last, and among rows of one
    id the first as numbered stays.
    """
    # The copy lies on disk until the application ends, next to what later stages write.
    numbered = materialise(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered", compression="zstd")
    found = minhash.near_duplicates(numbered, NEAR_PERCENT, doc_id="_row").select(F.col("doc_id").alias("_row"), "component_id")
    order = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").cast("long").alias("doc_id"), "_row")
    first = numbered.select("_row", "doc_id").join(found, "_row").groupBy("component_id").agg(F.min(order).alias("first"))
    return numbered.join(first.select("first._row"), "_row", "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the bytes that repeat a document with a smaller id; their length follows the text."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    found = suffixarray.suffix_array_dedup(docs, carry=others, as_text=True)
    columns = {c: F.col(f"carried.`{c}`") for c in others} | {"doc_id": F.col("doc_id"), "text": F.col("kept")}
    if "n_chars" in others:
        columns["n_chars"] = F.length("kept").cast(docs.schema["n_chars"].dataType)
    return found.select(*[columns[c].alias(c) for c in docs.columns])


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a word inside a benchmark window."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.without_contaminated(docs, decontaminate.decontaminate(docs, benchmark))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of 1024 tokens."""
    return packing.pack(docs, tokenizer_file("byte_bpe_50k.tiktoken"), tokenizer_file("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("suffix_array", repeated_passages),
    ("decontaminate", benchmark_free),
    ("packing", packed),
]

#: SQL cannot express the stages; tests/llm/test_pipeline.py compares them with plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, the last one unwritten."""
    docs, written = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
        if written is not None:
            discard(written)
        written = docs
    return STAGES[-1][1](spark, docs, sf_dir)
