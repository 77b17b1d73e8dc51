"""The operators of this subpackage as queries over the given tables, with their production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcart.llm import chat, collocations, decontaminate, langid, minhash, packing, pairbound, sharding, substring, suffixarray, tokencount, topk, warc
from loomcart.session import scratch_path

#: Folder of the public tokenizers' files; the package that holds them names it where this is None.
TOKENIZERS: str | None = None
HARD_TEXT = "\\### Assistant: </turn> ok"

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.decontaminate(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def tokenizer_file(name: str) -> str:
    if TOKENIZERS:
        return f"{TOKENIZERS}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    model = langid.learn(docs.where(F.col("doc_id").isNotNull() & ~langid.held_out("doc_id")))
    return langid.identify(docs, model).select("doc_id", langid.held_out("doc_id").alias("held_out"), "lang_pred", "score", "rejected")


def op3_suffix_array(spark: SparkSession, folder: str) -> DataFrame:
    found = suffixarray.suffix_array_dedup(_table(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op4_substring(spark: SparkSession, folder: str) -> DataFrame:
    found = substring.substring_dedup(_table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op5_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.createDataFrame([(-7, 0, "user", HARD_TEXT), (-7, 1, "assistant", HARD_TEXT)], rows.schema)
    log = rows.unionByName(hard).withColumns({"seq": F.col("turn"), "kind": F.lit("message")})
    return chat.read_back(chat.format_chats(log))


def op6_warc(spark: SparkSession, folder: str) -> DataFrame:
    archives = scratch_path(spark, "archives")
    warc.write_archives(_table(spark, folder, "pages"), archives)
    return warc.read_archives(spark, archives).drop("payload", "url")


def op7_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, folder, "documents"))


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    cache = scratch_path(spark, "token-counts")
    return tokencount.count_tokens(_table(spark, folder, "documents"), cache, tokenizer_file("piece_bpe_32k.model"))


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    ranks, model = tokenizer_file("byte_bpe_50k.tiktoken"), tokenizer_file("byte_bpe_50k.json")
    return packing.pack(_table(spark, folder, "documents"), ranks, model)


def op10_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(_table(spark, folder, "documents"), F.col("doc_id") % 50 == 0)


def op11_sharding(spark: SparkSession, folder: str) -> DataFrame:
    found = sharding.shard_records(_table(spark, folder, "documents"), 8)
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(_table(spark, folder, "documents"))


def op13_pair_bounds(spark: SparkSession, folder: str) -> DataFrame:
    return pairbound.ranked_search(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def queries() -> dict[str, Query]:
    found = (
        op1_decontaminate,
        op2_language_id,
        op3_suffix_array,
        op4_substring,
        op5_chat_format,
        op6_warc,
        op7_minhash,
        op8_token_counts,
        op9_packing,
        op10_topk,
        op11_sharding,
        op12_collocations,
        op13_pair_bounds,
    )
    return {q.__name__: q for q in found}
