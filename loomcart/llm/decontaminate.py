"""Benchmark decontamination by winnowing.

Of every ``window - gram + 1`` consecutive word grams the smallest hash is kept, on both sides by the same rule, so two
texts that share ``window`` words share a kept hash. Fingerprints are joined. In documents with a hit every window is one
narrow row, met by its kept hash and compared word by word with the benchmark's, so the work there grows with words and
hits, not with their product. Everything runs in DataFrame functions.

The filters that would read a word array twice are written as ``when``: Catalyst would move them below the projection
and evaluate the array again inside every lambda. ``explode_outer`` is used for the same reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomcart.llm.common import ascii_lower, if_small
from loomcart.session import materialise

BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The benchmark's windows are broadcast up to this measured size; larger ones are joined by a shuffle.
BROADCAST_BYTES = 32 * 2**20


def words_of(text: Column) -> Column:
    """Words of a text in lower case; none for null."""
    return F.filter(F.split(F.coalesce(ascii_lower(text), F.lit("")), BETWEEN_WORDS), lambda w: w != "")


def _gram_hashes(hashes: str, length: int) -> Column:
    """Hash of every run of ``length`` words, given the hashes of the words; null for shorter texts."""
    return F.when(
        F.size(hashes) >= length,
        F.transform(
            F.sequence(F.lit(0), F.size(hashes) - length),
            lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(length)]),
        ),
    )


def _smallest(grams: str, span: int) -> Column:
    """The smallest hash of every ``span`` neighbours; null if there are fewer."""
    return F.when(
        F.size(grams) >= span,
        F.transform(
            F.sequence(F.lit(0), F.size(grams) - span),
            lambda i: F.least(*[F.get(grams, i + j) for j in range(span)]) if span > 1 else F.get(grams, i),
        ),
    )


def _hashes(words: str) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def benchmark_windows(benchmark: DataFrame, window: int, gram: int, item_id: str, text: str) -> DataFrame:
    """Distinct windows: joined words, length, first word's hash, fingerprint, its place, and the items that have it."""
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), words_of(F.col(text)).alias("words"))
    cut = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size("words") - window, F.lit(0))), lambda i: F.slice("words", i + 1, window)
    )
    windows = (
        items.select("item", F.explode_outer(F.when(F.size("words") > 0, cut)).alias("w"))
        .where(F.col("w").isNotNull())
        .groupBy("w")
        .agg(F.collect_set("item").alias("items"))
        .select("*", _hashes("w").alias("h"))
        .select("*", _gram_hashes("h", gram).alias("g"))
    )
    whole = F.size("w") == window
    short = F.coalesce(*[F.when(F.size("w") == n, F.get(_gram_hashes("h", n), 0)) for n in range(1, window)]) if window > 1 else F.lit(None)
    return windows.select(
        F.array_join("w", " ").alias("phrase"),
        F.size("w").alias("length"),
        F.get("h", 0).alias("first"),
        F.when(whole, F.array_min("g")).otherwise(short).alias("mark"),
        F.when(whole, F.array_position("g", F.array_min("g")) - 1).cast("int").alias("place"),
        "items",
    )


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    window: int = 10,
    gram: int = 5,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Which words of each document lie inside a benchmark window.

    A window is ``window`` consecutive words of an item, or the whole item if it has fewer words but any. Result, one
    row per input row: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items, spans`` and the ``digest``
    (xxhash64) of the text; ``spans`` are the hit word ranges ``(start, stop)``, sorted and merged.

    Null or empty texts have no words, items without words no window. Repeated rows and null ids are rows like others. A
    null item id marks words but is not listed. Columns other than id and text are ignored on both sides.
    """
    if not 1 <= gram <= window:
        raise ValueError("gram must lie between 1 and window")
    windows = materialise(benchmark_windows(benchmark, window, gram, item_id, item_text), "benchmark-windows")
    size, lengths = windows.agg(
        F.coalesce(F.sum(F.length("phrase") * 4 + F.length(F.array_join("items", " ")) * 4 + 128), F.lit(0)),
        F.collect_set("length"),  # at most ``window`` values
    ).first()

    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    keyed = source.select("doc_id", F.xxhash64("text").alias("digest"), "text")
    marked = (
        keyed.select("doc_id", "digest", words_of(F.col("text")).alias("words"))
        .select("doc_id", "digest", F.size("words").cast("long").alias("n_words"), _hashes("words").alias("h"))
        .select("*", _gram_hashes("h", gram).alias("g"))
    )
    kept = [_smallest("g", window - gram + 1)] if window in lengths else []
    kept += [_gram_hashes("h", n) for n in sorted(lengths) if n < window]
    none = F.array().cast("array<bigint>")
    # The null mark that every document gets carries its row through the join.
    marks = F.array_append(F.array_distinct(F.concat(none, *[F.coalesce(k, none) for k in kept])), F.lit(None))
    found = if_small(windows.select(F.col("mark").alias("met")).distinct().withColumn("known", F.lit(True)), size, broadcast_bytes)
    # Rows without a mark go anywhere, not to one key.
    scanned = (
        marked.select("doc_id", "digest", "n_words", F.explode_outer(marks).alias("mark"))
        .withColumn("met", F.coalesce("mark", F.xxhash64(F.monotonically_increasing_id())))
        .join(found, "met", "left")
        .where(F.col("known") | F.col("mark").isNull())
        .groupBy("doc_id", "digest", "n_words")
        .agg(F.count_if(F.col("mark").isNull()).alias("copies"), F.collect_set("mark").alias("marks"))
    )
    scanned = materialise(scanned, "fingerprints")

    hit = scanned.where(F.size("marks") > 0).select("doc_id", "digest").alias("s")
    suspects = (
        keyed.alias("k")
        .join(hit, F.col("k.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("k.digest") == F.col("s.digest")))
        .select("k.doc_id", "k.digest", words_of(F.col("k.text")).alias("words"))
        .select("*", _hashes("words").alias("h"))
        .select("*", _gram_hashes("h", gram).alias("g"))
    )
    # The mark of every run of each length that a window may have, with its first word's place.
    runs = [(window, _smallest("g", window - gram + 1))] if window in lengths else []
    runs += [(n, _gram_hashes("h", n)) for n in sorted(lengths) if n < window]
    no_run = F.array().cast("array<struct<start:int,length:int,mark:bigint>>")

    def numbered(length: int, hashed: Column) -> Column:
        at = F.transform(hashed, lambda m, i: F.struct(i.cast("int").alias("start"), F.lit(length).alias("length"), m.alias("mark")))
        return F.coalesce(at, no_run)

    starts = [numbered(*run) for run in runs]
    # A shuffle join meets windows by their words as well, so that a passage known to many is spread.
    opened = suspects.select("doc_id", "digest", "words", F.explode(F.concat(no_run, *starts)).alias("r")).select(
        "doc_id", "digest", "r.start", "r.length", "r.mark", F.array_join(F.slice("words", F.col("r.start") + 1, F.col("r.length")), " ").alias("phrase")
    )
    known = if_small(windows.select("mark", "length", "phrase", "items"), size, broadcast_bytes)
    matched = opened.join(known, ["mark", "length", "phrase"]).select(
        "doc_id", "digest", "start", (F.col("start") + F.col("length")).alias("stop"), "items"
    )
    matched = materialise(matched, "benchmark-hits")
    before = Window.partitionBy("doc_id", "digest").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    so_far = Window.partitionBy("doc_id", "digest").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, 0)
    apart = (F.col("start") > F.coalesce(F.max("stop").over(before), F.lit(-1))).cast("int")
    spans = (
        matched.select("doc_id", "digest", "start", "stop").distinct()
        .withColumn("_apart", apart)
        .withColumn("_span", F.sum("_apart").over(so_far))
        .groupBy("doc_id", "digest", "_span").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
        .groupBy("doc_id", "digest").agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("spans"))
    )
    # A window without a listed item still marks its document.
    named = (
        matched.select("doc_id", "digest", F.explode_outer("items").alias("item")).distinct()
        .groupBy("doc_id", "digest").agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    same = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.digest") == F.col("b.digest"))
    hits = spans.alias("a").join(named.alias("b"), same).select("a.doc_id", "a.digest", "spans", "items").alias("h")
    both = (
        scanned.alias("d")
        .join(hits, F.col("d.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.col("d.digest") == F.col("h.digest")), "left")
        .select(
            "d.doc_id",
            "d.digest",
            "d.n_words",
            F.coalesce("h.spans", F.array().cast("array<struct<start:int,stop:int>>")).alias("spans"),
            F.coalesce("h.items", F.array().cast("array<string>")).alias("items"),
            F.explode(F.sequence(F.lit(1), F.col("d.copies"))).alias("copy"),
        )
    )
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["stop"] - x["start"])
    return both.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
        "items",
        "spans",
        "digest",
    )


def without_contaminated(docs: DataFrame, found: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` in which ``found``, made from them, has no hit; all columns stay."""
    bad = found.where("contaminated").select(F.col("doc_id").alias("bad_id"), F.col("digest").alias("bad_digest")).distinct()
    return docs.join(
        bad, F.col(doc_id).eqNullSafe(F.col("bad_id")) & (F.xxhash64(text) == F.col("bad_digest")), "left_anti"
    )
