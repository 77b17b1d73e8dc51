"""Many-to-one lookups that stay balanced when one key holds much of the fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcart.session import broadcast_limit, plan_bytes

#: Keys that the heavy-hitter sketch follows for each shuffle partition, and at most. The sketch decides how a join is
#: spread, never which rows it returns.
TRACKED_PER_PARTITION, TRACKED = 128, 1_000_000


def hot_keys(df: DataFrame, key: str) -> list[tuple]:
    """(key, number of parts) for keys that fill half a shuffle partition or more, at most two keys a partition; one pass."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tracked = min(TRACKED, TRACKED_PER_PARTITION * partitions)
    top = F.call_function("approx_top_k", F.col(key), F.lit(min(2 * partitions, tracked)), F.lit(tracked))
    known = df.where(F.col(key).isNotNull()).select(key).agg(F.count(F.lit(1)).alias("rows"), top.alias("top")).first()
    half = known["rows"] / partitions / 2
    return [(r["item"], int(r["count"] / half) + 1) for r in known["top"] or [] if r["count"] > half]


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    spread: str,
    how: str = "left",
    keys_from: DataFrame | None = None,
    dim_bytes_limit: int | None = None,
) -> DataFrame:
    """Bring the columns of ``dim`` (unique by ``key``) onto every row of ``fact``.

    A dimension within Spark's broadcast threshold by the size of what it is read from is broadcast. A larger one is joined
    by shuffle, and there the rows of a hot key are spread over as many parts as the key fills half partitions,
    by the hash of the fact column ``spread`` (or their place, where it is null), while only the hot dimension rows are
    repeated. Rows with a null key are spread over all partitions.

    ``keys_from`` is a cheaper frame with the same keys to look for hot ones, for a ``fact`` that is itself the outcome
    of a join.
    """
    if how == "inner" and dim.columns == [key]:
        how = "left_semi"  # nothing to add, only to filter
    spark = fact.sparkSession
    limit = broadcast_limit(spark) if dim_bytes_limit is None else dim_bytes_limit
    if plan_bytes(dim) <= limit:
        return fact.join(F.broadcast(dim), key, how)

    found = hot_keys(fact if keys_from is None else keys_from, key)
    kind = fact.schema[key].dataType.simpleString()
    parts = F.broadcast(spark.createDataFrame(found, f"`{key}` {kind}, _parts int"))  # two rows a partition at most
    place = F.when(F.col(spread).isNull(), F.monotonically_increasing_id()).otherwise(F.xxhash64(spread))
    width = F.when(F.col(key).isNull(), int(spark.conf.get("spark.sql.shuffle.partitions"))).otherwise(F.coalesce("_parts", F.lit(1)))
    salted_fact = fact.join(parts, key, "left").withColumn("_salt", F.pmod(place, width).cast("int")).drop("_parts")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))
    salted_dim = dim.join(parts, key, "left").withColumn("_salt", copies).drop("_parts")
    return salted_fact.join(salted_dim, [key, "_salt"], how).drop("_salt")
