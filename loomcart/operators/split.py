"""Train/test splits that depend on the row key only, never on row order or partitioning."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcart.functions.scalar import share_between
from loomcart.operators.ranks import after, rows_at_ranks
from loomcart.session import materialise

SEED = 42
TEST_PERCENT = 20
#: Rows of a task in a fit: of at most ``FIT_TASKS`` tasks that number, of more rows as many as keep a task busy for longer
#: than it takes to start, up to the last number; beyond that there are more tasks.
FIT_ROWS_PER_TASK, FIT_TASKS, FIT_ROWS_PER_TASK_AT_MOST = 25_000, 12, 250_000


def random_split(df: DataFrame, key: str = "customer_id", percent: int = TEST_PERCENT, seed: int = SEED) -> DataFrame:
    """Add ``is_test``: each row lands in the test part with ``percent`` probability."""
    return df.withColumn("is_test", share_between(F.col(key), seed) % 100 < percent)


def stratified_split(
    df: DataFrame,
    label: str,
    key: str = "customer_id",
    percent: int = TEST_PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """Add ``is_test``: exactly ``percent`` of every label (halves up), lowest key hashes first."""
    hashed = df.withColumn("_hash", share_between(F.col(key), seed))
    base = materialise(hashed, "split")
    counts = {r[label]: r["n"] for r in base.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    order = [label, "_hash", key]
    start, lasts = 0, {}
    for value in sorted(counts):
        quota = math.floor((counts[value] * percent + 50) / 100)
        if quota:
            lasts[value] = start + quota
        start += counts[value]
    edges = rows_at_ranks(base, order, list(lasts.values()))
    is_test = F.lit(False)
    for value, rank in lasts.items():
        is_test = is_test | ((F.col(label) == F.lit(value)) & ~after(edges[rank], order))
    return base.withColumn("is_test", is_test).drop("_hash")


def fit_tasks(rows: int) -> int:
    """Partitions for a fit on ``rows`` rows; they depend on the rows alone, and so does the model."""
    few = min(math.ceil(rows / FIT_ROWS_PER_TASK), FIT_TASKS)
    return max(1, few, math.ceil(rows / FIT_ROWS_PER_TASK_AT_MOST))


@contextmanager
def fit_rows(train: DataFrame, key: str, limit: int | None = None, seed: int = SEED) -> Iterator[DataFrame]:
    """All rows of ``train``, or about ``limit`` of them where one is given, cached in few partitions while the block runs.

    The models give no limit. Boosting runs several jobs for each of its rounds, and on few rows a task their cost is that of
    starting tasks.
    """
    total, rows = train.count(), train
    if limit is not None and total > limit:
        rows = train.where(share_between(F.col(key), seed + 1) < math.ceil(2**32 * (limit / total)))
        total = limit
    kept = rows.repartition(fit_tasks(total)).drop(key).persist()
    try:
        yield kept
    finally:
        kept.unpersist()
