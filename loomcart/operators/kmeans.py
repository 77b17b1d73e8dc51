"""K-means for many models at once: one pass over the points serves every k and every start.

A pass gives each model's sums, counts and cost by cluster, added up where the points lie; the driver gets one row for each
cluster of each model and moves the centroids.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcart.session import ship_package

#: Points that the starts are drawn from at most, about; every point counts in every pass.
START_POINTS = 20_000
#: A model rests when its centroids moved by less than this share of the points' mean variance, squared and summed.
TOLERANCE = 1e-4
#: Points whose distances are held at once.
STEP = 8192

Model = np.ndarray  # one centroid a row


def nearest(points: np.ndarray, centroids: np.ndarray, firsts: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    """For every model (its centroids begin at ``firsts``) each point's nearest centroid, the first of equal ones, and the
    squared distance."""
    distance = np.zeros((len(points), len(centroids)))
    for j in range(points.shape[1]):
        distance += (points[:, j, None] - centroids[None, :, j]) ** 2
    ends = [*firsts[1:], len(centroids)]
    place = np.stack([distance[:, a:b].argmin(axis=1) + a for a, b in zip(firsts, ends)], axis=1)
    return place, np.take_along_axis(distance, place, axis=1)


def lloyd_pass(points: DataFrame, columns: Sequence[str], models: Sequence[Model]) -> DataFrame:
    """``model, cluster, n, cost, sums`` of the points nearest to each centroid of each model; empty clusters have no row."""
    ship_package(points.sparkSession)
    centroids = np.concatenate(models)
    firsts = np.cumsum([0] + [len(m) for m in models])[:-1].tolist()
    owner = np.repeat(np.arange(len(models)), [len(m) for m in models])
    inner = np.concatenate([np.arange(len(m)) for m in models])

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, cost, total = np.zeros(len(centroids), np.int64), np.zeros(len(centroids)), np.zeros(centroids.shape)
        for batch in batches:
            for begin in range(0, batch.num_rows, STEP):
                part = batch.slice(begin, STEP)
                x = np.stack([c.to_numpy(zero_copy_only=False) for c in part.columns], axis=1)
                place, distance = nearest(x, centroids, firsts)
                flat = place.ravel()
                n += np.bincount(flat, minlength=len(n))
                cost += np.bincount(flat, distance.ravel(), len(n))
                for j in range(x.shape[1]):
                    total[:, j] += np.bincount(flat, np.repeat(x[:, j], len(models)), len(n))
        met = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict(
            {"model": owner[met], "cluster": inner[met], "n": n[met], "cost": cost[met], "sums": list(total[met])}
        )

    partial = points.select(*[F.col(c).cast("double") for c in columns]).mapInArrow(
        sums, "model long, cluster long, n long, cost double, sums array<double>"
    )
    added = [F.sum(F.col("sums")[j]).alias(f"_s{j}") for j in range(len(columns))]
    summed = partial.groupBy("model", "cluster").agg(F.sum("n").alias("n"), F.sum("cost").alias("cost"), *added)
    return summed.select("model", "cluster", "n", "cost", F.array(*[f"_s{j}" for j in range(len(columns))]).alias("sums"))


def kmeans_step(points: DataFrame, columns: Sequence[str], centroids: Model) -> DataFrame:
    """One step of one model: ``cluster, n, inertia`` and the next centroid under the columns' names. A centroid without
    points has no row."""
    moved = [(F.col("sums")[j] / F.col("n")).alias(c) for j, c in enumerate(columns)]
    return lloyd_pass(points, columns, [centroids]).select("cluster", "n", F.col("cost").alias("inertia"), *moved)


def spread_starts(sample: np.ndarray, k: int, seed: int) -> Model:
    """Starting centroids, each drawn with a chance that grows with its squared distance from those before."""
    random = np.random.default_rng(seed)
    chosen = [sample[random.integers(len(sample))]]
    distance = ((sample - chosen[0]) ** 2).sum(axis=1)
    while len(chosen) < k:
        total = distance.sum()
        at = random.choice(len(sample), p=distance / total) if total > 0 else random.integers(len(sample))
        chosen.append(sample[at])
        distance = np.minimum(distance, ((sample - chosen[-1]) ** 2).sum(axis=1))
    return np.array(chosen)


def fit_many(
    points: DataFrame, columns: Sequence[str], ks: Sequence[int], starts: int, seed: int, iterations: int
) -> dict[int, tuple[Model, float]]:
    """For every k the centroids and cost of the best of ``starts`` runs.

    ``points`` is read once for each iteration, by all runs that still move, and once more for the final costs; give a
    written-out frame. Starts are drawn from about ``START_POINTS`` points. Without points there is no model.
    """
    numbers = points.select(*[F.col(c).cast("double") for c in columns])
    variances = numbers.agg(F.count(F.lit(1)).alias("n"), *[F.var_pop(c).alias(c) for c in columns]).first()
    if not variances["n"]:
        return {}
    limit = TOLERANCE * sum(variances[c] for c in columns) / len(columns)
    chance = F.xxhash64(*columns) / 2.0**64 + 0.5
    drawn = numbers if variances["n"] <= START_POINTS else numbers.where(chance < START_POINTS / variances["n"])
    table = drawn.orderBy(*columns).toArrow()
    sample = np.stack([table[c].to_numpy() for c in columns], axis=1)
    runs = [(k, start) for k in ks for start in range(starts)]
    models = [spread_starts(sample, k, seed + start) for k, start in runs]
    moving = list(range(len(runs)))
    for _ in range(iterations):
        if not moving:
            break
        moved = [models[i].copy() for i in moving]
        for row in lloyd_pass(numbers, columns, [models[i] for i in moving]).collect():
            moved[row["model"]][row["cluster"]] = np.array(row["sums"]) / row["n"]
        shifts = [float(((new - models[i]) ** 2).sum()) for i, new in zip(moving, moved)]
        for i, new in zip(moving, moved):
            models[i] = new
        moving = [i for i, shift in zip(moving, shifts) if shift > limit]
    costs = np.zeros(len(runs))
    for row in lloyd_pass(numbers, columns, models).collect():
        costs[row["model"]] += row["cost"]
    best: dict[int, tuple[Model, float]] = {}
    for (k, _), model, cost in zip(runs, models, costs):
        if k not in best or cost < best[k][1]:
            best[k] = (model, float(cost))
    return best
