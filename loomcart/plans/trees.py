"""Boosted trees as a table of nodes, and scores from it as column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcart.session import scratch_path

#: A node of tree ``tree``: rows whose feature is at most ``threshold``, or one of ``categories``, go to ``left``. Leaves
#: have feature -1 and a value, the tree's weight included. ``rows`` is the (weighted) number of training rows that met the
#: node, ``gain`` what the split took off their impurity. Nodes count from 0, the root, in every tree.
NODES = (
    "tree int, node int, feature int, threshold double, categories array<double>, left int, right int, value double, "
    "rows double, gain double"
)


def saved_nodes(spark: SparkSession, model) -> dict[int, dict[int, object]]:
    """Nodes per tree from the saved model, whose size depends on the model alone."""
    path = scratch_path(spark, "model")
    model.write().save(path)
    nodes: dict[int, dict[int, object]] = {}
    for row in spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect():
        nodes.setdefault(row["treeID"], {})[row["id"]] = row
    return nodes


def node_table(spark: SparkSession, model) -> DataFrame:
    """The nodes of a fitted tree ensemble."""
    out = []
    for tree, nodes in sorted(saved_nodes(spark, model).items()):
        place = {id_: i for i, id_ in enumerate(sorted(nodes))}
        for id_, node in sorted(nodes.items()):
            if node["leftChild"] < 0:
                out.append((tree, place[id_], -1, None, None, None, None, model.treeWeights[tree] * node["prediction"], float(node["impurityStats"][0]), None))
                continue
            split = node["split"]
            values = [float(v) for v in split["leftCategoriesOrThreshold"]]
            by_value = split["numCategories"] < 0
            out.append(
                (tree, place[id_], split["featureIndex"], values[0] if by_value else None, None if by_value else values,
                 place[node["leftChild"]], place[node["rightChild"]], None, float(node["impurityStats"][0]), float(node["gain"]))
            )
    return spark.createDataFrame(out, NODES)


def with_margin(rows: DataFrame, nodes: DataFrame, x: Column, name: str = "margin") -> DataFrame:
    """``rows`` with the sum over all trees of the leaf that the features ``x`` (an array) lead to; 0 without trees.

    ``nodes`` becomes one value, whose size depends on the model alone. A missing feature goes right.
    """
    fields = ("feature", "threshold", "categories", "left", "right", "value")
    per_tree = nodes.groupBy("tree").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("node", *fields))), lambda n: F.struct(*[n[f].alias(f) for f in fields])).alias("nodes")
    )
    model = per_tree.agg(F.transform(F.array_sort(F.collect_list(F.struct("tree", "nodes"))), lambda t: t["nodes"]).alias("trees")).scalar()
    features = F.col("_x")

    def leaf(tree: Column) -> Column:
        def step(at: Column, _: Column) -> Column:
            node = F.get(tree, at)
            value = F.get(features, node["feature"])
            goes_left = F.coalesce((value <= node["threshold"]) | F.array_contains(node["categories"], value), value <= node["threshold"], F.lit(False))
            return F.when(node["feature"] < 0, at).when(goes_left, node["left"]).otherwise(node["right"])

        # A path has at most half as many steps as the tree has nodes.
        steps = F.sequence(F.lit(0), F.floor((F.size(tree) - 1) / 2).cast("int"))
        return F.get(tree, F.aggregate(steps, F.lit(0), step))["value"]

    total = F.aggregate("_trees", F.lit(0.0), lambda so_far, tree: so_far + leaf(tree))
    return rows.withColumns({"_x": x, "_trees": model}).withColumn(name, total).drop("_x", "_trees")


def importance(nodes: DataFrame, names: Sequence[str]) -> DataFrame:
    """``feature, importance``: each named feature's share of all gains, weighted by the rows that met the splits; 0 for one
    without a split."""
    known = nodes.sparkSession.createDataFrame(list(enumerate(names)), "_number int, feature string")
    gained = nodes.where("feature >= 0").groupBy(F.col("feature").alias("_number")).agg(F.sum(F.col("gain") * F.col("rows")).alias("_gained"))
    total = gained.agg(F.sum("_gained")).scalar()
    share = F.coalesce(F.try_divide(F.col("_gained"), total), F.lit(0.0))
    return known.join(gained, "_number", "left").select("feature", share.alias("importance"))


def probability(margin: Column) -> Column:
    """Of the positive class, for trees boosted on the logistic loss of twice the margin."""
    return 1 / (1 + F.exp(-2 * margin))


def tree_rows(spark: SparkSession, rows: Iterable[tuple]) -> DataFrame:
    return spark.createDataFrame(list(rows), NODES)
