"""Tree models as a relation: nodes, scoring and importances (#36, #46, #47, #49, #52).

``forest_nodes`` turns a fitted tree, forest or boosted model into a table with
one row per node.  Scoring and importances are computed from that table alone,
so a model can be inspected, joined and checked with SQL, and rows are scored
without the model object.

Defined cases: a model that is one leaf has one node (no split, children -1) and
importance 0 for every feature, so the importance table is empty; classes tie to
the smallest label, as in the fitted model.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import _delete, materialize, scratch_path

#: Largest model (in nodes) that is put into the scoring expression.
MAX_NODES = 1_000_000


def forest_nodes(model) -> DataFrame:
    """``tree, tree_weight, node, left, right, feature, threshold, left_categories,
    impurity, gain, rows, stats, prediction`` of a fitted decision tree, random
    forest or gradient-boosted model.  ``node`` counts from 0 at the root, left
    subtree first; a leaf has children -1 and null split columns.  ``stats`` are
    the (weighted) class sums of the node, or count, sum and sum of squares for a
    regression tree.  A split on a category has ``left_categories``, any other a
    ``threshold`` (left: at most the threshold)."""
    spark = SparkSession.active()
    path = scratch_path(spark, "model")
    model.write().save(path)
    data = spark.read.parquet(f"{path}/data")
    if "nodeData" in data.columns:
        weights = spark.read.parquet(f"{path}/treesMetadata").toDF("tree", "params", "tree_weight").drop("params")
        # One row per tree of a model that the driver holds.
        data = data.select(F.col("treeID").alias("tree"), "nodeData.*").join(F.broadcast(weights), "tree")
    else:
        data = data.select(F.lit(0).alias("tree"), F.lit(1.0).alias("tree_weight"), "*")
    inner, values = F.col("leftChild") >= 0, F.col("split.leftCategoriesOrThreshold")
    category = inner & (F.col("split.numCategories") >= 0)
    nodes = materialize(data.select(
        "tree", "tree_weight", F.col("id").alias("node"), F.col("leftChild").alias("left"),
        F.col("rightChild").alias("right"), F.when(inner, F.col("split.featureIndex")).alias("feature"),
        F.when(inner & ~category, F.get(values, F.lit(0))).alias("threshold"),
        F.when(category, values).alias("left_categories"), "impurity", F.when(inner, F.col("gain")).alias("gain"),
        F.col("rawCount").alias("rows"), F.col("impurityStats").alias("stats"), "prediction"), "forest-nodes")
    _delete(spark, path)
    return nodes


def _model_arrays(nodes: DataFrame, max_nodes: int) -> tuple[list, np.ndarray]:
    """Nodes in (tree, node) order, and the position of every tree's root."""
    count = nodes.count()
    if count > max_nodes:
        raise ValueError(f"{count} nodes, more than max_nodes = {max_nodes}")
    rows = sorted(nodes.collect(), key=lambda r: (r["tree"], r["node"]))
    return rows, np.array([i for i, r in enumerate(rows) if r["node"] == 0], dtype=np.int32)


def _leaf(rows: list, roots: np.ndarray, x: Column, root: Column) -> Column:
    """Position of the leaf that the vector ``x`` reaches from ``root``."""
    offset = np.repeat(roots, np.diff(np.append(roots, len(rows))))
    child = [np.array([r[side] + o if r[side] >= 0 else -1 for r, o in zip(rows, offset)], dtype=np.int32)
             for side in ("left", "right")]
    depth = np.zeros(len(rows), dtype=int)
    for i in range(len(rows)):  # parents come before their children
        for c in child:
            if c[i] >= 0:
                depth[c[i]] = depth[i] + 1
    if not depth.max():
        return root
    left, right = (F.lit(c) for c in child)
    feature = F.lit(np.array([-1 if r["feature"] is None else r["feature"] for r in rows], dtype=np.int32))
    threshold = F.lit(np.array([0.0 if r["threshold"] is None else r["threshold"] for r in rows]))
    sets = [r["left_categories"] for r in rows]
    sizes = np.array([-1 if s is None else len(s) for s in sets], dtype=np.int32)
    starts = np.cumsum(np.maximum(sizes, 0)) - np.maximum(sizes, 0) + 1
    categories = F.lit(np.array([v for s in sets if s for v in s] or [0.0]))

    def step(node, _):
        value = F.get(x, F.get(feature, node))
        goes_left = value <= F.get(threshold, node)
        if (sizes >= 0).any():
            size = F.get(F.lit(sizes), node)
            part = F.slice(categories, F.get(F.lit(starts.astype(np.int32)), node), F.greatest(size, F.lit(0)))
            goes_left = F.when(size >= 0, F.array_contains(part, value)).otherwise(goes_left)
        return F.when(F.get(left, node) < 0, node).otherwise(
            F.when(goes_left, F.get(left, node)).otherwise(F.get(right, node)))

    return F.aggregate(F.sequence(F.lit(1), F.lit(int(depth.max()))), root, step)


def score_forest(df: DataFrame, nodes: DataFrame, features: str = "features", out: str = "prediction",
                 votes: str = "votes", max_nodes: int = MAX_NODES) -> DataFrame:
    """``df`` with ``votes`` (per class, the sum over trees of the reached leaf's
    class shares) and ``out`` (the class with most, ties to the smallest).

    The nodes become constant arrays of the scoring expression, so no row is
    copied per tree and nothing is shuffled.  They are collected for that: their
    number is counted first and must not pass ``max_nodes``."""
    rows, roots = _model_arrays(nodes, max_nodes)
    classes = len(rows[0]["stats"])
    share = np.array([s / s.sum() if s.sum() else s for s in (np.array(r["stats"]) for r in rows)])
    shares, zero = F.lit(share.ravel()), F.lit(np.zeros(classes))

    def vote(x):
        def add(sums, root):
            own = F.slice(shares, _leaf(rows, roots, x, root) * classes + 1, F.lit(classes))
            return F.zip_with(sums, own, lambda a, b: a + b)
        return F.aggregate(F.lit(roots), zero, add)

    # The lambda keeps the vector's conversion out of the walk: once per row.
    out_votes = F.get(F.transform(F.array(vector_to_array(features)), vote), F.lit(0))
    best = F.array_position(F.col(votes), F.array_max(votes)) - 1
    return df.withColumn(votes, out_votes).withColumn(out, best.cast("double"))


def score_boosted(df: DataFrame, nodes: DataFrame, features: str = "features", out: str = "prediction",
                  margin: str = "margin", max_nodes: int = MAX_NODES) -> DataFrame:
    """``df`` with ``margin`` (weighted sum of the reached leaves' predictions) and
    ``out`` (1 if the margin is positive, else 0); bounds as in ``score_forest``."""
    rows, roots = _model_arrays(nodes, max_nodes)
    value = F.lit(np.array([r["tree_weight"] * r["prediction"] for r in rows]))

    def total(x):
        return F.aggregate(F.lit(roots), F.lit(0.0), lambda s, root: s + F.get(value, _leaf(rows, roots, x, root)))

    out_margin = F.get(F.transform(F.array(vector_to_array(features)), total), F.lit(0))
    return df.withColumn(margin, out_margin).withColumn(out, (F.col(margin) > 0).cast("double"))


def node_importances(nodes: DataFrame, sources: list[str], per_tree: bool = True) -> DataFrame:
    """``feature, importance`` per source column: gain times the node's weight,
    summed per tree and slot, normalised per tree (unless ``per_tree`` is off, as
    for boosted trees), summed over trees, normalised, and summed over the slots
    of a source (``sources[slot]``).  Columns without a split have no row."""
    weight = F.aggregate("stats", F.lit(0.0), lambda a, b: a + b) if per_tree else F.get("stats", F.lit(0))
    slot = (nodes.where("left >= 0").groupBy("tree", "feature")
            .agg(F.sum(F.col("gain") * weight).alias("part")))
    if per_tree:
        tree = slot.groupBy("tree").agg(F.sum("part").alias("whole"))
        slot = slot.join(tree, "tree").withColumn("part", F.col("part") / F.col("whole"))
    names = nodes.sparkSession.createDataFrame(list(enumerate(sources)), "feature int, source string")
    by_source = slot.join(names, "feature").groupBy("source").agg(F.sum("part").alias("part"))
    whole = by_source.agg(F.sum("part").alias("whole"))
    return (by_source.crossJoin(F.broadcast(whole))  # one row
            .select(F.col("source").alias("feature"), (F.col("part") / F.col("whole")).alias("importance")))
