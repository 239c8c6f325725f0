"""Node tables of fitted trees: scoring and importances equal the model's."""

import random

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from sparkfeat.operators import forest as FR
from sparkfeat.operators import models as MD
from sparkfeat.operators import stages as S


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(5)
    data = []
    for i in range(1200):
        a, b, c = rnd.gauss(0, 1), rnd.randrange(6), rnd.choice("uvw")
        label = "A" if a + b > 3 else "B" if c == "u" else "C"
        data.append((i, label if rnd.random() < 0.9 else "A", a, float(b), c, float(rnd.randrange(1, 4))))
    df = spark.createDataFrame(data, "FOD_ID long, FIRE_SIZE_CLASS string, a double, b double, cat string, weight double")
    # Without scaling the one-hot slots keep their two categories: splits on sets.
    return S.feature_stages(["cat"], ["a", "b"], scaling=False, label_order="alphabetAsc",
                            handle_invalid="keep").fit(df).transform(df).cache()


def _same(model, scored, raw, own):
    theirs = {r["FOD_ID"]: r for r in model.transform(scored.select("FOD_ID", "features")).collect()}
    mine = scored.collect()
    assert len(mine) == len(theirs) == 1200
    for r in mine:
        assert r["prediction"] == theirs[r["FOD_ID"]]["prediction"]
        assert own(r) == pytest.approx(raw(theirs[r["FOD_ID"]]), abs=1e-12)


@pytest.mark.parametrize("name, params", [
    ("RandomForest", {"numTrees": 7}), ("RandomForest", {"numTrees": 3, "maxDepth": 9, "weight": "weight"}),
    ("DecisionTree", {"maxDepth": 6})])
def test_forest_scores_like_the_model(rows, name, params):
    model = MD.classifier(name, **params).fit(rows)
    nodes = FR.forest_nodes(model)
    assert nodes.where("left_categories IS NOT NULL AND threshold IS NULL").count() > 0
    assert nodes.where("(left >= 0) <> (feature IS NOT NULL)").count() == 0
    scored = FR.score_forest(rows.select("FOD_ID", "features"), nodes)
    share = 1.0 if name == "RandomForest" else None

    def raw(r):
        v = list(r["rawPrediction"])
        return v if share else [x / sum(v) for x in v]
    _same(model, scored, raw, lambda r: r["votes"])


def test_boosted_scores_like_the_model(rows):
    data = MD.with_binary_label(rows)
    model = MD.classifier("GBT", label="binary_label", maxIter=6, maxDepth=3).fit(data)
    scored = FR.score_boosted(rows.select("FOD_ID", "features"), FR.forest_nodes(model))
    _same(model, scored, lambda r: r["rawPrediction"][1], lambda r: r["margin"])


@pytest.mark.parametrize("name, params, per_tree", [
    ("RandomForest", {"numTrees": 6}, True), ("DecisionTree", {}, True), ("GBT", {"maxIter": 4, "label": "binary_label"}, False)])
def test_importances_equal_the_model(rows, name, params, per_tree):
    model = MD.classifier(name, **params).fit(MD.with_binary_label(rows))
    own = {r["feature"]: r["importance"]
           for r in FR.node_importances(FR.forest_nodes(model), MD.slot_sources(rows), per_tree).collect()}
    theirs = {r["feature"]: r["importance"] for r in MD.feature_importances(model, rows, top=None).collect()}
    assert set(own) <= set(theirs)
    for source, value in theirs.items():
        assert own.get(source, 0.0) == pytest.approx(value, abs=1e-12)


def test_single_leaf_and_empty_input(spark):
    df = spark.createDataFrame([(i, 1.0, Vectors.dense([float(i)])) for i in range(8)], ["FOD_ID", "label", "features"])
    model = MD.classifier("DecisionTree").fit(df)
    nodes = FR.forest_nodes(model)
    assert [(r["node"], r["left"], r["feature"], r["rows"]) for r in nodes.collect()] == [(0, -1, None, 8)]
    assert {r["prediction"] for r in FR.score_forest(df, nodes).collect()} == {1.0}
    assert FR.node_importances(nodes, ["x"]).collect() == []
    assert FR.score_forest(df.where(F.lit(False)), nodes).collect() == []


def test_nodes_beyond_the_bound_are_refused(rows):
    nodes = FR.forest_nodes(MD.classifier("DecisionTree").fit(rows))
    with pytest.raises(ValueError, match="max_nodes"):
        FR.score_forest(rows, nodes, max_nodes=2)


def test_scoring_neither_shuffles_nor_copies_rows(rows):
    nodes = FR.forest_nodes(MD.classifier("RandomForest", numTrees=3).fit(rows))
    plan = FR.score_forest(rows.select("FOD_ID", "features"), nodes)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan and "Join" not in plan
