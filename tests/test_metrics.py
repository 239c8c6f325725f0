import random

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator

from sparkfeat.operators.metrics import (accuracy_f1, class_distribution, confusion_long, confusion_wide,
                                         per_class_metrics)
from sparkfeat.operators.weights import attach_class_weights, balanced_weights


def _pred(spark, pairs):
    return spark.createDataFrame([(float(a), float(b)) for a, b in pairs], "label double, prediction double")


def test_accuracy_weighted_f1_example(spark):
    row = accuracy_f1(_pred(spark, [(0, 0), (0, 1), (1, 1), (2, 0), (1, 1)])).first()
    assert row["accuracy"] == pytest.approx(0.6)
    assert row["f1_weighted"] == pytest.approx(0.52)


def test_matches_spark_evaluator(spark):
    rnd = random.Random(7)
    pairs = [(rnd.randrange(5), rnd.choice([0, 1, 1, 2, 4])) for _ in range(500)]
    pred = _pred(spark, pairs)
    ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    row = accuracy_f1(pred).first()
    assert row["accuracy"] == pytest.approx(ev.evaluate(pred, {ev.metricName: "accuracy"}))
    assert row["f1_weighted"] == pytest.approx(ev.evaluate(pred, {ev.metricName: "f1"}))


def test_per_class_never_predicted_and_absent(spark):
    pred = _pred(spark, [(0, 0), (0, 0), (1, 0), (1, 1)])
    got = {r["class"]: r for r in per_class_metrics(pred, ["a", "b", "c"]).collect()}
    assert set(got) == {"a", "b", "c"}
    assert got["b"]["precision"] == pytest.approx(1.0) and got["b"]["recall"] == pytest.approx(0.5)
    assert got["a"]["precision"] == pytest.approx(2 / 3) and got["a"]["recall"] == pytest.approx(1.0)
    assert (got["c"]["precision"], got["c"]["recall"], got["c"]["f1"]) == (0.0, 0.0, 0.0)


def test_confusion_tables(spark):
    pred = _pred(spark, [(0, 0), (0, 1), (1, 1), (2, 0), (1, 1)])
    long = {(r["label"], r["prediction"]): r["count"] for r in confusion_long(pred).collect()}
    assert long == {(0.0, 0.0): 1, (0.0, 1.0): 1, (1.0, 1.0): 2, (2.0, 0.0): 1}
    wide = confusion_wide(pred, ["x", "y", "z"])
    assert wide.columns == ["label", "x", "y", "z", "N/A"]
    rows = {r["label"]: (r["x"], r["y"], r["z"]) for r in wide.collect()}
    assert rows == {"x": (1, 1, 0), "y": (0, 2, 0), "z": (1, 0, 0)}
    dist = {r["label"]: r["count"] for r in class_distribution(pred).collect()}
    assert dist == {0.0: 2, 1.0: 2, 2.0: 1}


def test_balanced_weights(spark):
    df = spark.createDataFrame([(float(x),) for x in [0, 0, 0, 1]], "label double")
    w = {r["label"]: r["weight"] for r in balanced_weights(df).collect()}
    assert w == {0.0: pytest.approx(4 / 6), 1.0: pytest.approx(2.0)}
    out = attach_class_weights(df, max_classes=3).collect()
    assert sorted(r["weight"] for r in out) == pytest.approx([4 / 6] * 3 + [2.0])


def test_class_weights_over_budget_path(spark):
    rows = [(float(0 if i % 3 else 1),) for i in range(300)]
    df = spark.createDataFrame(rows, "label double")
    out = attach_class_weights(df, max_broadcast_rows=1).collect()
    w = {r["label"]: r["weight"] for r in out}
    assert w == {0.0: pytest.approx(300 / (2 * 200)), 1.0: pytest.approx(300 / (2 * 100))}
    assert len(out) == 300
