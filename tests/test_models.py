import random

import pytest

from sparkfeat.operators import models as MD
from sparkfeat.operators import stages as S
from sparkfeat.operators.metrics import per_class_metrics
from sparkfeat.operators.split import hash_split
from sparkfeat.operators.weights import attach_class_weights


@pytest.fixture(scope="module")
def separable(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(1500):
        cls = "A" if i % 10 < 8 else "C"          # imbalanced: 80 / 20
        x = rnd.gauss(0.0 if cls == "A" else 3.0, 1.0)
        rows.append((i, cls, x, rnd.gauss(0, 1), "u" if rnd.random() < 0.5 else "v"))
    df = spark.createDataFrame(rows, "FOD_ID long, FIRE_SIZE_CLASS string, signal double, noise double, cat string")
    model = S.feature_stages(["cat"], ["signal", "noise"], label_order="alphabetAsc", handle_invalid="keep").fit(df)
    data = model.transform(df)
    train, test = hash_split(data, "FOD_ID")
    return model, data, train.cache(), test.cache()


def test_every_classifier_beats_majority(separable):
    _, _, train, test = separable
    rows = MD.compare_models(train, test, experiment="t", variant="baseline",
                             params={"LogisticRegression": {"maxIter": 30}, "GBT": {"maxIter": 10}})
    assert [r[3] for r in rows] == ["RandomForest", "DecisionTree", "LogisticRegression", "GBT"]
    for r in rows[:3]:
        assert r[6] > 0.85, r
    assert rows[3][6] > 0.85


def test_importances_rank_signal_first(separable):
    _, data, train, _ = separable
    rf = MD.classifier("RandomForest").fit(train)
    imp = MD.feature_importances(rf, data).collect()
    assert imp[0]["feature"] == "signal"
    assert sum(r["importance"] for r in imp) == pytest.approx(1.0)
    assert {r["feature"] for r in imp} == {"signal", "noise", "cat"}


def test_weights_raise_minority_recall(separable):
    model, _, train, test = separable
    labels = S.fitted_labels(model)

    def minority_recall(tr, weight=None):
        _, pred = MD.fit_score(MD.classifier("LogisticRegression", weight=weight, maxIter=30), tr, test)
        return {r["class"]: r["recall"] for r in per_class_metrics(pred, labels).collect()}["C"]

    weighted = attach_class_weights(train, max_classes=len(labels) + 1)
    assert minority_recall(weighted, "weight") >= minority_recall(train)


def test_same_seed_same_metrics(separable):
    _, _, train, test = separable
    a = MD.evaluate(MD.fit_score(MD.classifier("RandomForest"), train, test)[1])
    b = MD.evaluate(MD.fit_score(MD.classifier("RandomForest"), train, test)[1])
    assert a == b


def test_pca_prefix_property(separable):
    """Leading components (and variances) at a small k equal those of a larger
    fit, which lets the PCA experiment fit once at the largest k."""
    import numpy as np

    _, data, _, _ = separable
    base = S.scaler("raw_features", "scaled_features").fit(data).transform(data)
    small, large = S.pca_fit(base, 2, out="pca"), S.pca_fit(base, 4, out="pca")
    assert np.allclose(small.pc.toArray(), large.pc.toArray()[:, :2])
    assert np.allclose(small.explainedVariance.toArray(), large.explainedVariance.toArray()[:2])


def test_scaling_and_pca_experiments(spark, separable):
    from sparkfeat.plans import experiments as X

    model, data, _, _ = separable
    raw = data.select("FOD_ID", "FIRE_SIZE_CLASS", "signal", "noise", "cat")
    params = {"LogisticRegression": {"maxIter": 5}, "GBT": {"maxIter": 3}, "RandomForest": {"numTrees": 3}}
    sc = X.scaling_experiment(raw, ["cat"], ["signal", "noise"], params=params).comparison.collect()
    assert [(r["variant"], r["model"]) for r in sc][::4] == [("scaled", "RandomForest"), ("unscaled", "RandomForest")]
    assert len(sc) == 8
    pca = X.pca_experiment(raw, ["cat"], ["signal", "noise"], ks=(1, 2), params=params)
    assert [r["k"] for r in pca.comparison.collect()] == [1] * 4 + [2] * 4
    ev = [r["explained_variance"] for r in pca.tables["pca_variance"].orderBy("k").collect()]
    assert 0 < ev[0] <= ev[1] <= 1.0 + 1e-9
    with pytest.raises(ValueError):
        X.pca_experiment(raw, ["cat"], ["signal", "noise"], ks=(50,), params=params)
