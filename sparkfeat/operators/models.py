"""Classifiers, scoring, importances and model comparison (#36, #46-#53)."""

from __future__ import annotations

import time

from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.rules import binary_target
from .boosting import BoostedTrees
from .metrics import accuracy_f1

MULTICLASS = ("RandomForest", "DecisionTree", "LogisticRegression")
COMPARISON_SCHEMA = ("experiment string, variant string, k int, model string, train_rows bigint, "
                     "test_rows bigint, accuracy double, f1_weighted double, seconds double")


def classifier(name: str, features: str = "features", label: str = "label",
               weight: str | None = None, seed: int = K.SEED, **params):
    """Random forest / decision tree (seed 42), logistic regression, or binary
    gradient-boosted trees; library defaults unless ``params`` override (#46-#50)."""
    extra = {"weightCol": weight} if weight else {}
    if name == "RandomForest":
        return RandomForestClassifier(featuresCol=features, labelCol=label, seed=seed, **extra, **params)
    if name == "DecisionTree":
        return DecisionTreeClassifier(featuresCol=features, labelCol=label, seed=seed, **extra, **params)
    if name == "LogisticRegression":
        return LogisticRegression(featuresCol=features, labelCol=label, **extra, **params)
    if name == "GBT":
        return BoostedTrees(featuresCol=features, labelCol=label, seed=seed, **extra, **params)
    raise ValueError(f"unknown model {name!r}")


def with_binary_label(df: DataFrame, target: str = K.TARGET, out: str = "binary_label") -> DataFrame:
    """Binary target for the GBT model: classes C..G -> 1.0 (#15)."""
    return df.withColumn(out, binary_target(F.col(target)))


def fit_score(estimator, train: DataFrame, test: DataFrame):
    """Fit on ``train`` and score ``test`` (#51)."""
    model = estimator.fit(train)
    return model, model.transform(test)


def evaluate(pred: DataFrame, label: str = "label") -> tuple[float | None, float | None]:
    """(accuracy, weighted F1) from one aggregate over the predictions; nulls
    when there is nothing to score."""
    row = accuracy_f1(pred, label).collect()[0]
    return row["accuracy"], row["f1_weighted"]


def slot_sources(df: DataFrame, vec: str = "raw_features") -> list[str]:
    """Source column of every vector slot, read from the assembler metadata
    (``ml_attr``); ``<c>_imputed`` / ``<c>_enc_<value>`` slots map to ``c``."""
    attrs = df.schema[vec].metadata["ml_attr"]["attrs"]
    slots = {}
    for group in attrs.values():
        for a in group:
            slots[a["idx"]] = a["name"]
    size = df.schema[vec].metadata["ml_attr"].get("num_attrs", len(slots))
    names = []
    for i in range(size):
        name = slots.get(i, f"slot_{i}")
        if name.endswith("_imputed"):
            name = name[: -len("_imputed")]
        elif "_enc_" in name:
            name = name[: name.index("_enc_")]
        elif name.endswith("_enc"):
            name = name[: -len("_enc")]
        names.append(name)
    return names


def feature_importances(model, transformed: DataFrame, vec: str = "raw_features",
                        top: int | None = K.TOP_IMPORTANCES) -> DataFrame:
    """``feature, importance`` per source column (one-hot slots summed), sorted
    descending with the name as tie-break, top ``top`` rows (#36, #52)."""
    sources = slot_sources(transformed, vec)
    imp = model.featureImportances.toArray()
    total: dict[str, float] = {}
    for name, v in zip(sources, imp):
        total[name] = total.get(name, 0.0) + float(v)
    spark = transformed.sparkSession
    out = spark.createDataFrame(sorted(total.items()), "feature string, importance double")
    out = out.orderBy(F.desc("importance"), "feature")
    return out.limit(top) if top else out


def compare_models(train: DataFrame, test: DataFrame, *, experiment: str, variant: str,
                   k: int | None = None, models=MULTICLASS + ("GBT",), weight: str | None = None,
                   target: str = K.TARGET, params: dict | None = None,
                   train_rows: int | None = None, test_rows: int | None = None,
                   fitted: dict | None = None) -> list[tuple]:
    """Fit, score and evaluate each model; one report row per model (#53).
    Row counts are taken here unless given; ``fitted`` (a dict) receives each
    model and its predictions, so nothing has to be fitted again for details.
    ``seconds`` covers fit + score + evaluation.  GBT trains on the binary
    target and is scored with the same (support-weighted) F1."""
    params = params or {}
    rows = []
    train_rows = train.count() if train_rows is None else train_rows
    test_rows = test.count() if test_rows is None else test_rows
    for name in models:
        t0 = time.time()
        if name == "GBT":
            est = classifier("GBT", label="binary_label", **params.get(name, {}))
            model, pred = fit_score(est, with_binary_label(train, target), with_binary_label(test, target))
            acc, f1 = evaluate(pred, "binary_label")
        else:
            est = classifier(name, weight=weight, **params.get(name, {}))
            model, pred = fit_score(est, train, test)
            acc, f1 = evaluate(pred)
        if fitted is not None:
            fitted[name] = (model, pred)
        rows.append((experiment, variant, k, name, train_rows, test_rows, acc, f1, time.time() - t0))
    return rows
