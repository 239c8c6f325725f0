"""Classifier experiments (#55-#58, #60), returning report tables as DataFrames.

The feature table is materialised once in the shared checkpoint folder before
the pipeline fit: each estimator fit is a separate pass, and these passes then
read the columnar copy instead of re-running the feature job.  Train and test
parts are persisted around the repeated model fits and released in
``finally``.  The default split hashes the row key, so a recomputed partition
lands in the same part; ``split='random'`` draws the part once (seed 42) and
writes it.
"""

from __future__ import annotations

import functools
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorSlicer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..operators.clean import available_features, non_empty_columns, numeric_as_double
from ..operators.metrics import confusion_wide, per_class_metrics
from ..operators.models import (COMPARISON_SCHEMA, MULTICLASS, compare_models,
                                feature_importances)
from ..operators.split import train_flag
from ..operators.stages import feature_stages, fitted_labels, pca_fit, scaler
from ..operators.weights import attach_class_weights
from ..session import discard, materialize, scratch


@dataclass
class Report:
    comparison: DataFrame
    tables: dict[str, DataFrame] = field(default_factory=dict)


def prepare(features: DataFrame, cats=None, nums=None, persist: bool = True):
    """Available model inputs, numerics cast to double, materialised (#8).
    Numeric columns without a single value are dropped (the imputer has no
    mean for them)."""
    cats, nums = available_features(features, cats, nums)
    df = numeric_as_double(features, nums)
    df = materialize(df, "model-input") if persist else df
    return df, cats, non_empty_columns(df, nums)


PART = "__train"


def with_part(df: DataFrame, split: str, key: str) -> DataFrame:
    """Add the row's part (``PART``: True for training) once; stages, PCA and
    models all use this column, so no part can differ between them.
    ``split='hash'`` hashes the key; ``split='random'`` draws a seeded number
    per row and writes it, so that it is never drawn again."""
    if split == "hash":
        return df.withColumn(PART, train_flag(df, key))
    if split != "random":
        raise ValueError("split must be 'hash' or 'random'")
    return materialize(df.withColumn(PART, F.rand(K.SEED) < F.lit(K.TRAIN_FRACTION)), "parts")


def _rows_to_fit(df: DataFrame, fit_on: str) -> DataFrame:
    if fit_on not in ("all", "train"):
        raise ValueError("fit_on must be 'all' or 'train'")
    return df if fit_on == "all" else df.where(PART)


#: Rows of a fit partition: a task of a fit reads this much of the fit's own copy of the rows.
FIT_ROWS = 250_000


def _parts(data: DataFrame, key: str, fit_partitions: int | None, fit_rows: int = FIT_ROWS):
    """Train and test rows.  Iterative fits run by partition and seeded tree
    fits depend on it: ``fit_partitions`` fixes the number of partitions (and
    the order of rows in them) whatever the cluster.  More than ``fit_rows`` rows
    for each of them get one partition per ``fit_rows``, so that no task grows
    with the table.  By default the scan's splits are left alone."""
    if fit_partitions:
        partitions = max(fit_partitions, -(-data.count() // fit_rows))
        data = data.repartition(partitions, key).sortWithinPartitions(key)
    return data.where(PART).drop(PART), data.where(~F.col(PART)).drop(PART)


def model_columns(df: DataFrame, key: str = K.ID_COLUMN, features: str = "features") -> DataFrame:
    """Only what the fits read: key, label, target (for the binary label) and
    the feature vector; cached parts then hold no intermediate columns."""
    return df.select(*[c for c in (key, "label", K.TARGET, features, PART) if c in df.columns])


def _fit_transform(pipeline, df: DataFrame, split: str, key: str, fit_on: str, fit_partitions: int | None = None):
    """Split once, fit the feature stages, transform.

    ``fit_on='all'`` fits on every row (the source job's behaviour);
    ``fit_on='train'`` fits imputer, indexers and scaler on the training part
    only, so no test statistics leak into the features.  The assembled model
    columns are written once to the shared checkpoint folder: the last stage
    (scaling) and every later fit pass (tree metadata, split finding,
    iterations) read that copy instead of re-running the transforms."""
    df = with_part(df, split, key)
    *common, last = pipeline.getStages()
    assembled = Pipeline(stages=common).fit(_rows_to_fit(df, fit_on))
    raw = materialize(model_columns(assembled.transform(df), key, "raw_features"), "raw-features")
    scaled = Pipeline(stages=[last]).fit(_rows_to_fit(raw, fit_on))
    model = PipelineModel(stages=assembled.stages + scaled.stages)
    train, test = _parts(model_columns(scaled.transform(raw), key), key, fit_partitions)
    return model, model.transform(df), train, test


@contextmanager
def persisted(*dfs: DataFrame):
    """Cache around repeated fits; released even when a fit fails (#60).  On disk:
    each fit keeps its own form of the rows in memory and needs the room."""
    for d in dfs:
        d.persist(StorageLevel.DISK_ONLY)
    try:
        yield dfs
    finally:
        for d in dfs:
            d.unpersist()


def _report(spark: SparkSession, rows: list[tuple], tables=None) -> Report:
    return Report(spark.createDataFrame(rows, COMPARISON_SCHEMA), tables or {})


def _cleaned(experiment):
    """Only the report's tables outlive an experiment, not its intermediate copies."""
    @functools.wraps(experiment)
    def run(df: DataFrame, *args, **options) -> Report:
        with scratch(df.sparkSession) as own:
            report = experiment(df, *args, **options)
            for table in (report.comparison, *report.tables.values()):
                own.keep(table)
        return report
    return run


@_cleaned
def class_weight_experiment(df: DataFrame, cats: list[str], nums: list[str], *, split: str = "hash",
                            key: str = K.ID_COLUMN, params: dict | None = None,
                            fit_on: str = "all", fit_partitions: int | None = None) -> Report:
    """Baseline RF / DT / LR, RF details (confusion, per-class metrics,
    importances) from the same forest and its predictions, written once, then
    the same models trained with balanced class weights computed on the
    training part; the test part stays unweighted (#55).  Six fits."""
    spark = df.sparkSession
    stages = feature_stages(cats, nums, label_order="alphabetAsc", handle_invalid="keep")
    model, data, train, test = _fit_transform(stages, df, split, key, fit_on, fit_partitions)
    labels = fitted_labels(model)
    with persisted(train, test):
        n_train, n_test = train.count(), test.count()
        common = dict(experiment="class_weight", train_rows=n_train, test_rows=n_test, params=params)
        fitted: dict = {}
        rows = compare_models(train, test, variant="baseline", models=MULTICLASS, fitted=fitted, **common)
        forest, pred = fitted["RandomForest"]
        pred = materialize(pred.select("label", "prediction"), "forest-predictions")
        tables = {
            "confusion": confusion_wide(pred, labels),
            "per_class": per_class_metrics(pred, labels),
            "importances": feature_importances(forest, data),
        }
        weighted = attach_class_weights(train, max_classes=len(labels) + 1)
        with persisted(weighted):
            rows += compare_models(weighted, test, variant="weighted", models=MULTICLASS,
                                   weight="weight", **common)
        tables = {k: materialize(v, f"report-{k}") for k, v in tables.items()}
    return _report(spark, rows, tables)


def _scaled_base(df: DataFrame, cats: list[str], nums: list[str], split: str, key: str, fit_on: str,
                 keep_raw: bool = True):
    """Rows with ``raw_features`` (if kept) and ``scaled_features``, written once:
    all common stages are fitted a single time."""
    df = with_part(df, split, key)
    common = Pipeline(stages=feature_stages(cats, nums).getStages()[:-1]).fit(_rows_to_fit(df, fit_on))
    raw = materialize(common.transform(df).select(*[c for c in (key, "label", K.TARGET, PART, "raw_features") if c in df.columns
                                                    or c in ("label", "raw_features")]), "raw-features")
    scale = scaler("raw_features", "scaled_features").fit(_rows_to_fit(raw, fit_on))
    scaled = scale.transform(raw)
    base = materialize(scaled if keep_raw else scaled.drop("raw_features"), "scaled-features")
    discard(raw)
    return base


@_cleaned
def scaling_experiment(df: DataFrame, cats: list[str], nums: list[str], *, split: str = "hash",
                       key: str = K.ID_COLUMN, params: dict | None = None,
                       fit_on: str = "all", fit_partitions: int | None = None) -> Report:
    """All four models with and without standard scaling (#56).  Both arms share
    the imputer, indexers, encoder and assembler; only the scaler differs."""
    rows = []
    base = _scaled_base(df, cats, nums, split, key, fit_on)
    for variant, vector in (("scaled", "scaled_features"), ("unscaled", "raw_features")):
        data = model_columns(base.withColumnRenamed(vector, "features"), key)
        train, test = _parts(data, key, fit_partitions)
        with persisted(train, test):
            rows += compare_models(train, test, experiment="scaling", variant=variant, params=params)
    return _report(df.sparkSession, rows)


@_cleaned
def pca_experiment(df: DataFrame, cats: list[str], nums: list[str], *, ks=K.PCA_KS,
                   split: str = "hash", key: str = K.ID_COLUMN, params: dict | None = None,
                   fit_on: str = "all", fit_partitions: int | None = None) -> Report:
    """PCA on the scaled features for each k, all four models per k (#57).

    PCA is fitted once at the largest k: principal components and explained
    variances at a smaller k are the leading entries of those at the largest,
    so each k slices the projection instead of refitting.  Stages, PCA and
    models use the same parts, dealt and cached once for every k, and PCA reads
    the written base.  The scaled rows are dealt and then projected: they are
    sparse and repeat values, while a projection is ``max(ks)`` doubles a row that
    no codec shrinks, so it is kept once, in the cached parts."""
    spark = df.sparkSession
    base = _scaled_base(df, cats, nums, split, key, fit_on, keep_raw=False)
    kmax = max(ks)
    first = base.select("scaled_features").first()
    size = first[0].size if first else None
    if size is not None and kmax > size:
        raise ValueError(f"PCA k={kmax} exceeds the {size} feature slots")
    pca = pca_fit(_rows_to_fit(base, fit_on), kmax, out="pca_all")
    variance = [float(v) for v in pca.explainedVariance.toArray()]
    rows, var_rows = [], []
    parts = [model_columns(pca.transform(p), key, "pca_all")
             for p in _parts(model_columns(base, key, "scaled_features"), key, fit_partitions)]
    with persisted(*parts):
        n_train, n_test = (p.count() for p in parts)
        for k in ks:
            var_rows.append((k, sum(variance[:k])))
            leading = VectorSlicer(inputCol="pca_all", outputCol="features", indices=list(range(k)))
            train, test = (leading.transform(p).drop("pca_all") for p in parts)
            rows += compare_models(train, test, experiment="pca", variant="pca", k=k, params=params,
                                   train_rows=n_train, test_rows=n_test)
    var_df = spark.createDataFrame(var_rows, "k int, explained_variance double")
    return _report(spark, rows, {"pca_variance": var_df})


EXPERIMENTS = {"class_weight": class_weight_experiment, "scaling": scaling_experiment,
               "pca": pca_experiment}


@_cleaned
def run_experiment(features: DataFrame, name: str, **opts) -> Report:
    """Choose an experiment by name (#58)."""
    df, cats, nums = prepare(features)
    return EXPERIMENTS[name](df, cats, nums, **opts)
