"""Lost rows, leaks, bounds and edge values."""

import pytest
from pyspark.sql import functions as F

from sparkfeat.functions.rules import region_of
from sparkfeat.operators import models as MD
from sparkfeat.operators.frequency import attach_counts
from sparkfeat.operators.lookup import join_lookup
from sparkfeat.operators.metrics import confusion_wide, per_class_metrics
from sparkfeat.operators.profile import profile
from sparkfeat.operators.split import hash_split
from sparkfeat.operators.weights import balanced_weights
from sparkfeat.plans import experiments as X


def test_split_keeps_null_keys(spark):
    df = spark.createDataFrame([(i if i % 4 else None, f"v{i}") for i in range(400)], "k long, v string")
    train, test = hash_split(df, "k")
    assert sorted(train.unionByName(test).toPandas()["v"]) == sorted(f"v{i}" for i in range(400))
    assert 0 < test.where("k is null").count() < 100


def test_confusion_rows_add_up(spark):
    pred = spark.createDataFrame([(0.0, 0.0), (0.0, 7.0), (1.0, 1.0), (1.0, 0.0)], "label double, prediction double")
    wide = confusion_wide(pred, ["A", "B"])
    assert wide.columns == ["label", "A", "B", "N/A"]
    assert {r["label"]: (r["A"], r["B"], r["N/A"]) for r in wide.collect()} == {"A": (1, 0, 1), "B": (1, 1, 0)}
    assert per_class_metrics(pred, ["A", "B"]).count() == 2


def test_class_weights_do_not_gather(spark):
    df = spark.createDataFrame([(f"c{i % 5}",) for i in range(100)], "label string")
    w = balanced_weights(df)
    plan = w._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    assert {r["weight"] for r in w.collect()} == {1.0}


def test_region_of_nan(spark):
    row = spark.createDataFrame([(float("nan"), -125.0)], "lat double, lon double").select(
        region_of(F.col("lat"), F.col("lon")).alias("r")).first()
    assert row["r"] == "SW"


def test_empty_test_part(spark):
    pred = spark.createDataFrame([], "label double, prediction double")
    assert MD.evaluate(pred) == (None, None)


def test_key_bytes_are_bytes(spark):
    df = spark.createDataFrame([("漢" * 100,)], "k string")
    assert profile(df, ["k"]).key_bytes["k"] == 300


@pytest.fixture
def plain_shuffles(spark):
    saved = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    for k, v in saved.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("hot", ["seen", None, "unseen"])
def test_lookup_spreads_any_hot_key(spark, plain_shuffles, hot):
    """Key-only rows: half on one key, all null half, or a value the lookup lacks."""
    rows = [(hot,) if i % 2 else (f"k{i % 300}",) for i in range(8000)]
    df = spark.createDataFrame(rows, "k string").repartition(8)
    lookup = spark.createDataFrame([(f"k{i}", i) for i in range(300)] + [("seen", -1)], "k string, v long")
    out = join_lookup(df, lookup, ["k"], ["v"], max_broadcast_rows=10)
    sizes = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(sizes) == 8000 and max(sizes) <= 0.3 * 8000, sizes  # a gathered hot key would be half
    want = {f"k{i}": i for i in range(300)} | {"seen": -1}
    assert all(r["v"] == want.get(r["k"]) for r in out.collect())


def test_lookups_share_one_budget(spark, monkeypatch):
    from sparkfeat.operators import frequency

    df = spark.createDataFrame([(f"a{i % 9}", f"b{i % 9}") for i in range(300)], "a string, b string")
    prof = profile(df, ["a", "b"])
    monkeypatch.setattr(frequency, "MAX_BROADCAST_BYTES", 9 * 66 + 10)  # room for one of them
    plan = attach_counts(df, prof, {"a": "fa", "b": "fb"})._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("__jk") > 0
    assert {(r["fa"], r["fb"]) for r in attach_counts(df, prof, {"a": "fa", "b": "fb"}).collect()} == {(34, 34), (33, 33)}


@pytest.mark.parametrize("split", ["hash", "random"])
@pytest.mark.parametrize("fit_on", ["all", "train"])
def test_parts_are_split_once(spark, monkeypatch, split, fit_on):
    """No test key is ever in rows that stages, PCA or models are fitted on."""
    fitted, scored = [], []
    rows = [(i, "AC"[i % 3 == 0], float(i % 7), float(i % 5), "uv"[i % 2]) for i in range(300)]
    df = spark.createDataFrame(rows, "FOD_ID long, FIRE_SIZE_CLASS string, x double, y double, c string")

    def note(train, test, **options):
        fitted.append({r[0] for r in train.select("FOD_ID").collect()})
        scored.append({r[0] for r in test.select("FOD_ID").collect()})
        return [("e", "v", None, "m", len(fitted[-1]), len(scored[-1]), 0.5, 0.5, 0.1)]

    stage_rows = []
    real = X._rows_to_fit
    monkeypatch.setattr(X, "_rows_to_fit", lambda d, f: stage_rows.append({r[0] for r in d.where(X.PART).select("FOD_ID").collect()}) or real(d, f))
    monkeypatch.setattr(X, "compare_models", note)
    X.pca_experiment(df, ["c"], ["x", "y"], ks=(1, 2), split=split, fit_on=fit_on)
    X.scaling_experiment(df, ["c"], ["x", "y"], split=split, fit_on=fit_on)
    for train, test in zip(fitted, scored):
        assert not train & test and len(train | test) == 300
    assert all(part == train for part, train in zip(stage_rows[:3], [fitted[0]] * 3))


def test_fit_partitions_grow_with_the_rows(spark):
    df = spark.range(1000).select(F.col("id").alias("FOD_ID"), (F.col("id") % 5 < 4).alias(X.PART))
    for rows, partitions in ((1000, 4), (250, 4), (100, 10)):
        train, test = X._parts(df, "FOD_ID", 4, rows)
        assert train.rdd.getNumPartitions() == test.rdd.getNumPartitions() == partitions
        assert (train.count(), test.count()) == (800, 200)
        assert all(part == sorted(part) for part in train.rdd.map(lambda r: r[0]).glom().collect())


def test_last_stage_is_fitted_on_the_written_rows(spark, monkeypatch):
    """Indexers, encoder and assembler run once over the table, with the same
    model and rows as the whole pipeline."""
    from sparkfeat.operators.stages import feature_stages

    rows = [(i, "ABC"[i % 3], float(i % 7), float(i % 5), "uvw"[i % 3]) for i in range(300)]
    df = spark.createDataFrame(rows, "FOD_ID long, FIRE_SIZE_CLASS string, x double, y double, c string")
    written = []
    real = X.materialize
    monkeypatch.setattr(X, "materialize", lambda d, name: written.append(d.columns) or real(d, name))
    for scaling in (True, False):
        stages = feature_stages(["c"], ["x", "y"], scaling=scaling)
        model, data, train, test = X._fit_transform(stages, df, "hash", "FOD_ID", "all", 2)
        whole = {r["FOD_ID"]: r["features"] for r in stages.fit(df).transform(df).collect()}
        assert {r["FOD_ID"]: r["features"] for r in train.unionByName(test).collect()} == whole
        assert {r["FOD_ID"]: r["features"] for r in data.collect()} == whole and len(model.stages) == 6
        # The scaler's fit and the parts read the assembled vectors, not the transforms.
        assert written[-1] == ["FOD_ID", "label", "FIRE_SIZE_CLASS", "raw_features", X.PART]


def test_repeated_fits_share_cached_parts(spark, monkeypatch):
    """Several fits read parts that were dealt and sorted once, and cached on disk."""
    from sparkfeat.plans import catalog as C
    from tests.conftest import SF_SMOKE

    seen, dealt = [], []
    def note(train, test, **options):
        seen.extend((d.storageLevel.useDisk, d.storageLevel.useMemory) for d in (train, test))
        return []
    monkeypatch.setattr(C.MD, "compare_models", note)
    C.QUERIES["model_weighted"](spark, SF_SMOKE)
    C.QUERIES["compare_models"](spark, SF_SMOKE)
    assert len(seen) >= 4 and seen[:2] == [(True, False)] * 2 and seen[-2:] == [(True, False)] * 2

    real = X._parts
    monkeypatch.setattr(X, "_parts", lambda *a: dealt.append(real(*a)) or dealt[-1])
    monkeypatch.setattr(X, "compare_models", lambda train, test, **options: [("e", "v", options["k"], "m", options["train_rows"], options["test_rows"], 0.5, 0.5, 0.1)])
    rows = [(i, "AC"[i % 3 == 0], float(i % 7), float(i % 5), "uv"[i % 2]) for i in range(100)]
    df = spark.createDataFrame(rows, "FOD_ID long, FIRE_SIZE_CLASS string, x double, y double, c string")
    report = X.pca_experiment(df, ["c"], ["x", "y"], ks=(1, 2)).comparison.collect()
    assert len(dealt) == 1 and [r["k"] for r in report] == [1, 2] and all(r["train_rows"] + r["test_rows"] == 100 for r in report)


def test_comparison_has_row_counts(spark):
    df = spark.createDataFrame([(i, float(i % 2), "AC"[i % 2]) for i in range(60)], "FOD_ID long, label double, FIRE_SIZE_CLASS string")
    from pyspark.ml.feature import VectorAssembler

    data = VectorAssembler(inputCols=["label"], outputCol="features").transform(df)
    train, test = hash_split(data, "FOD_ID")
    fitted = {}
    row = MD.compare_models(train, test, experiment="e", variant="v", models=("DecisionTree",), fitted=fitted)[0]
    assert (row[4], row[5]) == (train.count(), test.count()) and "DecisionTree" in fitted


def test_date_formats_in_order(spark):
    from sparkfeat.functions.temporal import lenient_timestamp
    from pyspark.sql.types import StringType

    df = spark.createDataFrame([("03/04/2005",), ("2005-04-03",), ("4 April",), (None,)], "d string")
    got = df.select(lenient_timestamp(F.col("d"), StringType(), ["MM/dd/yyyy", "yyyy-MM-dd"]).cast("string").alias("t")).collect()
    assert [r["t"] for r in got] == ["2005-03-04 00:00:00", "2005-04-03 00:00:00", None, None]


def _left_behind(spark):
    from pathlib import Path

    from sparkfeat.session import checkpoint_dir

    return {p.name for p in Path(checkpoint_dir(spark).removeprefix("file:")).glob("sparkfeat/*")}


def test_experiment_leaves_only_its_report(spark):
    rows = [(i, "AC"[i % 3 == 0], float(i % 7), float(i % 5), "uv"[i % 2]) for i in range(200)]
    df = spark.createDataFrame(rows, "FOD_ID long, FIRE_SIZE_CLASS string, x double, y double, c string")
    before = _left_behind(spark)
    quick = {"RandomForest": {"numTrees": 2}, "LogisticRegression": {"maxIter": 2}}
    report = X.class_weight_experiment(df, ["c"], ["x", "y"], params=quick)
    left = _left_behind(spark) - before
    assert left and all(name.startswith("report-") for name in left), left
    assert report.comparison.count() == 6 and all(t.count() for t in report.tables.values())


def test_scratch_is_removed_after_a_failure(spark):
    from sparkfeat.session import materialize, scratch

    before = _left_behind(spark)
    with pytest.raises(ValueError), scratch(spark):
        materialize(spark.range(3), "lost")
        raise ValueError
    assert _left_behind(spark) == before
