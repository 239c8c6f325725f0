import pytest
from pyspark.sql import functions as F

from sparkfeat import constants as K
from sparkfeat.plans import cli
from sparkfeat.plans.features import apply_feature_stats, engineer_features, fit_feature_stats
from sparkfeat.session import scratch_path
from sparkfeat.sources.adapter import incidents
from sparkfeat.streaming import stream_features

from .conftest import SF_SMOKE


@pytest.fixture(scope="module")
def raw_path(spark):
    path = scratch_path(spark, "test-incidents")
    incidents(spark, SF_SMOKE).write.parquet(path)
    return path


def _rows(df):
    return sorted(tuple(r) for r in df.select(*K.FINAL_FEATURES).collect())


def test_stream_equals_batch(spark, raw_path):
    raw = spark.read.parquet(raw_path)
    stats = fit_feature_stats(raw)
    sink = scratch_path(spark, "test-sink")
    q = stream_features(spark, raw_path, raw.schema, stats, sink)
    q.awaitTermination()
    assert _rows(spark.read.parquet(sink)) == _rows(engineer_features(raw))


def test_apply_to_unseen_rows(spark, raw_path):
    raw = spark.read.parquet(raw_path)
    fit_part = raw.where(F.col("FOD_ID") % 2 == 0)
    stats = fit_feature_stats(fit_part)
    out = apply_feature_stats(raw, stats)
    assert out.count() == engineer_features(raw).count()
    # bins come from the fitted part; rows outside its range have no bin and density 0
    bad = out.where(F.col("lat_bin").isNull() & (F.col("location_fire_density") != 0)).count()
    assert bad == 0


def test_cli_experiment_fit_on_train(spark, raw_path):
    feats = scratch_path(spark, "test-features")
    engineer_features(spark.read.parquet(raw_path)).write.parquet(feats)
    out = scratch_path(spark, "test-report")
    args = cli.parse_args(["--dataset_directory", feats, "--experiment", "class_weight",
                           "--fit_on", "train", "--output", out])
    tables = cli.run(spark, args, params={"LogisticRegression": {"maxIter": 10},
                                          "RandomForest": {"numTrees": 5}})
    comp = tables["comparison"].collect()
    assert [(r["variant"], r["model"]) for r in comp] == [
        ("baseline", "RandomForest"), ("baseline", "DecisionTree"), ("baseline", "LogisticRegression"),
        ("weighted", "RandomForest"), ("weighted", "DecisionTree"), ("weighted", "LogisticRegression")]
    assert all(0.0 <= r["accuracy"] <= 1.0 for r in comp)
    assert tables["confusion"].count() == 7
    assert tables["importances"].count() <= K.TOP_IMPORTANCES
    assert spark.read.parquet(f"{out}/class_weight/comparison").count() == 6


def test_stats_save_load_roundtrip(spark, raw_path):
    from sparkfeat.plans.features import load_feature_stats, save_feature_stats

    raw = spark.read.parquet(raw_path)
    stats = fit_feature_stats(raw)
    path = save_feature_stats(stats, scratch_path(spark, "test-stats"))
    again = load_feature_stats(spark, path)
    assert again.edges == stats.edges and again.profile.count_rows == stats.profile.count_rows
    assert _rows(apply_feature_stats(raw, again)) == _rows(apply_feature_stats(raw, stats))


def test_features_fit_on_train(spark, raw_path):
    from sparkfeat.operators.split import is_train
    from sparkfeat.plans.features import features_fit_on_train

    raw = spark.read.parquet(raw_path)
    out = features_fit_on_train(raw)
    assert out.count() == engineer_features(raw).count()
    train_rows = engineer_features(raw).where(is_train(F.col("FOD_ID"))).count()
    # state frequencies count training rows only, so they sum (per row) to at most the train size
    top = out.where(is_train(F.col("FOD_ID"))).agg(F.max("state_fire_frequency")).first()[0]
    assert top <= train_rows


def test_feature_job_cli_csv(spark, raw_path):
    out = scratch_path(spark, "test-features-csv")
    args = cli.parse_feature_args(["--input", raw_path, "--output", out, "--output_format", "csv"])
    cli.run_features(spark, args)
    back = spark.read.option("header", True).option("inferSchema", True).csv(out)
    assert back.count() == engineer_features(spark.read.parquet(raw_path)).count()
    assert set(back.columns) == set(K.FINAL_FEATURES)


def test_feature_job_from_csv_text_matches_parquet(spark, raw_path):
    csv_in = scratch_path(spark, "test-incidents-csv")
    spark.read.parquet(raw_path).write.option("header", True).csv(csv_in)
    out = scratch_path(spark, "test-features-from-csv")
    cli.run_features(spark, cli.parse_feature_args(["--input", csv_in, "--input_format", "csv",
                                                    "--output", out]))
    got = spark.read.parquet(out)
    want = engineer_features(spark.read.parquet(raw_path))
    assert _rows(got) == _rows(want)


def test_stream_restart_processes_only_new_files(spark, raw_path):
    raw = spark.read.parquet(raw_path)
    stats = fit_feature_stats(raw)
    source = scratch_path(spark, "test-stream-src")
    first = raw.where(F.col("FOD_ID") % 2 == 0)
    second = raw.where(F.col("FOD_ID") % 2 == 1)
    first.write.parquet(f"{source}/part=1")
    sink, ckpt = scratch_path(spark, "test-stream-out"), scratch_path(spark, "test-stream-ckpt")
    src_glob = f"{source}/*"
    stream_features(spark, src_glob, raw.schema, stats, sink, ckpt).awaitTermination()
    n1 = spark.read.parquet(sink).count()
    second.write.parquet(f"{source}/part=2")
    stream_features(spark, src_glob, raw.schema, stats, sink, ckpt).awaitTermination()
    out = spark.read.parquet(sink)
    assert n1 == apply_feature_stats(first, stats).count() > 0
    # every feature row exactly once after the restart, values from the fitted statistics
    assert out.count() == apply_feature_stats(raw, stats).count()
    assert out.select("FOD_ID").distinct().count() == out.count()
    assert _rows(out) == _rows(apply_feature_stats(raw, stats))


def test_feature_job_on_empty_input(spark, raw_path):
    raw = spark.read.parquet(raw_path).where(F.lit(False))
    out = engineer_features(raw)
    assert out.columns == K.FINAL_FEATURES
    assert out.count() == 0
