"""Benchmark: the model steps of the reference's run, plus the feature job.

Runs at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]
feature pipeline fit + transform, RF / DT / LR fit + score + weighted F1,
binary GBT fit, PCA k=10 fit.  ``queries`` also holds the adapter build, the
feature-engineering job (written to the no-op sink) and the copy of the PCA
input, which the baseline does not time.

($BENCH_PROBE_DIR, by default sf0.01 beside the bench's tables, on 4 cores),
for a like-for-like ratio, and times the class-weight and scaling experiments
there ($BENCH_EXPERIMENTS names others, or none).
"""

from __future__ import annotations

import json
import os
import subprocess
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402


BASELINE = {"feature_stages": 11.9, "random_forest": 4.2, "decision_tree": 2.4, "logistic_regression": 17.5,
            "gbt_binary": 18.2, "pca_k10": 3.1}


def session(cpus: str) -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("sparkfeat-bench")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", cpus)
             .config("spark.driver.memory", "16g")
             .config("spark.sql.adaptive.enabled", "true").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir() and not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sparkfeat-bench-"))
    return spark


def steps(sf_dir: str, cpus: str, experiments=()) -> tuple[dict, int]:
    """Seconds of each step on a session of its own, and the rows of the feature table."""
    spark = session(cpus)

    from sparkfeat.operators import models as MD
    from sparkfeat.operators import stages as S
    from sparkfeat.operators.split import hash_split
    from sparkfeat.plans import experiments as X
    from sparkfeat.plans.features import engineer_features
    from sparkfeat.sources.adapter import incidents

    times = {}

    def timed(name, fn):
        t0 = time.time()
        out = fn()
        times[name] = round(time.time() - t0, 3)
        return out

    # Warm the JVM once (class loading, codegen caches) so the first step is not penalised.
    spark.read.parquet(f"{sf_dir}/region.parquet").count()

    # The test tables are TPC-H-like: the adapter joins them into incident
    # rows once (timed on its own); the feature job then scans that table as
    # it would scan a real incident table.
    raw = timed("adapter", lambda: X.materialize(incidents(spark, sf_dir), "bench-incidents"))

    def features():
        df = engineer_features(raw)
        df.write.format("noop").mode("overwrite").save()
        return df

    feats = timed("feature_job", features)
    df, cats, nums = X.prepare(feats)
    n_rows = df.count()

    def fit_stages():
        model = S.feature_stages(cats, nums).fit(df)
        data = model.transform(df)
        return X.materialize(data.select("FOD_ID", "FIRE_SIZE_CLASS", "label", "features"), "bench-data")

    data = timed("feature_stages", fit_stages)
    train, test = hash_split(data.repartition(int(cpus), "FOD_ID"), "FOD_ID")
    train.persist(), test.persist()
    train.count(), test.count()

    for name, key in (("RandomForest", "random_forest"), ("DecisionTree", "decision_tree"),
                      ("LogisticRegression", "logistic_regression")):
        timed(key, lambda n=name: MD.evaluate(MD.fit_score(MD.classifier(n), train, test)[1]))
    timed("gbt_binary", lambda: MD.classifier("GBT", label="binary_label").fit(MD.with_binary_label(train)))

    from pyspark.ml import Pipeline
    scaled = Pipeline(stages=S.feature_stages(cats, nums).getStages()[:-1]
                        + [S.scaler("raw_features", "scaled_features")]).fit(df).transform(df)
    pca_base = timed("pca_base", lambda: X.materialize(scaled.select("scaled_features"), "bench-pca"))
    timed("pca_k10", lambda: S.pca_fit(pca_base, 10))

    for name in experiments:
        timed(f"exp_{name}", lambda n=name: X.run_experiment(feats, n).comparison.collect())
    spark.stop()
    return times, n_rows


def headline(times: dict) -> float:
    return round(sum(times[k] for k in BASELINE), 3)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    probe_dir = os.environ.get("BENCH_PROBE_DIR", os.path.join(os.path.dirname(sf_dir), "sf0.01"))
    experiments = [e for e in os.environ.get("BENCH_EXPERIMENTS", "class_weight,scaling").split(",") if e]

    times, n_rows = steps(sf_dir, cpus)
    out = {"metric": "baseline_steps_seconds", "value": headline(times), "unit": "sec",
           "queries": times, "sf": os.path.basename(sf_dir).removeprefix("sf"),
           "all_steps_seconds": round(sum(times.values()), 3), "rows": n_rows, "cpus": int(cpus)}
    if os.path.isdir(probe_dir):
        # A process of its own, as a warm JVM would flatter the probe.
        done = subprocess.run([sys.executable, os.path.abspath(__file__), "--probe", probe_dir, *experiments],
                              stdout=subprocess.PIPE, text=True, check=True)
        probe, rows = json.loads(done.stdout.splitlines()[-1])
        out["probe"] = {"value": headline(probe), "ratio_to_baseline": round(headline(probe) / sum(BASELINE.values()), 3),
                        "queries": probe, "rows": rows, "cpus": 4}
    print(json.dumps(out))


if __name__ == "__main__":
    if sys.argv[1:2] == ["--probe"]:
        print(json.dumps(steps(sys.argv[2], "4", sys.argv[3:])))
    else:
        main()
