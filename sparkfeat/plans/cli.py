"""spark-submit entry point (#58).

    spark-submit --py-files sparkfeat.zip run_experiment.py --dataset_directory DIR \
        --experiment {class_weight,scaling,pca} [--format parquet|csv] [--output DIR]

``DIR`` holds the feature table (parquet by default; CSV with a header is
read with schema inference).  Report tables are written under ``--output``
when given, else printed.
"""

from __future__ import annotations

import argparse

from ..session import build_session, checkpoint_dir
from ..sources.csv import read_csv
from ..sources.csv import write_csv
from ..sources.incidents import read_incidents
from .experiments import EXPERIMENTS, run_experiment
from .features import engineer_features, features_fit_on_train


def parse_args(argv=None):
    p = argparse.ArgumentParser(description="Run a classifier experiment on the feature table.")
    p.add_argument("--dataset_directory", required=True)
    p.add_argument("--experiment", required=True, choices=sorted(EXPERIMENTS))
    p.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    p.add_argument("--split", default="hash", choices=["hash", "random"])
    p.add_argument("--output", default=None)
    p.add_argument("--fit_on", default="all", choices=["all", "train"])
    return p.parse_args(argv)


def run(spark, a, **opts) -> dict:
    """Run the chosen experiment; write (or show) and return its tables."""
    checkpoint_dir(spark)
    features = (read_csv(spark, a.dataset_directory) if a.format == "csv"
                else spark.read.parquet(a.dataset_directory))
    report = run_experiment(features, a.experiment, split=a.split, fit_on=a.fit_on, **opts)
    tables = {"comparison": report.comparison, **report.tables}
    for name, df in tables.items():
        if a.output:
            df.write.mode("overwrite").parquet(f"{a.output}/{a.experiment}/{name}")
        else:
            df.show(max(1, df.count()), truncate=False)  # small tables: classes, models, slots
    return tables


def main(argv=None):
    a = parse_args(argv)
    spark = build_session("sparkfeat-experiments")
    try:
        run(spark, a)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()


def parse_feature_args(argv=None):
    p = argparse.ArgumentParser(description="Raw incidents -> feature table (#54).")
    p.add_argument("--input", required=True, help="incident table (folder or file)")
    p.add_argument("--input_format", default="parquet", help="any Spark source: parquet, csv, orc, json ...")
    p.add_argument("--output", required=True)
    p.add_argument("--output_format", default="parquet", choices=["parquet", "csv"])
    p.add_argument("--date_format", default=None, action="append",
                   help="format of text dates, e.g. yyyy-MM-dd; may be given several times, tried in order; infer: found in the data")
    p.add_argument("--date_unit", default=None, help="unit of numeric dates: julian, D, s, ms, us")
    p.add_argument("--fit_on", default="all", choices=["all", "train"])
    return p.parse_args(argv)


def run_features(spark, a) -> str:
    """Read incidents from any source, build the feature table, write it."""
    checkpoint_dir(spark)
    options = {"header": "true"} if a.input_format == "csv" else {}
    raw = read_incidents(spark, a.input, a.input_format, options=options)
    if a.fit_on == "train":
        out = features_fit_on_train(raw, date_format=a.date_format, date_unit=a.date_unit)
    else:
        out = engineer_features(raw, a.date_format, date_unit=a.date_unit)
    if a.output_format == "csv":
        return write_csv(out, a.output)
    out.write.mode("overwrite").parquet(a.output)
    return a.output


def features_main(argv=None):
    a = parse_feature_args(argv)
    spark = build_session("sparkfeat-features")
    try:
        run_features(spark, a)
    finally:
        spark.stop()
