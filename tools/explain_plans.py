"""Write the physical plans of the key queries to PLANS.md (AQE off, so the
static plan is shown).

usage: python tools/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from sparkfeat.operators.frequency import frequency_encode
    from sparkfeat.operators.metrics import accuracy_f1, per_class_metrics
    from sparkfeat.plans.catalog import rule_predictions
    from sparkfeat.plans.features import engineer_features
    from sparkfeat.session import scratch_path
    from sparkfeat.sources.adapter import incidents
    from sparkfeat.sources.incidents import read_incidents

    path = scratch_path(spark, "plans-incidents")
    incidents(spark, sf_dir).write.parquet(path)
    spark.conf.set("spark.sql.adaptive.enabled", "false")

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    raw = spark.read.parquet(path)
    pred, labels = rule_predictions(spark, sf_dir)
    skew = raw.select("FOD_ID", F.coalesce("STATE", F.lit("Unknown")).alias("STATE"))
    # A large cold side would exceed Spark's own broadcast threshold; show that plan.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    salted = plan(frequency_encode(skew, {"STATE": "state_fire_frequency"}, max_broadcast_rows=3))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    sections = [
        ("Incident scan: pushed not-null filters, pruned read schema",
         plan(read_incidents(spark, path).select("FOD_ID", "STATE"))),
        ("Feature job output query over a parquet incident table (lookups materialised, all broadcast)",
         plan(engineer_features(raw))),
        ("Frequency encoding beyond the broadcast budget: hot keys broadcast, cold keys shuffled on "
         "the struct (key, salt) (auto-broadcast off, as for a large cold side)", salted),
        ("Per-class metrics: K x K confusion counts, one pass", plan(per_class_metrics(pred, labels))),
        ("Accuracy and weighted F1", plan(accuracy_f1(pred))),
    ]
    out = ["# Physical plans of the key queries", "",
           f"Generated by `tools/explain_plans.py` on `{sf_dir}` (adaptive execution off, so the static "
           "plan is shown). File locations are local scratch folders.", ""]
    for title, text in sections:
        out += [f"## {title}", "", "```", text.strip(), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
