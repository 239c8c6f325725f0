"""Plan-level checks: pushdown, pruning and no shuffle of the large table."""

import pytest

from sparkfeat.plans.features import engineer_features
from sparkfeat.session import scratch_path
from sparkfeat.sources.adapter import incidents
from sparkfeat.sources.incidents import read_incidents

from .conftest import SF_SMOKE


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def incident_file(spark):
    path = scratch_path(spark, "plan-incidents")
    incidents(spark, SF_SMOKE).write.parquet(path)
    return path


def test_scan_pushes_not_null_and_prunes(spark, incident_file):
    df = read_incidents(spark, incident_file).select("FOD_ID", "STATE")
    plan = _plan(df)
    for c in ("FIRE_SIZE", "LATITUDE", "LONGITUDE", "FIRE_SIZE_CLASS"):
        assert f"IsNotNull({c})" in plan
    schema = plan[plan.index("ReadSchema:"):].split("\n")[0]
    # only the projected columns plus the filter columns are read
    assert "COUNTY" not in schema and "DISCOVERY_TIME" not in schema


def test_feature_job_broadcasts_every_lookup(spark, incident_file):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        raw = spark.read.parquet(incident_file)
        plan = _plan(engineer_features(raw))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("BroadcastHashJoin") == 5
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    # the only exchanges are the broadcasts of the small lookups
    assert "Exchange hashpartitioning" not in plan
