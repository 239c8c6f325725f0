"""Category index as a table, against StringIndexer and at a million values."""

import pytest
from pyspark.sql import functions as F

from sparkfeat.operators import stages as S
from sparkfeat.operators.category import category_table, index_category
from sparkfeat.plans.catalog import _ml_input

from .conftest import SF_SMOKE


@pytest.mark.parametrize("limit", [1_000_000, 2])
def test_equals_string_indexer(spark, limit):
    df = _ml_input(spark, SF_SMOKE)
    for col in ("OWNER_DESCR", "NWCG_REPORTING_AGENCY", "STATE", "COUNTY", "FIPS_CODE"):
        theirs = S.category_indexer([col]).fit(df).transform(df).select("FOD_ID", f"{col}_idx")
        own = index_category(df, category_table(df, col), col, max_broadcast_rows=limit).select("FOD_ID", f"{col}_idx")
        assert sorted(map(tuple, own.collect())) == sorted(map(tuple, theirs.collect())), col


def test_ties_null_unseen_and_empty(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("c", 3), ("c", 4), (None, 5), ("", 6)], "c string, k int")
    table = category_table(df, "c")
    assert sorted((r["index"], r["c"], r["count"]) for r in table.collect()) == [
        (0, "c", 2), (1, "", 1), (2, "a", 1), (3, "b", 1)]
    new = spark.createDataFrame([("z", 7), (None, 8), ("a", 9)], "c string, k int")
    assert sorted((r["k"], r["c_idx"]) for r in index_category(new, table, "c").collect()) == [(7, 4.0), (8, 4.0), (9, 2.0)]
    none = category_table(df.where("false"), "c")
    assert none.collect() == []
    assert {r["c_idx"] for r in index_category(df, none, "c").collect()} == {0.0}


def test_a_million_values_and_a_hot_one(spark):
    n = 1_000_000
    df = spark.range(0, n + n // 2, 1, 8).select(
        "id", F.when(F.col("id") < n, F.concat(F.lit("v"), F.col("id"))).otherwise("v7").alias("c"))
    table = category_table(df, "c")
    row = table.agg(F.count("*").alias("n"), F.countDistinct("index").alias("d"), F.min("index").alias("lo"),
                    F.max("index").alias("hi")).first()
    assert tuple(row) == (n, n, 0, n - 1)
    assert table.where("c = 'v7'").first()["index"] == 0
    out = index_category(df, table, "c", max_broadcast_rows=1000)
    assert out.count() == n + n // 2
    assert out.where("c_idx = 0").count() == n // 2 + 1
    # In order: of two values with the same count, the smaller has the smaller index.
    assert [r["c"] for r in table.where("index BETWEEN 1 AND 3").orderBy("index").collect()] == ["v0", "v1", "v10"]
