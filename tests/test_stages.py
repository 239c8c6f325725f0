import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from sparkfeat.operators import stages as S
from sparkfeat.operators.split import hash_split


def test_category_index_keep_and_one_hot(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(["b", "a", "b", None, "c"])], "i long, c string")
    idx = S.category_indexer(["c"]).fit(df).transform(df)
    assert [r["c_idx"] for r in idx.orderBy("i").collect()] == [0.0, 1.0, 0.0, 3.0, 2.0]
    enc = S.one_hot(["c"]).fit(idx).transform(idx)
    null_row = enc.where(F.col("c").isNull()).first()
    assert null_row["c_enc"] == Vectors.sparse(3, [], [])


def test_mean_imputation_null_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,), (float("nan"),), (4.0,)], "x double")
    out = [r["x_imputed"] for r in S.imputer(["x"]).fit(df).transform(df).collect()]
    assert out[2] == pytest.approx(7 / 3) and out[3] == pytest.approx(7 / 3)


def test_label_orders(spark):
    df = spark.createDataFrame([(c,) for c in "BBBAAC"], "y string")
    freq = S.label_indexer("y").fit(df)
    alpha = S.label_indexer("y", order="alphabetAsc").fit(df)
    assert list(freq.labels) == ["B", "A", "C"] and list(alpha.labels) == ["A", "B", "C"]


def test_hash_split_is_stable_under_repartition(spark):
    df = spark.range(0, 5000).withColumnRenamed("id", "FOD_ID")
    a, _ = hash_split(df, "FOD_ID")
    b, _ = hash_split(df.repartition(13), "FOD_ID")
    ids_a = {r[0] for r in a.collect()}
    assert ids_a == {r[0] for r in b.collect()}
    assert 0.77 < len(ids_a) / 5000 < 0.83


def test_prepare_drops_all_null_numeric(spark):
    from sparkfeat.plans.experiments import prepare

    df = spark.createDataFrame([(1, "A", None, 2.0, "x"), (2, "B", None, float("nan"), "y")],
                               "FOD_ID long, FIRE_SIZE_CLASS string, FIPS_CODE string, LATITUDE double, season string")
    out, cats, nums = prepare(df)
    assert cats == ["season"] and nums == ["LATITUDE"]
    assert out.count() == 2
