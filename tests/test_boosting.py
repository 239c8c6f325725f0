"""Boosted trees on packed bins against the library's fit."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from sparkfeat.operators import boosting as B
from sparkfeat.operators import models as MD


@pytest.fixture(scope="module")
def rows(spark):
    """Continuous, repeated and two-valued (categorical) columns, all known to a key."""
    k = F.col("FOD_ID")
    df = spark.range(0, 3000, 1, 4).toDF("FOD_ID").select(
        "FOD_ID", ((k * 7919) % 3001).cast("double").alias("a"), (k * k % 13).cast("double").alias("b"),
        ((k * 31) % 7 / 3 - 1).alias("c"), (k % 3 == 0).cast("double").alias("d"),
        ((k * 7919) % 3001 + (k * k % 13) * 150 + (k * 104729) % 1500 > 2900).cast("double").alias("binary_label"))
    df = VectorAssembler(inputCols=["a", "b", "c", "d"], outputCol="features").transform(df)
    attrs = {"ml_attr": {"attrs": {"numeric": [{"idx": i, "name": n} for i, n in enumerate("abc")],
                                   "binary": [{"idx": 3, "name": "d"}]}, "num_attrs": 4}}
    return df.withColumn("features", F.col("features").alias("features", metadata=attrs))


def scored(model, df):
    out = model.transform(df).select("FOD_ID", "prediction", "probability").orderBy("FOD_ID").collect()
    return np.array([r["prediction"] for r in out]), np.array([r["probability"][1] for r in out])


def test_same_model_as_the_library(spark, rows, monkeypatch):
    options = dict(maxIter=4, maxDepth=4)
    library = GBTClassifier(labelCol="binary_label", seed=42, **options).fit(rows)
    monkeypatch.setattr(GBTClassifier, "_fit_java", lambda *_: pytest.fail("the library keeps rows as objects"))
    held = MD.classifier("GBT", label="binary_label", **options).fit(rows)
    monkeypatch.setattr(B, "HELD_BYTES", 0)
    written = MD.classifier("GBT", label="binary_label", **options).fit(rows.repartition(5))
    want, p_want = scored(library, rows)
    got, p_got = scored(held, rows)
    assert (want == got).all() and 0 < want.mean() < 1
    assert np.abs(p_want - p_got).max() < 1e-6
    assert [t.toDebugString.partition("\n")[2] for t in held.trees] == [t.toDebugString.partition("\n")[2] for t in written.trees]
    assert held.treeWeights == library.treeWeights and held.numFeatures == 4
    assert held.trees[0].toDebugString.partition("\n")[2] == library.trees[0].toDebugString.partition("\n")[2]
    assert np.allclose(held.featureImportances.toArray(), library.featureImportances.toArray(), atol=1e-6)


def test_sampled_boosting_is_left_to_the_library(rows):
    options = dict(labelCol="binary_label", seed=42, maxIter=2, maxDepth=2, subsamplingRate=0.5)
    assert (scored(B.BoostedTrees(**options).fit(rows), rows)[1] == scored(GBTClassifier(**options).fit(rows), rows)[1]).all()


def test_codes_hold_every_bin():
    layout = B.Layout([np.array([0.5]), np.arange(30.0), None, np.array([])], [2, 31, 3, 1])
    x = np.array([[0, 4, 2, 9], [1, 40, 0, 9], [1, -1, 1, 9.0]])
    codes = layout.encode(x)
    bins = [[int(codes[p, i]) // s % layout.bins[f] for f, (p, s) in sorted(layout.place.items())] for i in range(3)]
    assert bins == [[0, 4, 2, 0], [1, 30, 0, 0], [1, 0, 1, 0]]
    with pytest.raises(ValueError, match="category"):
        layout.encode(np.array([[0, 0, 3, 0.0]]))
