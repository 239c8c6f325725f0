import math

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from sparkfeat.operators.binning import equal_width_bins, equal_width_edges


def _bins(spark, values):
    df = spark.createDataFrame([(i, None if v is None else float(v)) for i, v in enumerate(values)], "i long, x double")
    out = equal_width_bins(df, {"x": "b"}).orderBy("i").collect()
    return [r["b"] for r in out]


def test_right_closed_edges(spark):
    assert _bins(spark, [0, 5, 5.0001, 10, 100]) == [0, 0, 1, 1, 19]


def test_constant_column_is_middle_bin(spark):
    assert _bins(spark, [3.0, 3.0, 3.0]) == [9, 9, 9]
    assert _bins(spark, [0.0, 0.0]) == [9, 9]


def test_null_and_nan_stay_null(spark):
    assert _bins(spark, [1.0, None, float("nan"), 2.0]) == [0, None, None, 19]


def test_edges_match_pandas():
    for lo, hi in [(0.0, 100.0), (-178.0, -65.0), (18.0, 70.001), (3.0, 3.0)]:
        _, ours_ref = pd.cut(pd.Series([lo, hi]), bins=20, retbins=True)
        assert list(ours_ref) == equal_width_edges(lo, hi, 20)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False), min_size=1, max_size=40))
def test_matches_pandas_cut(spark, values):
    expected = pd.cut(pd.Series(values), bins=20, labels=False)
    got = _bins(spark, values)
    for e, g in zip(expected, got):
        assert (g is None and math.isnan(e)) or g == int(e)
