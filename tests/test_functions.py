import datetime as dt

from pyspark.sql import functions as F

from sparkfeat.functions import rules as R
from sparkfeat.functions import temporal as TM
from sparkfeat.plans.features import temporal_features


def _raw(spark, rows):
    schema = ("FOD_ID long, FIRE_YEAR long, DISCOVERY_DATE timestamp_ntz, DISCOVERY_DOY long, "
              "CONT_DATE timestamp_ntz, DISCOVERY_TIME string")
    return spark.createDataFrame(rows, schema)


def test_day_of_week_monday_is_zero(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "d timestamp_ntz")
    assert df.select(TM.day_of_week(F.col("d"))).first()[0] == 0


def test_temporal_edges(spark):
    rows = [
        (1, 2024, dt.datetime(2024, 1, 1, 6), 1, dt.datetime(2024, 1, 1, 0), " 930 "),  # -6 h
        (2, 2024, None, 1, dt.datetime(2024, 1, 2), "1e3"),
        (3, 1999, dt.datetime(1999, 7, 3), 184, None, "abc"),
        (4, 2001, dt.datetime(2001, 3, 10), 69, dt.datetime(2001, 3, 12, 23), ""),
        (5, 2001, dt.datetime(2001, 8, 1), 213, dt.datetime(2001, 8, 1), None),
        (6, 2001, dt.datetime(2001, 8, 1), 213, dt.datetime(2001, 8, 1), "-5"),
        (7, 2001, dt.datetime(2001, 8, 1), 213, dt.datetime(2001, 8, 1), "2460"),
    ]
    out = {r["FOD_ID"]: r for r in temporal_features(_raw(spark, rows)).collect()}
    assert out[1]["fire_duration_days"] == -1
    assert out[2]["fire_duration_days"] == 0          # null date -> 0
    assert out[3]["fire_duration_days"] == 0
    assert out[4]["fire_duration_days"] == 2
    assert [out[i]["DISCOVERY_TIME"] for i in range(1, 6)] == [930.0, 1000.0, 1200.0, 1200.0, 1200.0]
    assert out[6]["discovery_hour"] == 23 and out[7]["discovery_hour"] == 0
    assert out[1]["discovery_hour"] == 9
    # null month -> every flag 0, season null before the 'Unknown' fill
    assert out[2]["fire_season"] == 0 and out[2]["is_weekend"] == 0 and out[2]["season"] is None
    assert out[3]["season"] == "Summer" and out[3]["fire_season"] == 1 and out[3]["is_weekend"] == 1
    assert out[3]["decade"] == 1990 and out[4]["decade"] == 2000


def test_lenient_timestamp_text(spark):
    df = spark.createDataFrame([("2024-02-03",), ("bad",), (None,)], "s string")
    got = [r[0] for r in df.select(TM.lenient_timestamp(F.col("s"), df.schema["s"].dataType)).collect()]
    assert got == [dt.datetime(2024, 2, 3), None, None]
    got = [r[0] for r in df.select(TM.lenient_timestamp(F.col("s"), df.schema["s"].dataType, "yyyy-MM-dd")).collect()]
    assert got == [dt.datetime(2024, 2, 3), None, None]


def test_region_rules_first_match(spark):
    rows = [(48.0, -121.0), (40.0, -121.0), (40.0, -110.0), (40.0, -90.0), (30.0, -110.0), (30.0, -90.0),
            (47.0, -120.0), (37.0, -100.0)]
    df = spark.createDataFrame(rows, "lat double, lon double")
    got = [r[0] for r in df.select(R.region_of(F.col("lat"), F.col("lon"))).collect()]
    assert got == ["PNW", "CA", "MW", "North", "SW", "SE", "PNW", "MW"]


def test_flags_and_lookup(spark):
    df = spark.createDataFrame([(6,), (None,), (11,)], "m int")
    got = df.select(R.membership_flag(F.col("m"), [6, 7]).alias("a"), R.range_flag(F.col("m"), 5, 10).alias("b"),
                    R.lookup(F.col("m"), {6: "x", 11: "y"}).alias("c")).collect()
    assert [tuple(r) for r in got] == [(1, 1, "x"), (0, 0, None), (0, 0, "y")]
    df = spark.createDataFrame([(0.0,), (2.0,), (9.0,), (None,)], "code double")
    got = [r[0] for r in df.select(R.decode_label(F.col("code"), ["B", "A", "C"])).collect()]
    assert got == ["B", "C", "N/A", "N/A"]
    df = spark.createDataFrame([("C",), ("A",), (None,)], "c string")
    assert [r[0] for r in df.select(R.binary_target(F.col("c"))).collect()] == [1.0, 0.0, 0.0]


def test_numeric_dates_need_a_unit(spark):
    import pytest
    from pyspark.sql import types as T

    df = spark.createDataFrame([(2453403.5,), (None,)], "d double")
    with pytest.raises(TypeError):
        TM.lenient_timestamp(F.col("d"), T.DoubleType())
    got = [r[0] for r in df.select(TM.lenient_timestamp(F.col("d"), T.DoubleType(), unit="julian")).collect()]
    assert got == [dt.datetime(2005, 2, 2), None]
    df = spark.createDataFrame([(86400.0 * 3 + 3600,)], "s double")
    assert df.select(TM.lenient_timestamp(F.col("s"), T.DoubleType(), unit="s")).first()[0] == \
        dt.datetime(1970, 1, 4, 1)


def test_available_features_and_session_conf(spark):
    from sparkfeat.operators.clean import available_features
    from sparkfeat.session import configure

    df = spark.createDataFrame([("x", 1.0, "y")], "season string, LATITUDE double, other string")
    assert available_features(df) == (["season"], ["LATITUDE"])
    configure(spark)
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"


def test_lenient_number_matches_pandas(spark):
    import math

    import pandas as pd
    from hypothesis import given, settings
    from hypothesis import strategies as st
    from pyspark.sql import types as T

    texts = st.text(alphabet="0123456789 .eE+-", max_size=8)

    @settings(max_examples=25, deadline=None)
    @given(st.lists(texts, min_size=1, max_size=30))
    def check(values):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, s string")
        got = [r[0] for r in df.orderBy("i").select(
            TM.lenient_number(F.col("s"), T.StringType(), 1200.0)).collect()]
        want = pd.to_numeric(pd.Series(values, dtype=object), errors="coerce").astype(float).fillna(1200.0)
        for v, g, w in zip(values, got, want):
            assert (math.isclose(g, w, rel_tol=1e-12) or (math.isinf(g) and g == w)), (v, g, w)

    check()


def test_lenient_number_exponent_edges(spark):
    import pandas as pd
    from pyspark.sql import types as T

    vals = ["0E400", "1E400", "1E308", "1E309", "2E308", "1E-400", "0.001E311", "1000E306", "0E309",
            ".1E309", "0.00E311", "00.000E311", "5.0E309", "-2E308", "1.5E308", " 1e-400", "1e0309"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i long, s string")
    got = [r[0] for r in df.orderBy("i").select(TM.lenient_number(F.col("s"), T.StringType(), 1200.0)).collect()]
    want = list(pd.to_numeric(pd.Series(vals, dtype=object), errors="coerce").astype(float).fillna(1200.0))
    assert got == want


def test_dates_match_pandas(spark):
    import pandas as pd
    from hypothesis import given, settings
    from hypothesis import strategies as st

    stamps = st.datetimes(min_value=dt.datetime(1950, 1, 1), max_value=dt.datetime(2050, 12, 31))

    @settings(max_examples=15, deadline=None)
    @given(st.lists(st.tuples(stamps, st.one_of(st.none(), stamps)), min_size=1, max_size=20))
    def check(pairs):
        rows = [(i, a.replace(microsecond=0), None if b is None else b.replace(microsecond=0))
                for i, (a, b) in enumerate(pairs)]
        df = spark.createDataFrame(rows, "i long, a timestamp_ntz, b timestamp_ntz")
        got = df.orderBy("i").select(
            TM.month_of(F.col("a")).alias("m"), TM.day_of_week(F.col("a")).alias("w"),
            F.coalesce(TM.duration_days(F.col("a"), F.col("b")), F.lit(0)).alias("d")).collect()
        pdf = pd.DataFrame(rows, columns=["i", "a", "b"])
        a, b = pd.to_datetime(pdf["a"]), pd.to_datetime(pdf["b"])
        want_d = (b - a).dt.days.fillna(0).astype(int)
        for r, m, w, d in zip(got, a.dt.month, a.dt.dayofweek, want_d):
            assert (r["m"], r["w"], r["d"]) == (m, w, d)

    check()
