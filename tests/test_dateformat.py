import datetime as dt
import warnings

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparkfeat.functions.dateformat import (DATE_LAYOUTS, TIME_LAYOUTS, any_timestamp, format_of,
                                            formatted_timestamp, infer_formats, parse_inferred)
from sparkfeat.plans.features import apply_feature_stats, engineer_features, fit_feature_stats
from sparkfeat.sources.adapter import incidents

from .conftest import SF_SMOKE

#: strftime layouts whose texts pandas reads by a format of its own.
WRITTEN = ["%Y-%m-%d", "%Y/%m/%d", "%Y.%m.%d", "%m/%d/%Y", "%m-%d-%Y", "%m.%d.%Y", "%d/%m/%Y", "%d-%m-%Y", "%d.%m.%Y",
           "%b %d %Y", "%B %d, %Y", "%d %b %Y", "%d-%b-%Y", "%d-%B-%Y", "%Y-%b-%d", "%Y%m%d",
           "%Y-%m-%d %H:%M", "%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S", "%m/%d/%Y %H:%M", "%b %d, %Y %H:%M:%S"]


def by_pandas(values):
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        got = pd.to_datetime(pd.Series(values, dtype=object), errors="coerce")
    return [None if pd.isna(v) else v.to_pydatetime() for v in got]


def by_spark(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "i long, t string")
    out = parse_inferred(df, ["t"], "i").withColumn("t", F.col("t").cast("timestamp_ntz"))
    return [r["t"] for r in out.orderBy("i").collect()]


moments = st.datetimes(dt.datetime(1900, 1, 1), dt.datetime(2200, 1, 1)).map(lambda m: m.replace(microsecond=0))


@settings(max_examples=25, deadline=None)
@given(st.sampled_from(WRITTEN), st.sampled_from(WRITTEN), st.lists(moments, min_size=2, max_size=12))
def test_columns_are_read_as_pandas_reads_them(spark, first, other, values):
    """The first text fixes the format; texts of another format, impossible days
    and words become null, as in pandas."""
    texts = [None, ""] + [v.strftime(other if i % 3 == 2 else first) for i, v in enumerate(values)] + ["bad", "31/02/2003", None]
    assert by_spark(spark, texts) == by_pandas(texts)


@pytest.mark.parametrize("text, fmt", [
    ("01/02/2003", "M/d/yyyy"), ("1/2/2003", "M/d/yyyy"), ("13/02/2003", "d/M/yyyy"), ("13.02.2003", "d.M.yyyy"),
    ("2003-01-02", "yyyy-M-d"), ("2003/01/02", "yyyy/M/d"), ("20030102", "yyyyMMdd"), ("2003", "yyyy"), ("2003-01", "yyyy-M"),
    ("Jan 2 2003", "MMM d yyyy"), ("Jan 2, 2003", "MMM d, yyyy"), ("May 2 2003", "MMMM d yyyy"), ("2 January 2003", "d MMMM yyyy"),
    ("2003-01-02T10:11:12.5", "yyyy-M-d'T'H:mm:ss.SSSSSS"), ("01/02/2003 1:11 PM", "M/d/yyyy h:mm a"), (" 01/02/2003 ", "M/d/yyyy"),
    ("31/02/2003", None), ("02/30/2004", None), ("0000-01-02", None), ("01/02/03", None), ("001/2/2003", None), ("2003-01-02 25:00", None),
    ("2003-01-02\n", None), ("bad", None), ("", None), ("٢٠٠٣-01-02", None)])
def test_format_of(text, fmt):
    assert format_of(text) == fmt


def test_every_format_reads_what_it_writes(spark):
    """Each candidate reads back its own text, in Spark and through the shape."""
    moment, texts = dt.datetime(2003, 11, 24, 13, 45, 0), []
    for day in DATE_LAYOUTS:
        for time in TIME_LAYOUTS[:4] + TIME_LAYOUTS[7:]:
            if day == "yyyy" and time:
                continue
            fmt = day + time
            row = spark.range(1).select(F.date_format(F.lit(moment), fmt).alias("t")).select(
                "t", formatted_timestamp(F.col("t"), [fmt]).alias("v"))
            text, value = row.first()
            texts.append((text, fmt))
            want = moment.replace(hour=moment.hour if "H" in time or "h" in time else 0, minute=45 if time else 0,
                                  day=24 if "d" in day else 1, month=11 if "M" in day else 1)
            assert value == want, fmt
            assert format_of(text) is not None, text
    both = spark.createDataFrame(texts, "t string, fmt string").where(any_timestamp(F.col("t")).isNull())
    assert both.collect() == []


def test_odd_columns(spark):
    """Ties and null order keys, no text at all, only words, very long text, other types."""
    schema = "k int, a string, b string, c string, d date, `x.y` string"
    rows = [(2, "13/02/2003", None, "later", dt.date(2003, 1, 2), "2003-01-02"), (2, "01/02/2003", "", "03/04/2003", None, "x" * 100000),
            (None, "2003/01/02", "NaT", "4 May 2003", None, None), (3, "03/04/2003", None, None, None, "2004-1-5")]
    df = spark.createDataFrame(rows, schema)
    found = infer_formats(df, ["a", "b", "c", "d", "x.y"], "k")
    assert found["a"] == ["yyyy/M/d"]  # the null key comes first
    assert infer_formats(df.where("k is not null"), ["a"], "k")["a"] == ["M/d/yyyy"]  # ties: smaller text
    assert found["b"] == [] and found["c"] == ["d MMMM yyyy"] and infer_formats(df.where("k = 2"), ["c"], "k")["c"] == ["M/d/yyyy"]
    assert "d" not in found and found["x.y"] == ["yyyy-M-d"]
    out = parse_inferred(df, ["a", "b", "c", "d", "x.y"], "k")
    assert out.columns == df.columns and dict(out.dtypes)["d"] == "date"
    assert out.where("b is not null").count() == 0
    empty = df.limit(0)
    assert parse_inferred(empty, ["a", "c"], "k").count() == 0


def test_mixed_column_reads_each_value(spark):
    texts = ["no date", "2003-01-02", "01/02/2003", "13/02/2003 10:11", "jan 5 2003", "6 JANUARY 2003", "2003-01-02T03:04:05", "1/2/2003 1:05 pm", "31/02/2003",
             "2003-01-02 12:00:01 AM", "2003-01-02 24:00", "2003-01-02 13:00 pm", "5/6/2003T10:00", "2003", "5 May 2003 1:02:03.5", "", "10:11"]
    d = dt.datetime
    assert by_spark(spark, texts) == [None, d(2003, 1, 2), d(2003, 1, 2), d(2003, 2, 13, 10, 11), d(2003, 1, 5), d(2003, 1, 6),
                                      d(2003, 1, 2, 3, 4, 5), d(2003, 1, 2, 13, 5), None,
                                      d(2003, 1, 2, 0, 0, 1), None, None, None, d(2003, 1, 1), d(2003, 5, 5, 1, 2, 3, 500000), None, None]


def test_streams_are_refused(spark, tmp_path):
    spark.range(1).selectExpr("id", "'x' as t").write.parquet(str(tmp_path / "s"))
    with pytest.raises(ValueError, match="stream"):
        infer_formats(spark.readStream.schema("id long, t string").parquet(str(tmp_path / "s")), ["t"], "id")


def test_feature_job_infers_each_column(spark):
    """Text dates in two formats give the features of the dates themselves."""
    raw = incidents(spark, SF_SMOKE)
    text = raw.withColumns({"DISCOVERY_DATE": F.date_format("DISCOVERY_DATE", "MM/dd/yyyy"), "CONT_DATE": F.date_format("CONT_DATE", "yyyy.MM.dd HH:mm")})
    want, got = engineer_features(raw), engineer_features(text, "infer")
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    stats = fit_feature_stats(text, "infer")
    assert apply_feature_stats(text, stats, ["infer"]).exceptAll(want).count() == 0
