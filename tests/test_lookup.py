from pyspark.sql import functions as F

from sparkfeat.operators.frequency import cell_density, frequency_encode
from sparkfeat.operators.lookup import join_lookup


def _skewed(spark, n=3000):
    # one key holds a third of all rows; nulls included
    rows = []
    for i in range(n):
        if i % 3 == 0:
            k = "hot"
        elif i % 17 == 0:
            k = None
        else:
            k = f"k{i % 200}"
        rows.append((i, k, f"g{i % 7}"))
    return spark.createDataFrame(rows, "id long, k string, g string")


def _expected(df):
    pdf = df.toPandas()
    counts = pdf["k"].value_counts()
    return {r.id: (None if r.k is None else int(counts[r.k])) for r in pdf.itertuples()}


def test_frequency_broadcast_path(spark):
    df = _skewed(spark)
    got = {r["id"]: r["kf"] for r in frequency_encode(df, {"k": "kf"}).collect()}
    assert got == _expected(df)


def test_frequency_salted_path_matches(spark):
    df = _skewed(spark)
    # a tiny broadcast budget forces the hot-key split + salted shuffle join
    out = frequency_encode(df, {"k": "kf", "g": "gf"}, max_broadcast_rows=3)
    got = {r["id"]: r["kf"] for r in out.collect()}
    assert got == _expected(df)
    assert out.count() == df.count()
    assert out.columns == df.columns + ["kf", "gf"]


def test_join_lookup_plain_shuffle_fallback(spark):
    df = _skewed(spark)
    lk = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    out = join_lookup(df, lk, ["k"], ["n"], max_broadcast_rows=1)
    got = {r["id"]: r["n"] for r in out.collect()}
    assert got == _expected(df)


def test_cell_density_null_cell_is_zero(spark):
    df = spark.createDataFrame([(1, 0, 0), (2, 0, 0), (3, 1, None), (4, 1, 2)], "id long, a int, b int")
    got = {r["id"]: r["d"] for r in cell_density(df, ["a", "b"], "d", 441).collect()}
    assert got == {1: 2, 2: 2, 3: 0, 4: 1}


def test_salted_path_spreads_hot_key(spark):
    """The one-third hot key must not land in a single shuffle partition."""
    saved = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = _skewed(spark, 6000)
        out = frequency_encode(df, {"k": "kf"}, max_broadcast_rows=3)
        sizes = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p"))
                 .agg(F.count(F.lit(1)).alias("n")).collect()]
        assert sum(sizes) == 6000
        assert max(sizes) < 0.25 * 6000, sizes
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)


def test_wide_keys_take_the_shuffle_path(spark):
    """Few rows but long keys: the byte bound, not the row bound, decides."""
    from sparkfeat.operators.profile import profile

    rows = [(i, ("x" * 5000) + str(i % 50)) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, k string")
    prof = profile(df, ["k"])
    assert prof.count_rows["k"] == 50 and prof.key_bytes["k"] >= 5000
    lk = prof.counts["k"].withColumnRenamed("n", "kf")
    out = join_lookup(df, lk, ["k"], ["kf"], lookup_rows=50, row_counts="kf", total_rows=2000,
                      key_bytes=prof.key_bytes["k"], max_broadcast_bytes=100_000)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "__jk" in plan                       # salted shuffle path chosen
    assert {r["kf"] for r in out.collect()} == {40}
