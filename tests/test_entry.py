import duckdb

import __spark_entry__ as E
from sparkfeat import constants as K

from .conftest import SF_SMOKE

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def test_entry_feature_table(spark):
    df = E.entry(spark)
    assert df.columns == K.FINAL_FEATURES
    assert df.count() > 0


def test_registry_consistent():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert "engineer_features" in sql


def _duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def test_some_oracles_match_at_smoke_scale(spark):
    con = _duck(SF_SMOKE)
    qs, sql = E.queries(), E.oracle_sql()
    for name in ["engineer_features", "per_class_metrics", "class_weights", "confusion_wide", "one_hot"]:
        df = qs[name](spark, SF_SMOKE)
        got = sorted(tuple(str(v) for v in r) for r in df.select(*sorted(df.columns)).collect())
        cur = con.execute(sql[name])
        cols = [d[0] for d in cur.description]
        order = sorted(range(len(cols)), key=lambda i: cols[i])
        want = sorted(tuple(str(r[i]) for i in order) for r in cur.fetchall())
        assert sorted(df.columns) == sorted(cols), name
        assert got == want, name
