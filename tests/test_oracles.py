"""Every query with an oracle, against DuckDB on the smoke tables."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as E
from sparkfeat.operators import models as MD
from sparkfeat.plans import catalog

from .conftest import SF_SMOKE

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]
SKIP_SLOW = {"stream_features"}  # covered by tests/test_plans.py


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 6))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMOKE}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) - SKIP_SLOW))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMOKE)
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(dcols, cur.fetchall())


#: Trained models have no SQL; their rows and report tables must be whole.
NO_ORACLE = sorted(set(catalog.QUERIES) - set(E.oracle_sql()))


@pytest.fixture(scope="module")
def model_input(spark):
    return catalog.model_input(spark, SF_SMOKE)


@pytest.mark.parametrize("name", NO_ORACLE)
def test_query_without_oracle_is_whole(spark, monkeypatch, model_input, name):
    """Runs, has rows, and no column but ``k`` (only set for PCA) is ever null.
    The fits are shortened and the feature table is built once for all of them;
    rows and columns do not depend on that."""
    monkeypatch.setattr(catalog, "model_input", lambda *_: model_input)
    few = {"RandomForest": {"numTrees": 2}, "LogisticRegression": {"maxIter": 2}, "GBT": {"maxIter": 2}}
    real = MD.classifier
    monkeypatch.setattr(MD, "classifier", lambda kind, **o: real(kind, **{**few.get(kind, {}), **o}))
    df = catalog.QUERIES[name](spark, SF_SMOKE)
    rows = df.collect()
    assert rows
    for i, column in enumerate(df.columns):
        if column != "k":
            assert all(r[i] is not None for r in rows), column
