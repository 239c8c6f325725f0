"""Compare a registered query with its DuckDB SQL on the given tables."""

import os

import duckdb

from sparkfeat.llm import queries


def same_as_oracle(spark, name, sf_dir):
    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{sf_dir}/{f}')")
    got = queries.QUERIES[name](spark, sf_dir)
    found = con.execute(queries.ORACLES[name])
    columns = sorted(c[0] for c in found.description)
    assert sorted(got.columns) == columns
    at = [[c[0] for c in found.description].index(c) for c in columns]
    key = lambda r: tuple(map(str, r))
    want = sorted((tuple(r[i] for i in at) for r in found.fetchall()), key=key)
    have = sorted(map(tuple, got.select(*columns).collect()), key=key)
    assert len(have) == len(want)
    assert have == want
