import collections
import itertools
import zlib

import pytest
from pyspark.sql import functions as F

from sparkfeat.llm import queries, sharding

from ..conftest import SF_SMALL


def _check_slots(rows):
    by = collections.defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by.values())


def test_query(spark):
    docs = {r[0]: r[1] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()}
    rows = queries.op6_sharding(spark, SF_SMALL).collect()
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in rows} == {
        i: (len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in docs.items()}
    _check_slots(rows)
    load = collections.Counter()
    for r in rows:
        load[r["shard"]] += r["size"]
    mean = sum(load.values()) / 16
    assert len(load) == 16 and all(abs(n - mean) < 0.02 * mean for n in load.values())
    home = collections.defaultdict(set)
    for r in rows:
        home[docs[r["doc_id"]]].add(r["shard"])
    assert all(len(s) == 1 for s in home.values())
    old = collections.Counter()
    for r in rows:
        old[r["old_shard"]] += r["size"]
    least = sum(max(0, old[s] - mean) for s in range(16))
    moved = sum(r["size"] for r in rows if r["shard"] != r["old_shard"])
    assert moved <= least + 0.1 * mean * 16


def test_flow_is_cheapest():
    supply, room = [7, 0, 5], [4, 4, 4]
    cost = [[0, 2, 5], [1, 0, 1], [3, 1, 0]]
    flow = sharding.min_cost_flow(supply, room, lambda i, j: cost[i][j])
    assert [sum(f) for f in flow] == supply and all(sum(f[j] for f in flow) <= room[j] for j in range(3))
    paid = sum(flow[i][j] * cost[i][j] for i in range(3) for j in range(3))
    best = min(sum(a[j] * cost[0][j] for j in range(3)) + sum(b[j] * cost[2][j] for j in range(3))
               for a in itertools.product(range(8), repeat=3) if sum(a) == 7
               for b in itertools.product(range(6), repeat=3) if sum(b) == 5 and all(a[j] + b[j] <= room[j] for j in range(3)))
    assert paid == best


def test_odd_rows(spark, odd_docs, odd_rows):
    got = sharding.reshard(odd_docs, keep=["key", "lang"])
    rows = got.collect()
    assert len(rows) == len(odd_rows) and got.columns[-2:] == ["key", "lang"]
    want = sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in odd_rows)
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in rows) == want
    _check_slots(rows)


def test_huge_group_is_split(spark):
    rows = [(i, "copy " * 20) for i in range(4000)] + [(9000 + i, f"text {i} " * 9) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sharding.reshard(docs).groupBy("shard").agg(F.sum("size").alias("n")).collect()
    total = sum(len(t) + 1 for _, t in rows)
    assert len(got) == 16 and all(abs(r["n"] - total / 16) < 0.02 * total / 16 for r in got)


def test_old_layout_and_rewrite(spark, tmp_path):
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.format_string("text %d", "id").alias("text"),
                                    (F.col("id") % 3).cast("int").alias("old"))
    same = sharding.reshard(docs, shards=3, old_shard="old")
    assert same.where("shard <> old_shard").count() <= 8
    capacity = [12_000, 0, 12_000]
    got = sharding.reshard(docs, shards=3, old_shard="old", capacity=capacity, keep=["text"])
    assert got.where("shard = 1").count() == 0 and got.where("old_shard <> 1 and shard <> old_shard").count() == 0
    touched = sharding.rewrite_affected(got, str(tmp_path / "new"))
    assert 1 in touched
    back = spark.read.parquet(str(tmp_path / "new"))
    assert back.count() == got.where(F.col("shard").isin(touched)).count()
    with pytest.raises(ValueError):
        sharding.reshard(docs, shards=3, capacity=[1, 1, 1])


def test_empty_table(spark, no_docs):
    assert sharding.reshard(no_docs).count() == 0
