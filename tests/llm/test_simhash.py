import numpy as np
import pytest

from sparkfeat.llm import queries, simhash
from sparkfeat.llm.common import connected_components

from . import brute
from ..conftest import SF_SMALL


def test_odd_rows(spark, odd_docs, odd_rows):
    want = brute.components([(r[0], r[1]) for r in odd_rows])
    got = simhash.components(odd_docs).collect()
    assert len(got) == len(odd_rows)
    by_id = {}
    for i, t, *_ in odd_rows:
        by_id.setdefault(i, set()).add(brute.fingerprint(t))
    for r in got:
        fp = r["fp"] & (1 << 64) - 1
        assert fp in by_id[r["doc_id"]] and want[fp] == r["component_id"]


def test_query_matches_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    want = brute.components(docs)
    got = {r[0]: (r[1], r[2]) for r in queries.op9_simhash(spark, SF_SMALL).collect()}
    assert got == {i: (f"{brute.fingerprint(t):016x}", want[brute.fingerprint(t)]) for i, t in docs}


@pytest.mark.parametrize("budget,most", [(0, 1 << 20), (1, 1 << 20), (2, 1 << 20), (3, 1 << 20), (4, 1 << 20), (7, 1 << 20)])
def test_links_of_clustered_fingerprints(spark, budget, most):
    rng = np.random.default_rng(budget)
    centre = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    found = set(centre.tolist())
    for c in centre.tolist():
        for _ in range(25):  # chains of a few flipped bits
            for b in rng.integers(0, 64, rng.integers(1, 4)).tolist():
                c ^= 1 << b
            found.add(c)
    fps = sorted(found)
    table = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    edges = simhash.links(table, budget, subtree=64, most=most)
    roots = {r[0]: r[1] for r in connected_components(edges).collect()}
    signed = lambda f: int(np.uint64(f).view(np.int64))
    label = {f: f for f in fps}
    for f in fps:
        label[f] = min((g for g in fps if (f ^ g).bit_count() <= budget), default=f)
    groups = {}
    left = set(fps)
    while left:
        edge, group = [left.pop()], set()
        while edge:
            f = edge.pop()
            group.add(f)
            near = [g for g in left if (f ^ g).bit_count() <= budget]
            left.difference_update(near)
            edge += near
        for f in group:
            groups[signed(f)] = min(map(signed, group))
    assert {signed(f): roots.get(signed(f), signed(f)) for f in fps} == groups


def test_heavy_nodes_are_walked_further(spark):
    rng = np.random.default_rng(5)
    fps = np.unique(rng.integers(0, 1 << 40, 3000, dtype=np.uint64))  # one node holds all in the first rotation
    table = spark.createDataFrame([(int(f),) for f in fps], "fp long")
    dealt = simhash._dealt(table, 4, 64, 1500, simhash._blocks(4))
    sizes = dealt.groupBy("r", "depth", "x", "y").count().agg({"count": "max"}).first()[0]
    assert sizes <= 1500 and dealt.where("depth > 16").count() > 0
    got = simhash.links(table, 4, 64, 1500)
    near = {(i, j) for i in range(len(fps)) for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= 4).tolist() if j > i}
    roots = {r[0]: r[1] for r in connected_components(got).collect()}
    assert all(roots[int(fps[i])] == roots[int(fps[j])] for i, j in near)
    assert len(roots) == len({i for pair in near for i in pair})


def test_keep_one_of_many_repeated_rows(spark):
    text = "many rows of one id and one text " * 3
    rows = [(7, text, "b", i % 3) for i in range(4000)] + [(7, text, None, 5)] + [(None, "no id here at all", "x", 1)] * 900
    rows += [(i, f"other {i} words {i * 7} for {i * 13} each", "c", i) for i in range(100, 160)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, __key int").repartition(4)
    got = sorted(map(str, simhash.keep_one(docs).collect()))
    want = brute.components([(r[0], r[1]) for r in rows])
    assert len(got) == len(set(want.values())) and len(got) > 40
    assert any("doc_id=7," in r and "source=None, __key=5" in r for r in got)
    plan = simhash.keep_one(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_long_chain_of_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001), (5, 5)], "u long, v long")
    got = {r[0]: r[1] for r in connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(301)}, 1000: 1000, 1001: 1000}


def test_keep_one(spark, odd_docs, odd_rows):
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    rows = kept.select("doc_id", "text").collect()
    want = brute.components([(r[0], r[1]) for r in odd_rows])
    assert len(rows) == len({brute.fingerprint(r[1]) for r in rows}) <= len(want)
    classes = {}
    for f, c in want.items():
        classes.setdefault(c, set()).add(f)
    assert {want[brute.fingerprint(r[1])] for r in rows} == set(want.values())
    assert all(r["doc_id"] == want[brute.fingerprint(r["text"])] for r in rows)


def test_empty_table(spark, no_docs):
    assert simhash.components(no_docs).count() == 0
    assert simhash.keep_one(no_docs).count() == 0
