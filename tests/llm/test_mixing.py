import collections

import pytest

from sparkfeat.llm import mixing, queries

from . import brute
from ..conftest import SF_SMALL


def _check(rows, want_sizes, near=0.02):
    """rows: (source, size, source_size, target, copies)."""
    sizes = collections.Counter()
    for s, n in want_sizes:
        sizes[s] += n
    targets = brute.mix_targets(sizes)
    taken = collections.Counter()
    for s, size, source_size, target, copies in rows:
        assert source_size == sizes[s] and target == pytest.approx(targets[s], rel=1e-12)
        assert 0 <= copies <= 3
        taken[s] += copies * size
    for s, t in targets.items():
        assert abs(taken[s] - t) <= max(near * t, 3), (s, taken[s], t)


def test_query(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "source").collect()
    size = {r[0]: len(brute.SPACE.findall(r[1] or "")) for r in docs}
    source = {r[0]: r[2] for r in docs}
    got = queries.op5_mixing(spark, SF_SMALL).collect()
    assert {r["doc_id"]: r["size"] for r in got} == size
    _check([(source[r["doc_id"]], r["size"], r["source_size"], r["target"], r["copies"]) for r in got],
           [(source[i], n) for i, n in size.items()])
    again = queries.op5_mixing(spark, SF_SMALL).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_odd_rows(spark, odd_docs, odd_rows):
    got = mixing.mix(odd_docs)
    assert got.columns[:len(odd_docs.columns)] == odd_docs.columns
    rows = got.select("source", "mix_size", "mix_source_size", "mix_target", "mix_copies").collect()
    assert len(rows) == len(odd_rows)
    sizes = [(r[3], len(brute.SPACE.findall(r[1] or ""))) for r in odd_rows]
    targets = brute.mix_targets({s: sum(n for t, n in sizes if t == s) for s, _ in sizes})
    _check(rows, sizes, near=0.35)  # a few huge documents: whole copies cannot come closer everywhere
    assert sum(r[4] * r[1] for r in rows) == pytest.approx(sum(targets.values()), rel=0.2)
    out = mixing.repeat_rows(got, odd_docs.columns)
    assert out.columns == odd_docs.columns and out.count() == sum(r[4] for r in rows)


def test_steep_tilts(spark):
    rows = [(i, " ".join(["w"] * (1 + i % 50)), "a") for i in range(3000)] + [(9000 + i, " ".join(["w"] * (1 + i % 9)), "b") for i in range(300)]
    rows += [(9900 + i, "w", None) for i in range(2)] + [(9990, "", "empty"), (9991, None, "z")]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    _check(got.select("source", "mix_size", "mix_source_size", "mix_target", "mix_copies").collect(),
           [(s, len((t or "").split())) for _, t, s in rows], near=0.001)


def test_empty_table(spark, no_docs):
    assert mixing.mix(no_docs).count() == 0
