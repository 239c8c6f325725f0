import hashlib

import pytest

from sparkfeat.llm import blocks, queries, templates

from . import brute
from ..conftest import SF_SMALL

LOG = [(i, f"job {i} started on host alpha{i}\nuser {name} logged in from 10.0.0.{i}\nbody number {i} {name} {name} unlike\n\nfree {name}"
           + ("\nThe same closing line for all" * (1 + i % 2)) + "\n" * (i % 3))
       for i, name in enumerate("ann bob cid dan eve fay gus hal ann ann ann bob ann".split())]


def _rows(df):
    return sorted(map(str, map(tuple, df.select("doc_id", "n_lines", "n_dropped", "kept").collect())))


def _want(rows, **options):
    found = brute.recurring_lines(rows, **options)
    return sorted(str((r[0], *found[r])) for r in rows)


@pytest.mark.parametrize("options", [{}, {"depth": 1, "min_docs": 2}, {"depth": 2, "min_fixed": 0.8}, {"min_tokens": 1, "min_docs": 5}])
def test_logs(spark, options, monkeypatch):
    monkeypatch.setattr(templates, "keyed", lambda *a: blocks.keyed(*a, 400))
    docs = spark.createDataFrame(LOG, "doc_id long, text string").repartition(3)
    got = _rows(templates.drop_recurring(docs, **options))
    assert got == _want(LOG, **options)
    assert any(", 0, " not in r for r in got)


def _dropped(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return {r["doc_id"]: r["n_dropped"] for r in templates.drop_recurring(docs).collect()}


@pytest.mark.parametrize("n", [12, 400])
def test_one_template_at_two_corpus_sizes(spark, n):
    names = [a + b for a in "abcdefgh" for b in "vwxyz"]
    rows = [(i, f"worker finished task by {names[i % 40]} on {names[(i + i // 40) % 40].upper()} ok") for i in range(n)]
    assert _dropped(spark, rows) == {i: int(i > 0) for i in range(n)}


def test_a_token_of_one_document_is_counted_once(spark):
    rows = [(i, f"worker finished task by {u} on {h} ok") for i, (u, h) in enumerate(zip("ann bob cid dan eve".split(), "KA KB KC KD KE".split()))]
    rows.append((5, "\n".join(f"worker finished task by zoe on {h} ok" for h in ("MA", "MB", "MC"))))
    assert _dropped(spark, rows) == {0: 0, 1: 1, 2: 1, 3: 1, 4: 1, 5: 3}


def test_odd_rows(spark, odd_docs, odd_rows):
    rows = [(r[0], r[1]) for r in odd_rows]
    assert _rows(templates.drop_recurring(odd_docs)) == _want(rows)


def test_query_matches_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    want = {k[0]: (n, d, hashlib.sha256(t.encode()).hexdigest()) for k, (n, d, t) in brute.recurring_lines(docs).items()}
    got = {r[0]: tuple(r[1:]) for r in queries.op1_templates(spark, SF_SMALL).collect()}
    assert got == want and sum(d for _, d, _ in want.values()) > 10


def test_empty_table(spark, no_docs):
    assert templates.drop_recurring(no_docs).count() == 0
