import os

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparkfeat.llm import blocks, queries, suffix

from . import brute
from ..conftest import SF_SMALL


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text("ab", min_size=1, max_size=9), st.integers(0, 8)), min_size=1, max_size=9))
def test_construction_against_sorted_suffixes(rows):
    strings = [s for s, _ in rows]
    offset = np.array([min(o, len(s) - 1) for s, o in rows])
    data = np.frombuffer("".join(strings).encode(), np.uint8)
    size = np.array([len(s) for s in strings])
    seen = 0
    for column, order, prefix in suffix.columns(data, np.cumsum(size) - size, size, offset):
        tail = {i: s[o + column:] for i, (s, o) in enumerate(zip(strings, offset.tolist())) if 0 <= o + column < len(s)}
        assert sorted(order.tolist()) == sorted(tail)
        got = [tail[i] for i in order.tolist()]
        assert got == sorted(got)
        for a, b, n in zip(got, got[1:], prefix[1:].tolist()):
            assert n == len(os.path.commonprefix([a, b]))
        seen += len(tail)
    assert seen == len(data)


def test_common_prefixes_of_long_strings():
    data = np.frombuffer(b"ab" * 300, np.uint8)
    *_, (_, order, prefix) = suffix.columns(data, np.array([0, 300]), np.array([300, 300]), np.zeros(2, np.int64))
    assert order.tolist() == [0, 1] and prefix.tolist() == [0, 300]


def _rows(df):
    return df.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()


@pytest.mark.parametrize("size,hot", [(8 << 20, 2000), (3000, 2000), (3000, 0)])
def test_odd_rows(spark, odd_docs, odd_rows, monkeypatch, size, hot):
    monkeypatch.setattr(suffix, "keyed", lambda *a: blocks.keyed(*a, size))
    monkeypatch.setattr(suffix, "gathered", lambda k, c: blocks.gathered(k, c, size))
    want = brute.repeated_bytes([(r[0], r[1]) for r in odd_rows])
    got = sorted(map(str, map(tuple, _rows(suffix.remove_repeats(odd_docs, hot_strings=hot)))))
    assert got == sorted(str((r[0], *want[r[0], r[1]])) for r in odd_rows)


def test_spans_are_the_removed_bytes(spark, odd_docs):
    for r in suffix.remove_repeats(odd_docs).where("n_removed > 0").collect():
        assert sum(s["size"] for s in r["spans"]) == r["n_removed"] and len(r["spans"]) == r["n_spans"]


def _one_per_partition(spark, rows):
    return spark.createDataFrame(spark.sparkContext.parallelize(rows, len(rows)), "doc_id long, text string")


def _against_brute(df, rows):
    want = brute.repeated_bytes(rows)
    assert sorted(_rows(df)) == sorted((r[0], *want[r]) for r in rows)
    return want


def test_passage_repeated_inside_documents_that_meet_nowhere_else(spark):
    rng = np.random.default_rng(5)
    word = lambda n: "".join(map(chr, rng.integers(97, 123, n)))
    a, b, c = word(200), word(30), word(90)
    rows = [(1, a + word(40) + a + word(70) + a), (2, word(60) + a + word(30) + a + a + word(9) + a),
            (3, c + b + word(80) + word(80) + b + c), (4, word(55) + b + c), (5, "x" * 3000), (6, word(20) + "x" * 2500 + word(20)),
            (7, "na " * 400), (8, "na " * 300 + c + "na " * 70)]
    want = _against_brute(suffix.remove_repeats(_one_per_partition(spark, rows)), rows)
    assert want[rows[1]][1] >= 800 and want[rows[5]][1] >= 2500


@pytest.mark.parametrize("seed", range(3))
def test_shuffled_phrases_each_document_in_its_own_partition(spark, seed):
    rng = np.random.default_rng(seed)
    phrases = ["".join(map(chr, rng.integers(97, 123, n))) for n in rng.integers(8, 45, 14)]
    rows = [(i, "".join(phrases[j] for j in rng.integers(0, 14, 40))) for i in range(4)]
    _against_brute(suffix.remove_repeats(_one_per_partition(spark, rows)), rows)


@pytest.mark.parametrize("hot", [3, 12, 40])
def test_anchor_that_is_frequent_in_one_group_only(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix, "keyed", lambda *a: blocks.keyed(*a, 3000))
    monkeypatch.setattr(suffix, "gathered", lambda k, c: blocks.gathered(k, c, 3000))
    rng = np.random.default_rng(11)
    letters = rng.integers(97, 123, 1 << 16, dtype=np.uint8)
    at = int(np.argmin(suffix.tx.Rolling(suffix.tx.BYTE_VALUE[letters]).grams(suffix.GRAM)))
    gram = letters[at:at + suffix.GRAM].tobytes().decode()
    contexts = ["".join(map(chr, rng.integers(97, 123, 35))) + gram + "".join(map(chr, rng.integers(97, 123, 35))) for _ in range(60)]
    rows = [(1, "".join(contexts[:40]))]
    rows += [(2 + i, "".join(contexts[j] for j in rng.permutation(60)[:n])) for i, n in enumerate((1, 2, 3, 5, 8, 13, 21, 30) * 2)]
    _against_brute(suffix.remove_repeats(_one_per_partition(spark, rows), hot_strings=hot), rows)


def test_query_matches_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    want = sorted((key[0], *rest) for key, rest in brute.repeated_bytes(docs).items())
    assert sorted(map(tuple, queries.op2_suffix(spark, SF_SMALL).collect())) == want


def test_empty_table(spark, no_docs):
    assert suffix.remove_repeats(no_docs).count() == 0


def test_query_against_sql(spark):
    from .sql import same_as_oracle
    from ..conftest import SF_SMOKE

    same_as_oracle(spark, "op2_suffix", SF_SMOKE)
