import math

import pytest

from sparkfeat.llm import quality, queries

from . import brute
from ..conftest import SF_SMALL


def _good_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


def test_base_metrics_on_odd_rows(spark, odd_docs, odd_rows):
    got = quality.quality_rules(odd_docs, _good_labels(spark))
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    rows = got.select("doc_id", *cols, "kept").collect()
    assert sorted(map(str, ((r[0], *r[1:7]) for r in rows))) == sorted(str((i, *brute.quality_base(t))) for i, t, *_ in odd_rows)
    assert all(r["kept"] != r["base_failed"] for r in rows)  # nothing is certified without labels


def test_query_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = {r[0]: brute.quality_base(r[1]) for r in docs}
    got = queries.op8_quality(spark, SF_SMALL).collect()
    assert {r[0]: tuple(r[1:7]) for r in got} == want
    assert not any(r["kept"] and r["base_failed"] for r in got)


def test_empty_table(spark, no_docs):
    assert quality.quality_rules(no_docs, _good_labels(spark)).count() == 0


@pytest.mark.parametrize("k,n,p", [(0, 300, 0.01), (3, 100, 0.05), (50, 5000, 0.01), (10, 10, 0.3)])
def test_binomial_cdf(k, n, p):
    want = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
    assert quality.binomial_cdf(k, n, p) == pytest.approx(want, rel=1e-9)


def test_certified_cutoffs_and_verdict(spark):
    good = " ".join(f"word{i} plain" for i in range(30))
    bad = " ".join(f"w{i}## x$$" for i in range(30))
    rows = [(i, good + f" n{i}", "en") for i in range(2000)] + [(10_000 + i, bad + f" n{i}", "en") for i in range(50)]
    rows += [(20_000 + i, bad + f" n{i}", "de") for i in range(30)]  # too few labels in this stratum
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], int(r[0] < 10_000 or r[0] >= 20_000), 0) for r in rows] + [(None, 1, 0), (3, None, 0)],
                                   "doc_id long, quality int, toxic int")
    kept = {r[0] for r in quality.quality_rules(docs, labels).where("kept").select("doc_id").collect()}
    assert kept == {r[0] for r in rows if r[0] < 10_000 or r[0] >= 20_000}
    scored = quality._scored(docs, ["doc_id"], "lang")
    for c in quality.calibrate(scored, labels, "__stratum").collect():
        assert c["stratum"] == "en" and c["p_value"] <= quality.ERROR_PROBABILITY / len(quality.PRODUCTION_RULES)
        assert quality.binomial_cdf(c["n_rejected"], c["n_good"], quality.MAX_FALSE_REJECTION) == pytest.approx(c["p_value"])


def test_keep_good_keeps_columns(spark, odd_docs):
    kept = quality.keep_good(odd_docs, _good_labels(spark))
    assert kept.columns == odd_docs.columns
    want = quality.quality_rules(odd_docs, _good_labels(spark)).where("kept").count()
    assert kept.count() == want > 5


def test_repeated_rows_and_copies_certify_nothing(spark):
    """Trials must be independent: one document in many rows, or one text under many ids, is one trial."""
    text = " ".join(f"word{i}" for i in range(40))
    for rows in ([(1, text, "en")] * 2000, [(i, text, "en") for i in range(2000)]):
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        labels = spark.createDataFrame([(r[0], 1, 0) for r in rows], "doc_id long, quality int, toxic int")
        assert quality.calibrate(quality._scored(docs, ["doc_id"], "lang"), labels, "__stratum").count() == 0


def test_toxic_texts_are_learned_and_rejected(spark):
    import random

    r = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(r.choices(words, k=40) + (["vile", "nasty"] * 3 if i % 7 == 0 else [])), "en") for i in range(5000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    labels = spark.createDataFrame([(i, 1, int(i % 7 == 0)) for i, *_ in rows if i % 2], "doc_id long, quality int, toxic int")
    kept = {x[0] for x in quality.quality_rules(docs, labels).where("kept").select("doc_id").collect()}
    assert kept == {i for i, *_ in rows if i % 7}
    assert {x[0] for x in quality.keep_good(docs, labels).select("doc_id").collect()} == kept
    assert len(quality.typical_words(docs, labels)) == 2
