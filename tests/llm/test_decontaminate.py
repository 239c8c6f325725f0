from pyspark.sql import functions as F

from sparkfeat.llm import decontaminate, queries

from . import brute
from ..conftest import SF_SMALL


def _items(odd_rows):
    shared = next(t for i, t, *_ in odd_rows if i == 105).split()
    return [(1, " ".join(shared[10:40])), (2, "ONE two, three"), (10, " ".join(shared[30:70]).upper()), (3, ""), (4, None),
            (None, " ".join(shared[:13])), (2, "one two three"), (5, "one"), (6, "é" * 300), (7, "na na na na")]


def _result(df):
    return sorted(map(str, (tuple(r) for r in df.select(
        "doc_id", "n_words", "n_hit", "n_items", decontaminate.items_digest(F.col("items")), decontaminate.contaminated()).collect())))


def test_odd_rows(spark, odd_docs, odd_rows):
    items = _items(odd_rows)
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    want = sorted(map(str, brute.contamination([(r[0], r[1]) for r in odd_rows], items)))
    assert _result(decontaminate.contamination(odd_docs, bench, ["doc_id"])) == want
    assert _result(decontaminate.contamination(odd_docs, bench, ["doc_id"], block_bytes=300)) == want  # several blocks
    kept = decontaminate.keep_clean(odd_docs, bench)
    assert kept.columns == odd_docs.columns
    assert kept.count() == sum(not eval(w)[5] for w in want)


def test_spans(spark):
    docs = spark.createDataFrame([(1, "a b c d one two three e one two three")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    row = decontaminate.contamination(docs, bench, ["doc_id"]).first()
    assert [tuple(s) for s in row["spans"]] == [(4, 7), (8, 11)]


def test_empty_tables(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(no_docs, none, ["doc_id"]).count() == 0
    got = decontaminate.contamination(odd_docs, none, ["doc_id"])
    assert got.where(decontaminate.contaminated() | (F.col("n_items") > 0)).count() == 0


def test_query_matches_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    got = sorted(tuple(r) for r in queries.op4_decontaminate(spark, SF_SMALL).collect())
    assert got == sorted(brute.contamination(docs, items))
    assert any(r[5] for r in got)
