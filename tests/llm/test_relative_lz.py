from pyspark.sql import functions as F

from sparkfeat.llm import blocks, queries, relative_lz

from . import brute
from ..conftest import SF_SMALL


def _rows(df):
    return df.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256)).collect()


def test_odd_rows(spark, odd_docs, odd_rows, monkeypatch):
    rows = [(r[0], r[1]) for r in odd_rows]
    want = {key: tuple(rest) for key, *rest in brute.repeated_words(rows)}
    want = sorted(map(str, ((r[0], *want[r]) for r in rows)))
    assert sorted(map(str, map(tuple, _rows(relative_lz.parse(odd_docs))))) == want
    # Many small groups and runs give the same result.
    monkeypatch.setattr(blocks, "GROUP_BYTES", 3000)
    monkeypatch.setattr(relative_lz, "keyed", lambda *a: blocks.keyed(*a, 3000))
    monkeypatch.setattr(relative_lz, "gathered", lambda k, c: blocks.gathered(k, c, 2000))
    assert sorted(map(str, map(tuple, _rows(relative_lz.parse(odd_docs))))) == want


def test_factors_point_to_equal_words(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    words = {i: brute.SPACE.findall(t or "") for i, t in docs}
    seen = 0
    for r in relative_lz.parse(spark.read.parquet(f"{SF_SMALL}/documents.parquet")).where("n_removed > 0").collect():
        for f in r["factors"]:
            assert f["words"] >= 20 and (f["ref_k"], f["ref_start"]) < (r["doc_id"], f["start"])
            assert (words[r["doc_id"]][f["start"]:f["start"] + f["words"]]
                    == words[f["ref_k"]][f["ref_start"]:f["ref_start"] + f["words"]])
            seen += 1
    assert seen > 50


def test_query_matches_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    want = sorted((key[0], *rest) for key, *rest in brute.repeated_words(docs))
    assert sorted(map(tuple, queries.op10_relative_lz(spark, SF_SMALL).collect())) == want


def test_empty_table(spark, no_docs):
    assert relative_lz.parse(no_docs).count() == 0
