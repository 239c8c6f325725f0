import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from sparkfeat.llm import language, queries
from sparkfeat.llm import text as tx

from ..conftest import SF_SMALL


def test_query_is_right_on_held_out_texts(spark):
    truth = {r[0]: (r[1], r[2]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "lang", "text").collect()}
    got = queries.op3_language(spark, SF_SMALL).collect()
    assert {r["doc_id"] for r in got} == set(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"] and truth[r["doc_id"]][0]]
    right = sum(r["lang_pred"] == truth[r["doc_id"]][0] for r in held)
    assert len(held) > 150 and right / len(held) > 0.98


def test_kernel_against_sets(spark):
    rows = [("the cat and the dog", "a"), ("der hund und die katze", "b"), ("le chat noir ét", "c"), ("a", "a"), ("der", "b")]
    model = language.fit(["a", "b", "c"], rows, landmarks=2)
    plain = lambda t: bytes(language._PLAIN[np.frombuffer(t.encode(), np.uint8)])
    grams = lambda b: {b[i:i + n] for n in (1, 2, 3) for i in range(len(b) - n + 1)}
    marks = [grams(plain(t)) for t, _ in (rows[0], rows[1], rows[2], rows[3], rows[4])]
    known = set().union(*marks)
    texts = ["the dog", "", "zzz katze 12 noir", "é"]
    got = model.kernel(next(tx.chunks(pa.array(texts), 1 << 30)))
    for t, row in zip(texts, got):
        own = grams(plain(t)) & known
        want = [len(own & m) / max(1, len(own)) ** 0.5 / len(m) ** 0.5 for m in marks]
        assert np.allclose(row, want, atol=1e-6)


def test_odd_rows(spark, odd_docs, odd_rows):
    got = language.identify(odd_docs).collect()
    assert len(got) == len(odd_rows)
    letterless = {i for i, t, *_ in odd_rows if t is None or not any(c.isalpha() for c in t)}
    for r in got:
        if r["doc_id"] is not None:
            assert (r["lang_pred"] == "und") == (r["doc_id"] in letterless)
        else:
            assert not r["held_out"]
    assert {r["lang_pred"] for r in got} <= {"en", "de", "fr", "und"}


def test_nothing_to_learn(spark, odd_docs, no_docs):
    assert language.identify(no_docs).count() == 0
    got = language.identify(odd_docs.withColumn("lang", F.lit(None).cast("string")))
    assert {(r["lang_pred"], r["score"]) for r in got.collect()} == {("und", 0.0)}


def test_more_tags_than_are_learned(spark):
    """300 tags, 10,000 empty texts: every row comes back, the most frequent tags are learned."""
    rows = [(i, f"word{i % 300} {'abcdefghij'[i % 10] * 3} text", f"t{i % 300:03d}") for i in range(900)]
    rows += [(1000 + i, f"common words here {i}", "t007") for i in range(50)] + [(5000 + i, "", "t001") for i in range(10000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language.identify(docs, per_language=5, landmarks=1).collect()
    assert len(got) == len(rows)
    assert {r["lang_pred"] for r in got if r["doc_id"] >= 5000} == {"und"}
    few = language.learn(docs, per_language=5, landmarks=1, max_languages=2)
    assert few.languages == ["t001", "t007"]
    full = language.learn(docs, per_language=5, landmarks=1)
    assert len(full.languages) <= language.MAX_LANGUAGES and "t007" in full.languages


def test_sample_is_bounded_in_bytes(spark):
    rows = [(i, ("de " if i % 2 else "en ") * 400 + str(i), "de" if i % 2 else "en") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen = []
    fit, language.fit = language.fit, lambda languages, rows, *a, **k: seen.append(rows) or fit(languages, rows, *a, **k)
    try:
        model = language.learn(docs, sample_bytes=20000)
    finally:
        language.fit = fit
    assert sorted(model.languages) == ["de", "en"]
    size = {name: sum(len(t) for t, n in seen[0] if n == name) for name in ("de", "en")}
    assert all(5000 < n <= 10000 for n in size.values())


def test_model_against_plain_ridge():
    """Sets, dense matrices and a plain solver give the same scores."""
    rows = [("the cat sat on the mat", "a"), ("der hund lag auf der matte", "b"), ("the dog ran", "a"), ("die katze rennt", "b"), ("le chat dort", "c"),
            ("un chien court", "c")]
    model = language.fit(["a", "b", "c"], rows, landmarks=1, ridge=0.01)
    plain = lambda t: bytes(language._PLAIN[np.frombuffer(t.encode(), np.uint8)])
    grams = lambda b: {b[i:i + n] for n in (1, 2, 3) for i in range(len(b) - n + 1)}
    marks = [grams(plain(t)) for t in (rows[0][0], rows[1][0], rows[4][0])]
    known = set().union(*marks)

    def kernel(t):
        own = grams(plain(t)) & known
        return [len(own & m) / max(1, len(own)) ** 0.5 / len(m) ** 0.5 for m in marks]

    k, among = np.array([kernel(t) for t, _ in rows]), np.array([kernel(t) for t in (rows[0][0], rows[1][0], rows[4][0])])
    value, vector = np.linalg.eigh(among)
    z = k @ vector / np.sqrt(value)
    out = []
    for name in "abc":
        y = np.array([1.0 if n == name else -1.0 for _, n in rows])
        w = np.full(len(rows), 1 / 2)
        out.append(np.linalg.solve(z.T @ np.diag(w) @ z + 0.01 * np.eye(3), z.T @ (w * y)))
    for t in ("the cat", "katze und hund", "chat", ""):
        want = (np.array(kernel(t)) @ vector / np.sqrt(value)) @ np.array(out).T
        got = model.scores(next(tx.chunks(pa.array([t]), 1 << 30)))[0]
        assert np.allclose(got, want, atol=1e-3)
