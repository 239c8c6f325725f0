import collections
import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparkfeat.llm import queries, resampling
from sparkfeat.llm import text as tx

from . import brute
from .sql import same_as_oracle
from ..conftest import SF_SMALL


def _features(text, most):
    w = brute.ALNUM.findall(brute.lower(text or ""))
    return w, [" ".join(w[i:i + n]) for n in range(1, most + 1) for i in range(len(w) - n + 1)]


def _brute(rows, target, most=1, buckets=10000, percent=10, least=20, seed=2024):
    """[(id, n_words, n_features, weight, score)] in input order, and the scores drawn."""
    bucket = lambda g: zlib.crc32(g.encode()) % buckets
    s, t = collections.Counter(), collections.Counter()
    for _, text in rows:
        s.update(map(bucket, _features(text, most)[1]))
    for text in target:
        t.update(map(bucket, _features(text, most)[1]))
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (n_s + buckets) / ((s[b] + 1) * (n_t + buckets))))
    out = []
    for i, text in rows:
        words, grams = _features(text, most)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(bucket(g)) for g in grams)
        out.append((i, len(words), len(grams), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    order = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    return out, order[:percent * len(order) // 100]


@pytest.mark.parametrize("most", [1, 3])
def test_odd_rows(spark, odd_docs, odd_rows, most):
    rows = [(r[0], r[1]) for r in odd_rows]
    target = ["red fox5 hund3", None, "", "shared words and na NA", "δοκιμή3 être7"]
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    want, drawn = _brute(rows, target, most, buckets=500, percent=40)
    got = resampling.resample(odd_docs, bench, max_gram=most, buckets=500, percent=40).collect()
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(want, key=key)
    ranks = sorted((r["rank"], r["doc_id"], r["score"]) for r in got if r["rank"])
    assert ranks == [(k + 1, r[0], r[4]) for k, r in enumerate(drawn)] and drawn


def test_no_gram_crosses_documents():
    texts = ["a b", "c", "", "d e f", "x" * 200 + " y" * 3, "é" * 40 + " z"]
    batch = resampling.Batch(next(tx.chunks(pa.array(texts), 1 << 20)))
    got = [(d, b) for doc, bucket in batch.grams(3, 1 << 31) for d, b in zip(doc.tolist(), bucket.tolist())]
    want = [(i, zlib.crc32(g.encode()) % (1 << 31)) for n in (1, 2, 3) for i, t in enumerate(texts)
            for g in [" ".join(t.split()[k:k + n]) for k in range(len(t.split()) - n + 1)]]
    assert got == want


def test_draw_returns_rows(spark, odd_docs):
    bench = spark.createDataFrame([(0, "cat dog sun")], "item_id long, text string")
    got = resampling.draw(odd_docs.withColumn("rank", F.lit("clash")), bench, percent=50, buckets=100)
    rows = got.orderBy("rank").collect()
    assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1)) and rows
    assert set(odd_docs.columns) <= set(got.columns) and all(r["shard"] == "x" and len(r["text"]) > 20 for r in rows)


def test_ranks_over_many_partitions(spark):
    from sparkfeat.llm.common import global_rank

    df = spark.range(5000, numPartitions=7).select(((F.col("id") * 7919) % 5000).alias("v"))
    got = global_rank(df.repartition(5), [F.desc("v")], "rank").collect()
    assert sorted((r["rank"], r["v"]) for r in got) == [(i + 1, 4999 - i) for i in range(5000)]
    assert len(np.unique([r["rank"] for r in got])) == 5000


def test_empty_tables(spark, odd_docs, no_docs):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert resampling.resample(no_docs, bench).count() == 0
    want, _ = _brute([(1, "one two three")], [])
    got = resampling.resample(odd_docs.where("doc_id = 104"), bench).collect()
    assert [(r["n_words"], r["weight"], r["rank"]) for r in got] == [(3, want[0][3], None)]


def test_query_against_sql(spark):
    same_as_oracle(spark, "op11_resampling", SF_SMALL)
    assert queries.op11_resampling(spark, SF_SMALL).where("rank is not null").count() > 50
