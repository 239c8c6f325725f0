"""Importance resampling towards a target distribution, over hashed n-grams.

Both tables are described by counts of their word n-grams in hash buckets
(unsigned CRC-32 of the n-gram's bytes, modulo the number of buckets).  A
bucket's gain is the log ratio of its smoothed shares in target and corpus; a
document's weight is the sum over its n-grams.  Gumbel noise, a function of
the id and the seed, turns the weights into scores whose highest ones are a
draw without replacement in proportion to the likelihood ratio.

A batch's texts are joined with separator sentinels (a byte that no word
holds), one regex pass over the whole finds all words, and a search of the
word places among the document offsets tells each word's document; n-grams
whose first and last word lie in different documents are masked before the
buckets are counted.

The texts are scanned twice (corpus counts, weights).  A task adds one row per
bucket to the counts, so only tables of ``buckets`` rows are gathered.  Scores
are ranked by a range partition of slim rows: offsets of the partitions are
summed, no task holds them all.

Defined cases: a null or empty text has no words, no n-grams and weight 0; a
null id draws its noise from the seed alone and comes last among equal scores;
repeated rows have equal scores and neighbouring ranks in any order; an empty
target or corpus counts as zero n-grams; an empty table gives an empty result.
Columns in ``keep`` come back unchanged, whatever their names but those of the
result.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import text as tx
from .common import global_rank

MAX_GRAM = 1
BUCKETS = 10_000
PERCENT = 10
MIN_WORDS = 20
SEED = 2024

SENTINEL = b"\0"
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Longer words are hashed one by one rather than byte by byte together.
LONG = 48


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1)
    return c


_CRC = _crc_table()


def _extend(crc: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 values continued over the bytes of ``[start, end)``."""
    out = crc.copy()
    length = end - start
    for i in np.flatnonzero(length > LONG).tolist():
        out[i] = zlib.crc32(data[start[i]:end[i]], int(crc[i]))
    order = np.argsort(np.where(length > LONG, 0, length).astype(np.int16), kind="stable")[::-1]
    count = np.bincount(np.where(length > LONG, 0, length), minlength=LONG + 1)
    left = np.cumsum(count[::-1])[::-1]          # words of at least this many bytes
    state, at = ~out[order], start[order]
    for j in range(LONG):
        n = left[j + 1] if j + 1 < len(left) else 0
        if not n:
            break
        s = state[:n]
        state[:n] = (s >> np.uint32(8)) ^ _CRC[(s ^ data[at[:n] + j]) & np.uint32(255)]
    out[order] = ~state
    return out


class Batch:
    """The words of a run of texts, from one pass over their concatenation."""

    def __init__(self, texts: tx.Texts):
        whole, edge = texts.data.tobytes(), texts.offsets.tolist()
        joined = SENTINEL.join([whole[a:b] for a, b in zip(edge, edge[1:])]).lower()  # bytes: A-Z only
        self.data = np.frombuffer(joined, np.uint8)
        spans = np.fromiter((x for m in WORD.finditer(joined) for x in m.span()), np.int64)
        self.start, self.end = spans[::2], spans[1::2]
        begins = texts.offsets[:-1] + np.arange(len(texts))
        self.doc = np.searchsorted(begins, self.start, "right") - 1
        self.docs = len(texts)

    def grams(self, most: int, buckets: int):
        """``(document, bucket)`` arrays of the n-grams of each length up to ``most``."""
        n = len(self.start)
        crc = _extend(np.zeros(n, np.uint32), self.data, self.start, self.end)
        for size in range(1, most + 1):
            if size > 1:
                # The next word of each n-gram that goes on, after one space.
                first, last = self.doc[:max(0, n - size + 1)], self.doc[size - 1:]
                same = first == last
                crc = crc[:len(same)]
                space = np.uint32(32)
                state = ~crc
                crc = ~((state >> np.uint32(8)) ^ _CRC[(state ^ space) & np.uint32(255)])
                crc = _extend(crc, self.data, self.start[size - 1:], self.end[size - 1:])
                yield first[same], crc[same] % np.uint32(buckets)
            else:
                yield self.doc, crc % np.uint32(buckets)


def bucket_counts(docs: DataFrame, text_col: str = "text", max_gram: int = MAX_GRAM, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n``: n-grams of all texts per bucket (buckets without any are left out)."""

    def scan(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for texts in tx.chunks(batch.column(0)):
                for _, bucket in Batch(texts).grams(max_gram, buckets):
                    total += np.bincount(bucket, minlength=buckets)
        own = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), pa.array(total[own])], names=["bucket", "n"])

    found = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(scan, "bucket int, n long")
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of every bucket's smoothed shares, floored."""
    buckets = len(corpus)
    s_all, t_all = float(corpus.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + buckets) / ((s + 1.0) * (t_all + buckets))))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def _dense(counts: DataFrame, buckets: int) -> np.ndarray:
    out = np.zeros(buckets, np.int64)
    for r in counts.collect():  # at most one row per bucket
        out[r["bucket"]] = r["n"]
    return out


def weights(docs: DataFrame, keep: list[str], gain: np.ndarray, text_col: str = "text", max_gram: int = MAX_GRAM) -> DataFrame:
    """``keep`` columns of every row plus ``n_words``, ``n_features`` and ``weight``."""
    schema = docs.select(*keep).schema
    for c in ("n_words", "n_features", "weight"):
        schema = schema.add(c, "long")
    n = len(keep)

    def scan(batches):
        for batch in batches:
            parts = []
            for texts in tx.chunks(batch.column(n)):
                own = Batch(texts)
                edge = np.arange(own.docs + 1)
                found = np.zeros((3, own.docs), np.int64)
                found[0] = np.bincount(own.doc, minlength=own.docs)
                for doc, bucket in own.grams(max_gram, len(gain)):
                    first = np.searchsorted(doc, edge)
                    found[1] += np.diff(first)
                    found[2] += tx.per_text(gain[bucket], first)
                parts.append(found)
            if parts:
                yield pa.RecordBatch.from_arrays([*batch.columns[:n], *map(pa.array, np.concatenate(parts, axis=1))], names=schema.names)

    return docs.select(*keep, F.col(text_col).cast("string").alias("__text")).mapInArrow(scan, schema)


def gumbel(id_col, seed: int = SEED) -> Column:
    """Thousandths of Gumbel noise, floored, from the SHA-256 of ``seed:id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text",
             keep: list[str] | None = None, max_gram: int = MAX_GRAM, buckets: int = BUCKETS, percent: int = PERCENT,
             min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """``id_col``, the columns in ``keep``, ``n_words, n_features, weight, score``
    and ``rank`` of every row.  Of the rows with at least ``min_words`` words the
    ``percent`` hundredths (rounded down) with the highest scores are drawn,
    equal scores by id; ``rank`` is null for the others."""
    own = [id_col, *(keep or [])]
    gain = gains(_dense(bucket_counts(docs, text_col, max_gram, buckets), buckets),
                 _dense(bucket_counts(target, target_text, max_gram, buckets), buckets))
    weighed = weights(docs, own, gain, text_col, max_gram).withColumn("score", F.col("weight") + gumbel(id_col, seed))
    scored = materialize(weighed.withColumn("__row", F.monotonically_increasing_id()), "resample-scored")
    eligible = scored.where(F.col("n_words") >= min_words)
    n_drawn = eligible.count() * percent // 100
    ranked = global_rank(eligible, [F.desc("score"), F.asc_nulls_last(id_col), F.asc("__row")], "rank")
    drawn = F.when(F.col("rank") <= n_drawn, F.col("rank"))
    rest = scored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.withColumn("rank", drawn).unionByName(rest).drop("__row")


def draw(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn rows of ``docs``, all columns, with ``weight``, ``score`` and ``rank``."""
    id_col = options.get("id_col", "doc_id")
    clash = {"n_words", "n_features", "weight", "score", "rank"}
    alias = {c: f"__own{i}" for i, c in enumerate(docs.columns)}
    both = docs.select("*", *[F.col(f"`{c}`").alias(a) for c, a in alias.items()])
    both = both.drop(*clash - {id_col, options.get("text_col", "text")})
    found = resample(both, target, keep=list(alias.values()), **options).where("rank is not null")
    return found.select(*[F.col(a).alias(c) for c, a in alias.items() if c not in ("weight", "score", "rank")], "weight", "score", "rank")
