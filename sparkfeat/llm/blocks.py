"""Documents in groups of a bounded number of bytes, dealt by a hash of their
key, and compact tables that travel between groups.

Whole texts and index entries are shuffled as compressed column blocks (one
row per task and target group) instead of one row each: the shuffle stays
small and tasks work on arrays.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import text as tx

GROUP_BYTES = 8 << 20
#: Texts that a task gathers before it deals them (and its own index entries) out.
BLOCK_BYTES = 8 << 20


@dataclass
class Keyed:
    """``docs`` with an order-preserving unique key ``k`` (long) and ``text``;
    ``rows`` has ``id_col`` and ``k`` of every input row."""
    docs: DataFrame
    rows: DataFrame
    groups: int
    unique: bool


def keyed(docs: DataFrame, id_col: str, text_col: str, group_bytes: int = GROUP_BYTES) -> Keyed:
    """Order documents by id (null last).  Where every id is there and unique it
    is the key itself.  Otherwise rows of equal id and text are one document,
    rows of equal id and different texts follow in the order of the texts'
    64-bit hashes, and keys come from the sorted distinct pairs."""
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    size = slim.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    groups = max(1, -(-int(size) // group_bytes))
    odd = slim.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or id is null")
    if not odd.head(1):
        plain = slim.select(F.col("id").alias("k"), "text")
        return Keyed(plain, plain.select(F.col("k").alias(id_col), "k"), groups, True)
    slim = slim.withColumn("h", F.xxhash64("text"))
    pairs = slim.groupBy("id", "h").agg(F.count(F.lit(1)).alias("n")).orderBy(F.asc_nulls_last("id"), "h")
    pairs = materialize(pairs.withColumn("k", F.monotonically_increasing_id()), "order-keys")
    match = slim["id"].eqNullSafe(pairs["id"]) & (slim["h"] == pairs["h"])
    found = slim.join(pairs, match).select("k", slim["id"].alias(id_col), "text")
    one = materialize(found.groupBy("k").agg(F.min("text").alias("text")), "order-texts")
    return Keyed(one, materialize(found.select(id_col, "k"), "order-rows"), groups, False)


def with_ids(found: DataFrame, keyed_docs: Keyed, id_col: str) -> DataFrame:
    """Results per key as results per input row."""
    if keyed_docs.unique:
        return found.withColumnRenamed("k", id_col)
    return keyed_docs.rows.join(found, "k").drop("k")


def pack(a: np.ndarray) -> bytes:
    """Differences of an integer array, compressed."""
    return zstandard.compress(np.diff(a, prepend=a.dtype.type(0)).tobytes(), 1)


def unpack(b: bytes, dtype) -> np.ndarray:
    return np.cumsum(np.frombuffer(zstandard.decompress(b), dtype), dtype=dtype)


def home(k: np.ndarray, groups: int) -> np.ndarray:
    """Group of each document key."""
    return (tx.mix(k.astype(np.int64).view(np.uint64)) % np.uint64(groups)).astype(np.int64)


def by_target(target: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Stable order of the entries by target and where each target begins."""
    order = np.argsort(target.astype(np.uint16 if n < 1 << 16 else np.int64), kind="stable")
    return order, np.searchsorted(target[order], np.arange(n + 1))


def in_order(batches, slice_bytes: int = BLOCK_BYTES):
    """``(k, column)`` of parts of each batch, rows sorted by key; a part is a
    copy of about ``slice_bytes``, so that a large batch is not held twice."""
    for batch in batches:
        k = batch.column(0).to_numpy(zero_copy_only=False)
        order = np.argsort(k, kind="stable")
        size = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(size[order], dtype=np.int64) // slice_bytes
        edge = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(order)]])
        for at, to in zip(edge[:-1].tolist(), edge[1:].tolist()):
            own = order[at:to]
            yield k[own], batch.column(1).take(pa.array(own))


def gathered(k: np.ndarray, column: pa.Array, block_bytes: int = BLOCK_BYTES):
    """``(k, list of Texts)`` runs of about ``block_bytes``."""
    some, keys, size = [], [], 0
    for texts in tx.chunks(column):
        some.append(texts)
        keys.append(k[texts.first:texts.first + len(texts)])
        size += len(texts.data)
        if size >= block_bytes:
            yield np.concatenate(keys), some
            some, keys, size = [], [], 0
    if some:
        yield np.concatenate(keys), some


def deal_texts(docs: DataFrame, groups: int) -> DataFrame:
    """``home, k, size, texts``: the documents of each task and group as one row
    (keys, byte lengths and concatenated texts, compressed)."""

    def scan(batches):
        for k, column in in_order(batches):
            for keys, some in gathered(k, column):
                data = np.concatenate([t.data for t in some])
                size = np.concatenate([np.diff(t.offsets) for t in some])
                end = np.cumsum(size)
                order, begin = by_target(home(keys, groups), groups)
                out = []
                whole = data.tobytes()
                for g in np.flatnonzero(np.diff(begin)):
                    own = order[begin[g]:begin[g + 1]]
                    texts = b"".join(whole[end[i] - size[i]:end[i]] for i in own.tolist())
                    out.append((int(g), pack(keys[own]), pack(size[own]), zstandard.compress(texts, 3)))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                    zip(*out), (pa.int32(), pa.binary(), pa.binary(), pa.binary()))], names=["home", "k", "size", "texts"])

    return docs.select("k", "text").mapInArrow(scan, "home int, k binary, size binary, texts binary")


def dealt_texts(table: pa.Table):
    """``(k, Texts)`` pairs of a group's rows, keys ascending within each."""
    for row in table.to_pylist():
        k, size = unpack(row["k"], np.int64), unpack(row["size"], np.int64)
        data = np.frombuffer(zstandard.decompress(row["texts"]), np.uint8)
        end = np.concatenate([[0], np.cumsum(size)])
        at = 0
        while at < len(k):
            to = min(max(int(np.searchsorted(end, end[at] + tx.CHUNK_BYTES, "right")) - 1, at + 1), len(k))
            yield k[at:to], tx.Texts(data[end[at]:end[to]], end[at:to + 1] - end[at], at)
            at = to
