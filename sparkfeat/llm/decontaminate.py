"""Benchmark decontamination by a prefix-filtered set join.

A benchmark window (13 consecutive words of an item; a shorter item is one
window) occurs in a document only if all its word shingles do.  Shingles are
ordered by rarity, the number of documents that hold them, counted over the
whole corpus.  Full containment makes the necessary prefix of a window its
single rarest shingle: the documents' shingles are joined on those, the place
of the shingle inside the window fixes where the window must start (positional
bound) and end inside the document (length bound), and what is left is
verified word by word, then byte by byte.

The benchmark is a stated query set.  It is measured first and met in blocks
of at most ``block_bytes`` of text; each block's index is broadcast, so the
documents are never shuffled and no block is larger than the bound.

Defined cases: null texts have no words; items without words have no window;
items are told apart by id, so repeated items count once; all items of a null
id are one item without a name; an empty benchmark leaves every document clean; an
empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from . import text as tx

WINDOW = 13
SHINGLE = 3
BLOCK_BYTES = 16 << 20


@dataclass
class Block:
    """The windows of one block of items, and the index on their prefix shingles."""
    names: list[list]         # of each distinct window: the items that hold it
    texts: list[bytes]             # its words, joined by one space
    words: np.ndarray              # (windows, WINDOW) word hashes
    length: np.ndarray             # words of each window
    shingles: np.ndarray           # sorted distinct (shingle, size) hashes of all windows
    of_window: list[np.ndarray]    # of each window: the indexes of its shingles, in order
    prefix: np.ndarray | None = None    # sorted hashes of the rarest shingles
    begin: np.ndarray | None = None     # first entry of each in ``window`` / ``offset``
    window: np.ndarray | None = None
    offset: np.ndarray | None = None


def _texts(strings: list[str]) -> tx.Texts | None:
    return next(tx.chunks(pa.array(strings, pa.string()), 1 << 62), None)


def _sized(words_hash: np.ndarray, size: int) -> np.ndarray:
    """Shingle hashes of ``size`` words at every word (crossing texts too)."""
    return tx.mix(tx.Rolling(words_hash).grams(size) + np.uint64(size))


def read_block(items: list[tuple[str, str]], window: int, shingle: int) -> Block:
    texts = _texts([t for _, t in items])
    names: dict[bytes, list[str]] = {}
    if texts is not None:
        words = texts.words(tx.LOWER[texts.data], tx.NOT_ALNUM)
        joined, start, end = words.joined()
        whole = joined.tobytes()
        for d, (name, _) in enumerate(items):
            lo, hi = int(words.first[d]), int(words.first[d + 1])
            for w in range(lo, max(hi - window, lo) + 1 if hi > lo else lo):
                names.setdefault(whole[start[w]:end[min(w + window, hi) - 1]], []).append(name)
    keys = sorted(names)
    parsed = _texts([k.decode() for k in keys])
    table = np.zeros((len(keys), window), np.uint64)
    length = np.zeros(len(keys), np.int64)
    of_window = []
    if parsed is not None:
        words = parsed.words(parsed.data, tx.NOT_ALNUM)
        hashes, length = words.hashes(), words.counts.astype(np.int64)
        for i in range(len(keys)):
            own = hashes[words.first[i]:words.first[i + 1]]
            table[i, :len(own)] = own
            of_window.append(_sized(own, min(shingle, len(own))))
    shingles = np.unique(np.concatenate(of_window)) if of_window else np.zeros(0, np.uint64)
    return Block([list(set(names[k])) for k in keys], keys, table, length, shingles,
                 [np.searchsorted(shingles, s) for s in of_window])


def order_by_rarity(block: Block, frequency: np.ndarray) -> None:
    """Choose each window's prefix: its rarest shingle (ties: smallest hash)."""
    rank = np.empty(len(block.shingles), np.int64)
    rank[np.argsort(frequency, kind="stable")] = np.arange(len(block.shingles))
    entries = []
    for w, own in enumerate(block.of_window):
        at = int(np.argmin(rank[own]))
        entries.append((int(own[at]), w, at))
    entries.sort()
    key = np.array([e[0] for e in entries], np.int64)
    used, begin = np.unique(key, return_index=True)
    block.prefix, block.begin = block.shingles[used], np.append(begin, len(entries))
    block.window = np.array([e[1] for e in entries], np.int64)
    block.offset = np.array([e[2] for e in entries], np.int64)


def _places(words: tx.Words, hashes: np.ndarray, wanted: np.ndarray, sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """``(word, index into wanted)`` wherever a shingle of the text is wanted."""
    at, which = [], []
    low = np.zeros(1 << 20, bool)
    low[(wanted & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
    for size in sizes:
        starts = words.windows(size)
        got = _sized(hashes, size)[starts] if len(starts) else np.zeros(0, np.uint64)
        maybe = np.flatnonzero(low[(got & np.uint64((1 << 20) - 1)).astype(np.int64)])
        found = np.searchsorted(wanted, got[maybe])
        found[found == len(wanted)] = 0
        hit = wanted[found] == got[maybe] if len(wanted) else np.zeros(0, bool)
        at.append(starts[maybe[hit]])
        which.append(found[hit])
    return np.concatenate(at), np.concatenate(which)


def _occurrences(words: tx.Words, hashes: np.ndarray, block: Block, sizes: list[int]):
    """``(first word, window)`` of every verified occurrence."""
    at, key = _places(words, hashes, block.prefix, sizes)
    many = block.begin[key + 1] - block.begin[key]
    entry = np.repeat(block.begin[key] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
    window = block.window[entry]
    start = np.repeat(at, many) - block.offset[entry]
    doc = np.repeat(np.searchsorted(words.first, at, "right") - 1, many)
    length = block.length[window]
    inside = (start >= words.first[doc]) & (start + length <= words.first[doc + 1])
    start, window, length, doc = start[inside], window[inside], length[inside], doc[inside]
    for i in range(block.words.shape[1]):
        in_window = i < length
        same = ~in_window | (hashes[np.where(in_window, start + i, 0)] == block.words[window, i])
        start, window, length, doc = start[same], window[same], length[same], doc[same]
    if not len(start):
        return start, window, doc
    data = words.data
    exact = np.fromiter(
        (b" ".join(data[words.starts[j]:words.ends[j]].tobytes() for j in range(s, s + n)) == block.texts[w]
         for s, n, w in zip(start.tolist(), length.tolist(), window.tolist())), bool, len(start))
    return start[exact], window[exact], doc[exact]


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int):
    """Items of each block, collected one block at a time (each within the bound,
    but for a single longer item)."""
    rows = benchmark.select(F.col(item_col).cast("string").alias("name"), F.col(text_col).alias("t")).where("t is not null")
    total = rows.agg(F.sum(F.octet_length("t") + 8)).first()[0] or 0
    n = max(1, -(-2 * total // block_bytes)) if total > block_bytes else 1
    if n > 1:
        rows = materialize(rows.withColumn("b", F.pmod(F.xxhash64("name", "t"), F.lit(n))), "benchmark")
    for b in range(n):
        part = rows if n == 1 else rows.where(F.col("b") == b)
        yield [(r["name"], r["t"]) for r in part.select("name", "t").collect()]


def contamination(docs: DataFrame, benchmark: DataFrame, keep: list[str], text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                  shingle: int = SHINGLE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``keep`` columns of every row plus ``n_words``, ``n_hit``, ``n_items``,
    ``items`` (names of the items with occurring windows, sorted) and
    ``spans`` (maximal runs of hit words, as start and end).  The whole texts are
    read twice: shingle frequencies, then the join."""
    spark: SparkSession = docs.sparkSession
    context = spark.sparkContext
    shared = []
    for items in _blocks(benchmark, item_col, item_text_col, block_bytes):
        block = read_block([(n, t) for n, t in items], window, shingle)
        sizes = sorted({min(shingle, int(n)) for n in np.unique(block.length)}) or [shingle]
        if not len(block.shingles):
            continue
        index = context.broadcast(block.shingles)

        def count(batches, index=index, sizes=sizes):
            total = np.zeros(len(index.value), np.int64)
            for batch in batches:
                for texts in tx.chunks(batch.column(0)):
                    words = texts.words(tx.LOWER[texts.data], tx.NOT_ALNUM)
                    at, which = _places(words, words.hashes(), index.value, sizes)
                    doc = np.searchsorted(words.first, at, "right") - 1
                    total += np.bincount(np.unique(doc * len(total) + which) % len(total), minlength=len(total))
            held = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["shingle", "n"])

        counts = (docs.select(F.col(text_col).alias("__text")).mapInArrow(count, "shingle long, n long")
                  .groupBy("shingle").agg(F.sum("n").alias("n")).collect())  # at most the block's shingles
        frequency = np.zeros(len(block.shingles), np.int64)
        for r in counts:
            frequency[r["shingle"]] = r["n"]
        order_by_rarity(block, frequency)
        block.of_window = []
        shared.append((context.broadcast(block), sizes))

    schema = docs.select(*keep).schema
    for name in ("n_words", "n_hit", "n_items"):
        schema = schema.add(name, "long")
    span = T.StructType().add("start", "long").add("end", "long")
    schema = schema.add("items", T.ArrayType(T.StringType())).add("spans", T.ArrayType(span))

    def judge(batches):
        for batch in batches:
            n_words, n_hit, items, n_items, spans = [], [], [], [], []
            for texts in tx.chunks(batch.column(len(keep))):
                words = texts.words(tx.LOWER[texts.data], tx.NOT_ALNUM)
                hashes = words.hashes()
                found: list[set] = [set() for _ in range(len(texts))]
                delta = np.zeros(len(words) + 1, np.int64)
                for handle, sizes in shared:
                    block = handle.value
                    start, win, doc = _occurrences(words, hashes, block, sizes)
                    np.add.at(delta, start, 1)
                    np.add.at(delta, start + block.length[win], -1)
                    for d, w in np.unique(np.stack([doc, win], 1), axis=0).tolist():
                        found[d].update(block.names[w])
                hit = np.cumsum(delta[:-1]) > 0
                runs = [[] for _ in range(len(texts))]
                edge = tx.Texts(None, words.first, 0).runs(hit) if hit.any() else (np.zeros(0, np.int64),) * 2
                for s, e, d in zip(*edge, np.searchsorted(words.first, edge[0], "right") - 1):
                    runs[d].append({"start": int(s - words.first[d]), "end": int(e - words.first[d])})
                n_words.append(words.counts)
                n_hit.append(tx.per_text(hit, words.first))
                n_items += [len(x) for x in found]
                items += [sorted(x - {None}) for x in found]
                spans += runs
            if n_words:
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:len(keep)], *(pa.array(np.concatenate(c).astype(np.int64)) for c in (n_words, n_hit)),
                     pa.array(n_items, pa.int64()), pa.array(items, pa.list_(pa.string())),
                     pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                    names=schema.names)

    return docs.select(*keep, F.col(text_col).alias("__text")).mapInArrow(judge, schema)


def contaminated() -> F.Column:
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns, that are not contaminated."""
    own = {c: f"__own{i}" for i, c in enumerate(docs.columns)}
    renamed = docs.select(*[F.col(f"`{c}`").alias(o) for c, o in own.items()])
    judged = contamination(renamed, benchmark, list(own.values()), own[text_col], **options)
    return judged.where(~contaminated()).select(*[F.col(o).alias(c) for c, o in own.items()])


def items_digest(names: F.Column) -> F.Column:
    return F.sha2(F.concat_ws(",", names), 256)

