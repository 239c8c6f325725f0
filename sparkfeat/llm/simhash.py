"""SimHash near-duplicates by a binary-trie self-join.

Fingerprint: word shingles hashed with XXH64 (seed 42); a bit is set if it is
set in over half of the shingles' hashes.  Distinct fingerprints (copies are
collapsed first) are joined with themselves: two trie nodes are walked down
together, differing bits are counted, and a pair of nodes is dropped as soon
as its count exceeds the budget.  The walk is made once for each of
``budget // 2 + 1`` rotations of the bits: errors spread over that many blocks,
so in one rotation the leading block holds at most one of them, which keeps
the number of live node pairs small.  The trie is cut near its root, and
further down where a node is heavy, and each pair of subtrees within the
budget is one group of a Spark shuffle.

Links are not listed: each group returns a star per local component (at most
one row per fingerprint), and the stars are merged into components.

Defined cases: a text without words (null too) has fingerprint zero, which
links like any other; a text of fewer words than a shingle hashes its whole
word sequence; repeated rows and ties share a fingerprint and a component;
null ids are ignored when the smallest id is taken (a component of null ids
only has a null id); an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import text as tx
from .common import connected_components, join_hot, union_all

SEED = 42
BITS = 64
#: Fingerprints that a pair of trie nodes may hold before it is walked further down (8 bytes each).
MOST = 1 << 20


def _fingerprints(texts: tx.Texts, shingle: int) -> np.ndarray:
    words = texts.words(tx.LOWER[texts.data], tx.SPACE)
    joined, start, end = words.joined()
    at = words.windows(shingle)
    first, last = at, at + (shingle - 1)
    short = np.flatnonzero((words.counts > 0) & (words.counts < shingle))
    doc = np.concatenate([words.doc()[at], short])
    first = np.concatenate([first, words.first[short]])
    last = np.concatenate([last, words.first[short + 1] - 1])
    order = np.argsort(doc, kind="stable")
    doc, first, last = doc[order], first[order], last[order]
    whole, digest = joined.tobytes(), xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(whole[a:b], SEED) for a, b in zip(start[first].tolist(), end[last].tolist())),
                         np.uint64, len(first))
    out = np.zeros(len(texts), np.uint64)
    if len(doc):
        begin = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
        n = np.diff(np.append(begin, len(doc)))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_in = np.add.reduceat(bits, begin, axis=0, dtype=np.int32)
        out[doc[begin]] = np.packbits(2 * set_in > n[:, None], axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def fingerprints(docs: DataFrame, keep: list[str], text_col: str = "text", shingle: int = 4,
                 out: str = "fp") -> DataFrame:
    """``keep`` columns of every row plus the signed 64-bit fingerprint ``out``."""
    schema = docs.select(*keep).schema.add(out, "long")

    def scan(batches):
        for batch in batches:
            parts = [_fingerprints(t, shingle) for t in tx.chunks(batch.column(len(keep)))]
            if parts:
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:len(keep)], pa.array(np.concatenate(parts).view(np.int64))], names=schema.names)

    return docs.select(*keep, F.col(text_col).alias("__text")).mapInArrow(scan, schema)


def _local_components(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index of each place's component, by hooking and pointer jumping."""
    label = np.arange(n)
    while len(i):
        low, high = np.minimum(label[i], label[j]), np.maximum(label[i], label[j])
        if np.array_equal(low, high):
            break
        np.minimum.at(label, high, low)
        while not np.array_equal(label, label[label]):
            label = label[label]
    return label


def trie_join(a: np.ndarray, low: tuple[int, int], high: tuple[int, int], depth: int, errors: int, head: int,
              head_budget: int, budget: int, block: int = 1 << 20):
    """Yield ``(i, j)`` index arrays of the sorted distinct fingerprints ``a``
    that differ in at most ``budget`` bits, of those with at most
    ``head_budget`` differences among the first ``head`` bits.  ``low`` and
    ``high`` are the ranges of two nodes at ``depth`` (the same range twice for
    a self-join) that differ in ``errors`` bits so far.  Pairs inside one run
    of neighbours that link one after another are skipped: their component is
    known from ``a`` alone (the caller adds those links)."""
    run = np.concatenate([[0], np.cumsum(np.bitwise_count(a[1:] ^ a[:-1]) > budget)])
    work = [(depth, np.array([[*low, *high, errors]], np.int64))]
    ones: dict[int, np.ndarray] = {}
    while work:
        depth, p = work.pop()
        if len(p) > block:
            work += [(depth, p[:block]), (depth, p[block:])]
            continue
        a0, a1, b0, b1, err = p.T
        known = (run[a0] == run[b1 - 1])  # a0 <= ... <= b1 - 1, and runs are contiguous
        size = (a1 - a0) * (b1 - b0)
        p, size = p[~known], size[~known]
        leaf = (size <= 64) | (depth >= BITS)
        for part in np.array_split(p[leaf], max(1, int(size[leaf].sum()) // (4 * block))):
            a0, a1, b0, b1, _ = part.T
            size_of = (a1 - a0) * (b1 - b0)
            row = np.repeat(np.arange(len(part)), size_of)
            k = np.arange(len(row)) - np.repeat(np.cumsum(size_of) - size_of, size_of)
            wide = (b1 - b0)[row]
            i, j = a0[row] + k // wide, b0[row] + k % wide
            near = (i < j) & (np.bitwise_count(a[i] ^ a[j]) <= budget)
            yield i[near], j[near]
        p = p[~leaf]
        if not len(p):
            continue
        if depth not in ones:
            ones[depth] = np.concatenate([[0], np.cumsum((a >> np.uint64(BITS - 1 - depth)) & np.uint64(1))]).astype(np.int64)
        a0, a1, b0, b1, err = p.T
        am, bm = a1 - (ones[depth][a1] - ones[depth][a0]), b1 - (ones[depth][b1] - ones[depth][b0])
        allowed = head_budget if depth < head else budget
        same = a0 == b0
        more = err + 1
        new = np.concatenate([
            np.stack([a0, am, b0, bm, err], 1), np.stack([am, a1, bm, b1, err], 1),
            np.stack([a0, am, bm, b1, more], 1), np.stack([am, a1, b0, bm, more], 1)[~same]])
        new = new[(new[:, 0] < new[:, 1]) & (new[:, 2] < new[:, 3]) & (new[:, 4] <= allowed)]
        if len(new):
            work.append((depth + 1, new))


def _blocks(budget: int) -> list[tuple[int, int]]:
    """(first bit, width) of the blocks that take turns as the trie's head."""
    n = budget // 2 + 1
    edges = [BITS * i // n for i in range(n + 1)]
    return [(edges[i], edges[i + 1] - edges[i]) for i in range(n)]


def _rotated(x: np.ndarray, by: int) -> np.ndarray:
    return x if by == 0 else (x << np.uint64(by)) | (x >> np.uint64(BITS - by))


def _prefix(fp, first: int, depth: int) -> F.Column:
    """The leading ``depth`` bits of the fingerprint rotated to start at bit ``first``."""
    x = fp if first == 0 else F.shiftleft(fp, first).bitwiseOR(F.shiftrightunsigned(fp, BITS - first))
    return F.shiftrightunsigned(x, BITS - depth) if depth < BITS else x


def _pair(node, other) -> tuple[F.Column, F.Column]:
    return F.least(node, other).alias("x"), F.greatest(node, other).alias("y")


def _deeper(dealt: DataFrame, depth: int, step: int, blocks: list[tuple[int, int]], budget: int) -> DataFrame:
    """Rows of node pairs at ``depth``, dealt to the pairs of their subtrees
    ``step`` bits further down that stay within the error budget."""
    to = depth + step
    by_rotation = lambda make: F.element_at(F.array(*[make(*block) for block in blocks]), F.col("r") + 1)
    node = by_rotation(lambda first, _: _prefix(F.col("fp"), first, depth))
    below = by_rotation(lambda first, _: _prefix(F.col("fp"), first, to))
    partner = F.shiftleft(F.col("x").bitwiseXOR(F.col("y")).bitwiseXOR(node), step)
    moved = dealt.withColumn("node", below).withColumn(
        "other", F.explode(F.transform(F.sequence(F.lit(0), F.lit((1 << step) - 1)), lambda b: partner.bitwiseOR(b.cast("long")))))
    differ = F.col("node").bitwiseXOR(F.col("other"))
    in_head = by_rotation(lambda _, head: F.bit_count(F.shiftrightunsigned(differ, max(0, to - head))))
    return (moved.where((F.bit_count(differ) <= budget) & (in_head <= min(1, budget)))
            .select("fp", "r", F.lit(to).alias("depth"), *_pair(F.col("node"), F.col("other"))))


def _dealt(distinct: DataFrame, budget: int, subtree: int, most: int, blocks: list[tuple[int, int]]) -> DataFrame:
    """``fp, r, depth, x, y``: every fingerprint in the node pairs that it can
    have links in.  All pairs are cut at one depth near the root, but pairs of a
    node of over ``most / 2`` fingerprints: these are walked further down, a few bits a
    round, until no pair holds more than ``most`` (two fingerprints are left at
    the last bit)."""
    n = distinct.count()
    cut = min(16, blocks[0][1], max(1, (max(1, n) // subtree).bit_length()))
    nodes = distinct.select("fp", F.posexplode(F.array(*[_prefix(F.col("fp"), first, cut) for first, _ in blocks])).alias("r", "node"))
    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << b).cast("long") for b in range(cut)])
    pairs = (nodes.withColumn("other", F.explode(flips)).withColumn("other", F.col("node").bitwiseXOR(F.col("other")))
             .select("fp", "r", F.lit(cut).alias("depth"), *_pair(F.col("node"), F.col("other"))))
    # At most 2 ** 16 nodes a rotation, so this table is bounded whatever the data.
    heavy = materialize(nodes.groupBy("r", "node").agg(F.count(F.lit(1)).alias("n"))
                        .where(2 * F.col("n") > most).select("r", "node"), "simhash-heavy")
    if not heavy.head(1):
        return pairs
    of_x = heavy.select("r", F.col("node").alias("x"), F.lit(True).alias("__x"))
    of_y = heavy.select("r", F.col("node").alias("y"), F.lit(True).alias("__y"))
    marked = pairs.join(F.broadcast(of_x), ["r", "x"], "left").join(F.broadcast(of_y), ["r", "y"], "left")
    is_heavy = F.coalesce("__x", "__y").isNotNull()
    columns = ["fp", "r", "depth", "x", "y"]
    parts = [marked.where(~is_heavy).select(*columns)]
    level, depth = materialize(marked.where(is_heavy).select(*columns), "simhash-level"), cut
    while depth < BITS:
        step = min(4, BITS - depth)
        level = materialize(_deeper(level, depth, step, blocks, budget), "simhash-level")
        depth += step
        large = materialize(level.groupBy("r", "x", "y").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most)
                            .select("r", "x", "y", F.lit(True).alias("__large")), "simhash-large")
        if not large.head(1):
            break
        split = materialize(join_hot(level, large, ["r", "x", "y"]), "simhash-split")
        parts.append(split.where(F.col("__large").isNull()).select(*columns))
        level = split.where(F.col("__large").isNotNull()).select(*columns)
    return union_all([*parts, level])


def links(distinct: DataFrame, budget: int, subtree: int = 4096, most: int = MOST) -> DataFrame:
    """``u, v``: edges that connect exactly the fingerprints (column ``fp``,
    distinct) whose chains of links of at most ``budget`` bits connect."""
    blocks = _blocks(budget)

    def join(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        r, depth = int(key[0]), int(key[1])
        x, y = sorted(int(k) & (1 << BITS) - 1 for k in key[2:])
        first, head = blocks[r]
        plain = rows["fp"].to_numpy().view(np.uint64)
        a = _rotated(plain, first)
        order = np.argsort(a)
        a, plain = a[order], plain[order]
        mid = int(np.searchsorted(a >> np.uint64(BITS - depth), np.uint64(x), "right"))
        whole = (0, len(a))
        low, high = (whole, whole) if x == y else ((0, mid), (mid, len(a)))
        if low[0] == low[1] or high[0] == high[1]:
            return pd.DataFrame({"u": [], "v": []}, dtype="int64")
        chain = np.flatnonzero(np.bitwise_count(a[1:] ^ a[:-1]) <= budget)
        found = [(chain, chain + 1), *trie_join(a, low, high, depth, (x ^ y).bit_count(), head, min(1, budget), budget)]
        label = _local_components(len(a), *(np.concatenate(side) for side in zip(*found)))
        member = np.flatnonzero(label != np.arange(len(a)))
        return pd.DataFrame({"u": plain[member].view(np.int64), "v": plain[label[member]].view(np.int64)})

    return _dealt(distinct, budget, subtree, most, blocks).groupBy("r", "depth", "x", "y").applyInPandas(join, "u long, v long")


def _classes(rows: DataFrame, id_col: str, max_bits: int) -> DataFrame:
    """``fp, root, component_id`` of every distinct fingerprint of ``rows``."""
    distinct = materialize(rows.groupBy("fp").agg(F.min(id_col).alias("__least")), "simhash-distinct")
    root = connected_components(links(distinct.select("fp"), max_bits))
    of = distinct.join(root.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = of.groupBy("root").agg(F.min("__least").alias("component_id"))
    of = join_hot(materialize(of, "simhash-roots"), least, ["root"])
    return materialize(of.select("fp", "root", "component_id"), "simhash-components")


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
               max_bits: int = 4) -> DataFrame:
    """``id_col, fp, root, component_id`` for every row: the component's
    smallest fingerprint and the smallest id that a chain of links of at most
    ``max_bits`` bits reaches, the row itself included."""
    rows = materialize(fingerprints(docs, [id_col], text_col, shingle), "simhash")
    return join_hot(rows, _classes(rows, id_col, max_bits), ["fp"])


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
             max_bits: int = 4) -> DataFrame:
    """One row of each component, all columns: the one of the smallest id (null
    last), then of the smallest text hash; of rows equal in both, the first in
    the order of the other columns.  The texts are shuffled once, to meet the
    chosen keys."""
    own = docs.columns
    key = F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1))
    keyed = docs.select("*", key.alias("__k"), F.xxhash64(text_col).alias("__h"))
    rows = materialize(fingerprints(keyed, [id_col, "__k", "__h"], text_col, shingle), "simhash")
    found = join_hot(rows, _classes(rows, id_col, max_bits), ["fp"])
    equal = found.groupBy("root", "__k", "__h").agg(F.count(F.lit(1)).alias("__n"))
    chosen = materialize(equal.groupBy("root").agg(F.min(F.struct("__k", "__h", "__n")).alias("c")).select("c.*"), "simhash-chosen")
    kept = join_hot(keyed, chosen, ["__k", "__h"], counted=rows)
    single = kept.where("__n = 1").select(*own)
    if not chosen.where("__n > 1").head(1):
        return single
    # Rows of equal id and text: the least is found by partial aggregation, so none of them gather.
    order = [c for c in own if c not in (id_col, text_col)] + [id_col, text_col]
    least = F.min(F.struct(*[F.col(f"`{c}`") for c in order])).alias("__row")
    repeated = kept.where("__n > 1").groupBy("__k", "__h").agg(least)
    return single.unionByName(repeated.select(*[F.col("__row")[c].alias(c) for c in own]))
