"""Repeated passages by relative Lempel-Ziv parsing.

The collection is its own reference.  Its seeds, all runs of ``window`` words
(a factor must be at least that long to count), are indexed in reference
blocks: each block owns the seeds of one hash range and knows the first place
of each.  Every document is looked up in every block (a seed can only be in
the block that owns it) and then parsed from left to right: a factor starts at
a word whose seed has an earlier place and grows as long as the next seed
continues at the same place of the reference.  Seeds that straddle the end of
a factor are looked up like any other, so words that only a straddling match
covers are found too (the check at factor boundaries).  Factors are the
duplicate spans.

A task first parses its own run of documents against itself and sends only the
first place of each of its seeds to the index, so a passage that a third of
all documents share reaches its block once per task run, not once per document.
Seeds are told apart by 64 bits plus the block, which is chosen by an
independent hash; blocks grow in number with the input.

Defined cases: null and empty texts have no words; documents are ordered by id
(null last); rows of equal id and text are one document and share its result;
rows of equal id and different text are documents of their own, in the order
of their texts' 64-bit hashes; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import text as tx
from .blocks import by_target, deal_texts, dealt_texts, gathered, home, in_order, keyed, pack, unpack, with_ids

WINDOW = 20
#: Columns of a factor: document, first seed, number of seeds, reference document, its first seed.
FACTOR = ("k", "start", "seeds", "ref_k", "ref_start")


def _seeds(texts: tx.Texts, window: int):
    """Per seed: text, place, hash, and a second hash for the choice of its block."""
    words = texts.words(texts.data, tx.SPACE)
    at = words.windows(window)
    hashes = words.hashes()
    doc = np.repeat(np.arange(len(texts)), np.maximum(words.counts - (window - 1), 0))
    other = hashes * np.uint64(0xD6E8FEB86659FD93) ^ (hashes >> np.uint64(31))
    return (doc, (at - words.first[doc]).astype(np.uint32), tx.Rolling(hashes).spans(at, at + window),
            tx.Rolling(other).spans(at, at + window))


def _runs(k, pos, ref_k, ref_pos) -> np.ndarray:
    """Factors: maximal runs of seeds (in order) that continue in the reference."""
    if not len(k):
        return np.zeros((0, len(FACTOR)), np.int64)
    pos, ref_pos = pos.astype(np.int64), ref_pos.astype(np.int64)
    goes_on = ((k[1:] == k[:-1]) & (pos[1:] == pos[:-1] + 1) & (ref_k[1:] == ref_k[:-1]) & (ref_pos[1:] == ref_pos[:-1] + 1))
    start = np.flatnonzero(np.concatenate([[True], ~goes_on]))
    return np.stack([k[start], pos[start], np.diff(np.append(start, len(k))), ref_k[start], ref_pos[start]], 1)


def _first_places(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For entries in document order: the first entry of each one's key."""
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    new = np.ones(len(key), bool)
    new[1:] = sorted_key[1:] != sorted_key[:-1]
    first = np.empty(len(key), np.int64)
    first[order] = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
    return first, first == np.arange(len(key))


_INDEX = "block int, seed binary, k binary, pos binary, factors binary"
_INDEX_TYPES = (pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary())


def _index_entries(docs: DataFrame, blocks: int, window: int) -> DataFrame:
    """First places of the seeds of each task's runs of documents, by block,
    and the factors found inside a run (they pass through a block unchanged)."""

    def scan(batches):
        for k, column in in_order(batches):
            for keys, some in gathered(k, column):
                base, parts = 0, []
                for texts in some:
                    doc, pos, seed, other = _seeds(texts, window)
                    parts.append((keys[base:base + len(texts)][doc], pos, seed, other))
                    base += len(texts)
                key, pos, seed, other = (np.concatenate(c) for c in zip(*parts))
                if not len(seed):
                    continue
                first, is_first = _first_places(seed)
                later = np.flatnonzero(~is_first & (key[first] != key) | ~is_first & (pos[first] != pos))
                factors = _runs(key[later], pos[later], key[first[later]], pos[first[later]])
                keep = np.flatnonzero(is_first)
                target = (other[keep] % np.uint64(blocks)).astype(np.int64)
                order, begin = by_target(target, blocks)
                keep = keep[order]
                out = []
                for b in np.flatnonzero(np.diff(begin)):
                    own = keep[begin[b]:begin[b + 1]]
                    out.append((int(b), seed[own].tobytes(), pack(key[own]), pack(pos[own]), None))
                if len(factors):
                    out.append((int(key[0] % blocks), b"", pack(key[:0]), pack(pos[:0]), pack(factors.ravel())))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _INDEX_TYPES)],
                                                 names=["block", "seed", "k", "pos", "factors"])

    return docs.select("k", "text").mapInArrow(scan, _INDEX)


def _send_home(out: list, groups: int, k, columns: list[np.ndarray]) -> None:
    order, begin = by_target(home(k, groups), groups)
    for g in np.flatnonzero(np.diff(begin)):
        own = order[begin[g]:begin[g + 1]]
        out.append((int(g), *(pack(c[own]) for c in columns)))


_MATCH = "home int, k binary, start binary, seeds binary, ref_k binary, ref_start binary"


def _matches(entries: DataFrame, groups: int) -> DataFrame:
    """Runs of matched seeds of each block, by the documents' groups."""

    def look_up(key: tuple, table: pa.Table) -> pa.Table:
        seed, k, pos, found = [], [], [], []
        for row in table.to_pylist():
            if row["factors"] is not None:
                found.append(unpack(row["factors"], np.int64).reshape(-1, len(FACTOR)))
            else:
                seed.append(np.frombuffer(row["seed"], np.uint64))
                k.append(unpack(row["k"], np.int64))
                pos.append(unpack(row["pos"], np.uint32))
        if seed:
            seed, k, pos = np.concatenate(seed), np.concatenate(k), np.concatenate(pos)
            # Only seeds that occur again are put in document order.
            order = np.argsort(seed)
            same = seed[order[1:]] == seed[order[:-1]]
            again = np.zeros(len(seed), bool)
            again[order[1:]] |= same
            again[order[:-1]] |= same
            some = np.flatnonzero(again)
            some = some[np.lexsort((pos[some], k[some]))]
            first, is_first = _first_places(seed[some])
            first = some[first]
            later = ~is_first & ((k[first] != k[some]) | (pos[first] != pos[some]))
            some, first = some[later], first[later]
            found.append(np.stack([k[some], pos[some], np.ones(len(some)), k[first], pos[first]], 1).astype(np.int64)
                         if len(some) else np.zeros((0, len(FACTOR)), np.int64))
        rows: list = []
        if found:
            all_found = np.concatenate(found)
            _send_home(rows, groups, all_found[:, 0], list(all_found.T))
        types = (pa.int32(), *[pa.binary()] * len(FACTOR))
        return pa.Table.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=["home", *FACTOR])

    return entries.groupBy("block").applyInArrow(look_up, _MATCH)


_PARSED = ("k long, n_words long, n_removed long, kept string, "
           "factors array<struct<start:long,words:long,ref_k:long,ref_start:long>>")
_FACTOR_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("words", pa.int64()), ("ref_k", pa.int64()), ("ref_start", pa.int64())]))


def _parse(k: np.ndarray, texts: tx.Texts, matches: np.ndarray, window: int):
    """Factors and kept words of a run of documents (keys ascending)."""
    words = texts.words(texts.data, tx.SPACE)
    doc = np.searchsorted(k, matches[:, 0])
    order = np.lexsort((matches[:, 1], doc))
    m, doc = matches[order], doc[order]
    # Single seeds from the index become longer factors where they go on.
    n = np.repeat(np.arange(len(m)), m[:, 2])
    step = np.arange(len(n)) - np.repeat(np.cumsum(m[:, 2]) - m[:, 2], m[:, 2])
    factors = _runs(m[n, 0], m[n, 1] + step, m[n, 3], m[n, 4] + step)
    start = words.first[np.searchsorted(k, factors[:, 0])] + factors[:, 1]
    gone = tx.covered(len(words), start, factors[:, 2] + window - 1)
    kept = np.flatnonzero(~gone)
    remaining = tx.Words(words.data, words.starts[kept], words.ends[kept], np.searchsorted(kept, words.first))
    joined, at, end = remaining.joined()
    whole = joined.tobytes()
    lo, hi = remaining.first[:-1], remaining.first[1:]
    text = [whole[at[a]:end[b - 1]].decode() if b > a else "" for a, b in zip(lo.tolist(), hi.tolist())]
    split = np.searchsorted(factors[:, 0], k), np.searchsorted(factors[:, 0], k, "right")
    rows = [[{"start": int(f[1]), "words": int(f[2]) + window - 1, "ref_k": int(f[3]), "ref_start": int(f[4])}
             for f in factors[a:b]] for a, b in zip(*split)]
    return words.counts, tx.per_text(gone, words.first), text, rows


def parse(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``id_col, n_words, n_removed, kept, factors`` per row: the words that no
    factor covers, joined by one space, and the factors (first word, words, key
    and first word of the reference)."""
    own = keyed(docs, id_col, text_col)
    groups = own.groups
    matches = _matches(_index_entries(own.docs, groups, window), groups)

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        m = [np.stack([unpack(r[c], np.int64) for c in FACTOR], 1) for r in right.to_pylist()]
        m = np.concatenate(m) if m else np.zeros((0, len(FACTOR)), np.int64)
        m = m[np.argsort(m[:, 0], kind="stable")]
        keys, columns = [], []
        for k, texts in dealt_texts(left):
            mine = m[np.searchsorted(m[:, 0], k[0]):np.searchsorted(m[:, 0], k[-1], "right")]
            mine = mine[np.isin(mine[:, 0], k)]
            keys.append(k)
            columns.append(_parse(k, texts, mine, window))
        n_words, n_removed, kept, factors = zip(*columns) if columns else ([], [], [], [])
        flat = lambda c: pa.array(np.concatenate(c).astype(np.int64) if len(c) else np.zeros(0, np.int64))
        return pa.Table.from_arrays(
            [flat(keys), flat(n_words), flat(n_removed), pa.array(sum(kept, []) if kept else [], pa.string()),
             pa.array(sum(factors, []) if factors else [], _FACTOR_TYPE)],
            names=["k", "n_words", "n_removed", "kept", "factors"])

    parsed = (deal_texts(own.docs, groups).groupBy("home").cogroup(matches.groupBy("home"))
              .applyInArrow(finish, _PARSED))
    return with_ids(parsed, own, id_col)
