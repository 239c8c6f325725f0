"""Repeated byte strings by ordering anchored strings column by column.

A byte is removed if a string of ``window`` bytes that covers it also starts
in an earlier document.  Every window has an anchor, its least gram hash
(leftmost of equal ones), and belongs to one cell: the run of windows with the
same anchor place.  Equal windows have equal anchors at equal distances, so

1. anchors that only one document holds are sorted out first (a shuffle of six
   bytes and a place per cell);
2. the cells that are left become short strings, each with the earliest
   document that holds it; strings of one anchor meet in one group;
3. each group is a collection whose suffixes are ordered column by column, as
   in a multi-document Burrows-Wheeler construction but with columns counted
   from the anchor and no transform kept: every round inserts one symbol
   of every string, from the last column to the first; the order of the
   suffixes that start in this column and their common-prefix lengths are
   rewritten front to back from those of the round before.  Only windows of one
   column can be equal, so no other order is needed and a round costs one step
   per string.  Neighbours with a common prefix of at least ``window`` bytes are
   equal windows; one whose class an earlier document holds is removed.

The strings travel through shuffle files; a group's state is one symbol and one
prefix length per string, so it needs no files of its own.  Equal strings are
collapsed before each shuffle: the earliest document stands for them, the
others lose the whole string.  Anchors that very many distinct strings share
(over ``HOT_STRINGS`` by the sum over all tasks) are split: their windows go one
by one to the group of their own hash, so that no anchor gathers in one task.
They are chosen once for the whole collection, and every task splits the same
ones, so equal windows meet wherever they come from.

Defined cases: null and empty texts have no bytes; documents are ordered by id
(null last); rows of equal id and text are one document and share its result;
rows of equal id and different text are documents of their own, in the order
of their texts' 64-bit hashes; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from ..session import materialize
from . import text as tx
from .blocks import by_target, deal_texts, dealt_texts, gathered, home, in_order, keyed, pack, unpack, with_ids

WINDOW = 50
GRAM = 20
HOT_STRINGS = 2000
#: Anchors that are split at most (the largest; or one per part, if that is more): their list goes to every task.
MOST_HOT = 1 << 16
_PLACE = np.uint64((1 << 30) - 1)


def cells(texts: tx.Texts, window: int = WINDOW):
    """Of each cell: text, first byte (in the text), windows, place of the
    anchor after the first byte, anchor, hash of its bytes.  They depend on the
    text alone."""
    data, offsets = texts.data, texts.offsets
    none = np.zeros(0, np.int64)
    if len(data) < window:
        return none, none, none, none, np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    rolling = tx.Rolling(tx.BYTE_VALUE[data])
    gram = rolling.grams(GRAM)
    least = (gram & ~_PLACE) | np.arange(len(gram), dtype=np.uint64)  # ties: the leftmost
    width, have = window - GRAM + 1, 1
    while 2 * have <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if width > have:
        least = np.minimum(least[:-(width - have)], least[width - have:])
    size = np.diff(offsets)
    many = np.maximum(size - (window - 1), 0)
    doc = np.repeat(np.arange(len(size)), many)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many) + offsets[:-1][doc]
    place = (least[at] & _PLACE).astype(np.int64)
    new = np.ones(len(at), bool)
    new[1:] = (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])
    start = np.flatnonzero(new)
    count = np.diff(np.append(start, len(at)))
    doc, at, place = doc[start], at[start], place[start]
    return doc, at - offsets[doc], count, place - at, gram[place], rolling.spans(at, at + count + window - 1)


_ANCHORS = "part int, anchor binary, n binary, k binary, pos binary, known binary"
_ANCHOR_TYPES = (pa.int32(), *[pa.binary()] * 5)


def _batch(rows: list, types, names) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)


def _anchor_entries(docs: DataFrame, parts: int, window: int) -> DataFrame:
    """First place of each anchor in each task's run of documents, and how many
    distinct strings of the run have it (``n``); of those that several documents of the run hold, the first place in each document passes
    through as known."""

    def scan(batches):
        for k, column in in_order(batches):
            for keys, some in gathered(k, column):
                base, found = 0, []
                for texts in some:
                    doc, pos, _, _, anchor, own = cells(texts, window)
                    found.append((keys[base:base + len(texts)][doc], pos, anchor >> np.uint64(16), own))
                    base += len(texts)
                key, pos, anchor, string = (np.concatenate(c) for c in zip(*found))
                if not len(key):
                    continue
                order = np.argsort(anchor, kind="stable")
                sorted_anchor, sorted_key = anchor[order], key[order]
                new = np.ones(len(order), bool)
                new[1:] = sorted_anchor[1:] != sorted_anchor[:-1]
                begin = np.flatnonzero(new)
                size = np.diff(np.append(begin, len(order)))
                shared = sorted_key[begin] != sorted_key[begin + size - 1]
                strings = np.ones(len(begin), np.int64)
                again = order[np.repeat(size > 1, size)]
                if len(again):
                    one, _ = _distinct(string[again], anchor[again])
                    strings[size > 1] = np.unique(anchor[again[one]], return_counts=True)[1]
                of_document = new.copy()
                of_document[1:] |= sorted_key[1:] != sorted_key[:-1]
                known = np.sort(order[of_document & np.repeat(shared, size)])
                by_place = np.argsort(order[begin])
                first, strings = order[begin][by_place], strings[by_place]
                target = (tx.mix(anchor[first]) % np.uint64(parts)).astype(np.int64)
                dealt, edge = by_target(target, parts)
                out = []
                for p in np.flatnonzero(np.diff(edge)):
                    some = dealt[edge[p]:edge[p + 1]]
                    own = first[some]
                    six = anchor[own].view(np.uint8).reshape(-1, 8)[:, :6].tobytes()
                    out.append((int(p), six, pack(strings[some]), pack(key[own]), pack(pos[own]), None))
                if len(known):
                    out.append((int(key[0] % parts), b"", b"", b"", b"", pack(np.stack([key[known], pos[known]]).ravel())))
                yield _batch(out, _ANCHOR_TYPES, ["part", "anchor", "n", "k", "pos", "known"])

    return docs.select("k", "text").mapInArrow(scan, _ANCHORS)


def _shared_cells(entries: DataFrame, groups: int, hot_strings: int) -> DataFrame:
    """``home, k, pos``: of each anchor that several documents hold, its first
    place in each of them (a document lies in one run, so no run adds to another's);
    and, as ``hot``, the anchors of over ``hot_strings`` strings in all runs."""
    most = max(1, MOST_HOT // groups)

    def match(key: tuple, table: pa.Table) -> pa.Table:
        anchor, n, k, pos, places, rows = [], [], [], [], [], []
        for row in table.to_pylist():
            if row["known"] is not None:
                places.append(unpack(row["known"], np.int64).reshape(2, -1))
                continue
            six = np.frombuffer(row["anchor"], np.uint8).reshape(-1, 6)
            wide = np.zeros((len(six), 8), np.uint8)
            wide[:, :6] = six
            anchor.append(wide.view(np.uint64).ravel())
            n.append(unpack(row["n"], np.int64))
            k.append(unpack(row["k"], np.int64))
            pos.append(unpack(row["pos"], np.int64))
        if anchor:
            anchor, n, k, pos = (np.concatenate(c) for c in (anchor, n, k, pos))
            order = np.argsort(anchor)
            same = anchor[order[1:]] == anchor[order[:-1]]
            again = np.zeros(len(order), bool)
            again[order[1:]] |= same
            again[order[:-1]] |= same
            places.append(np.stack([k[again], pos[again]]))
            begin = np.flatnonzero(np.concatenate([[True], ~same]))
            strings = np.add.reduceat(n[order], begin)
            hot = np.flatnonzero(strings > hot_strings)
            if len(hot):
                hot = hot[np.argsort(-strings[hot], kind="stable")[:most]]
                rows.append((-1, b"", b"", anchor[order[begin[hot]]].tobytes()))
        k, pos = np.concatenate(places, axis=1)
        order, begin = by_target(home(k, groups), groups)
        rows += [(int(g), pack(k[order[begin[g]:begin[g + 1]]]), pack(pos[order[begin[g]:begin[g + 1]]]), None)
                 for g in np.flatnonzero(np.diff(begin))]
        types = (pa.int32(), *[pa.binary()] * 3)
        return pa.Table.from_batches([_batch(rows, types, ["home", "k", "pos", "hot"])])

    return entries.groupBy("part").applyInArrow(match, "home int, k binary, pos binary, hot binary")


_STRINGS = "part int, size binary, offset binary, data binary, entry binary, k binary, pos binary, known binary"
_STRING_TYPES = (pa.int32(), *[pa.binary()] * 7)


def _strings(dealt: DataFrame, shared: DataFrame, parts: int, window: int, hot: np.ndarray) -> DataFrame:
    """The cells of shared anchors in each group of documents as strings: distinct
    ones with the places in their earliest document, and, as known spans, the
    places in later documents of the group.  A shared anchor comes with its first
    place in the document; all cells of the document that have it are taken."""

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        wanted = [np.stack([unpack(r["k"], np.int64), unpack(r["pos"], np.int64)]) for r in right.to_pylist()]
        rows: list = []
        if wanted:
            wanted = np.concatenate(wanted, axis=1)
            wanted = wanted[:, np.lexsort((wanted[1], wanted[0]))]
            data, found, base = [], [], 0
            for k, texts in dealt_texts(left):
                mine = wanted[:, np.searchsorted(wanted[0], k[0]):np.searchsorted(wanted[0], k[-1], "right")]
                mine = mine[:, np.isin(mine[0], k)]
                if not mine.shape[1]:
                    continue
                doc, pos, count, offset, anchor, own = cells(texts, window)
                begin = texts.offsets[doc] + pos
                some = np.isin(begin, texts.offsets[np.searchsorted(k, mine[0])] + mine[1])
                # Other places of these anchors; a chance hit only adds a cell to compare.
                pair = (anchor >> np.uint64(16)) ^ tx.mix(doc.view(np.uint64))
                some = np.isin(pair, pair[some])
                found.append((begin[some] + base, count[some] + window - 1, offset[some], anchor[some], own[some],
                              k[doc[some]], pos[some]))
                data.append(texts.data)
                base += len(texts.data)
            if found:
                rows = _deal_strings(np.concatenate(data), *(np.concatenate(c) for c in zip(*found)), parts, window, hot)
        return pa.Table.from_batches([_batch(rows, _STRING_TYPES, ["part", "size", "offset", "data", "entry", "k", "pos", "known"])])

    return dealt.groupBy("home").cogroup(shared.groupBy("home")).applyInArrow(cut, _STRINGS)


def _distinct(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One entry of each distinct combination, and the combination of each entry."""
    order = np.lexsort(keys)
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([k[order[1:]] != k[order[:-1]] for k in keys])
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    return order[new], which


def _earliest(which: np.ndarray, k: np.ndarray, n: int) -> np.ndarray:
    least = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(least, which, k)
    return least


def _deal_strings(data, begin, size, offset, anchor, own, k, pos, parts: int, window: int, hot: np.ndarray) -> list:
    """Strings of a group of documents, ``data[begin:begin + size]``, by target."""
    # Hot anchors: every window is a string of its own.
    hot = np.isin(anchor >> np.uint64(16), hot)
    if hot.any():
        many = size[hot] - (window - 1)
        step = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
        single = [np.repeat(c[hot], many) for c in (begin, offset, k, pos)]
        at = single[0] + step
        hashed = tx.Rolling(tx.BYTE_VALUE[data]).spans(at, at + window)
        cold = ~hot
        begin, size = np.append(begin[cold], at), np.append(size[cold], np.full(len(at), window))
        offset, anchor = np.append(offset[cold], single[1] - step), np.append(anchor[cold], hashed)
        own, k, pos = np.append(own[cold], hashed), np.append(k[cold], single[2]), np.append(pos[cold], single[3] + step)
    first, which = _distinct(own, anchor)
    earliest = k == _earliest(which, k, len(first))[which]
    target = (tx.mix(anchor[first] ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(parts)).astype(np.int64)
    order, edge = by_target(target, parts)
    mine = np.flatnonzero(earliest)
    mine = mine[np.argsort(which[mine], kind="stable")]
    held = np.searchsorted(which[mine], np.arange(len(first) + 1))
    whole, out = data.tobytes(), []
    for p in np.flatnonzero(np.diff(edge)):
        some = order[edge[p]:edge[p + 1]]
        count = held[some + 1] - held[some]
        entry = np.repeat(np.arange(len(some)), count)
        rows = mine[np.repeat(held[some] - (np.cumsum(count) - count), count) + np.arange(len(entry))]
        strings = b"".join(whole[b:b + n] for b, n in zip(begin[first[some]].tolist(), size[first[some]].tolist()))
        out.append((int(p), pack(size[first[some]]), pack(offset[first[some]]), zstandard.compress(strings, 1), pack(entry),
                    pack(k[rows]), pack(pos[rows]), None))
    late = np.flatnonzero(~earliest)
    if len(late):
        out.append((int(k[0] % parts), *[b""] * 6, pack(np.stack([k[late], pos[late], size[late]]).ravel())))
    return out


def columns(data: np.ndarray, begin: np.ndarray, size: np.ndarray, offset: np.ndarray):
    """Column-wise construction over the strings ``data[begin:begin + size]``
    whose symbol number ``offset`` stands in column 0.

    Yields, from the last column to the first, ``(column, order, prefix)``: the
    strings that have a symbol in the column, in the order of their suffixes
    from there on (an end comes before any symbol; equal suffixes stay in the
    order they have), and the common prefix of each with the one before.
    A round takes the order of the suffixes one column further, with the
    strings that end there in front, and sorts it stably by the symbol in this
    column; the common prefix of neighbours with equal symbols is one more than
    the least one between them before."""
    last, first = size - offset - 1, -offset
    if not len(size):
        return
    length = np.uint8 if int(size.max()) < 256 else np.int64  # of common prefixes
    order, prefix = np.zeros(0, np.int64), np.zeros(0, length)
    enters = np.argsort(-last, kind="stable")
    edge = np.searchsorted(-last[enters], np.arange(-int(last.max()), -int(first.min()) + 2))
    for i, column in enumerate(range(int(last.max()), int(first.min()) - 1, -1)):
        stays = first[order] <= column
        if not stays.all():
            at = np.flatnonzero(stays)
            if len(at):
                prefix = np.minimum.reduceat(prefix[:at[-1] + 1], np.concatenate([[0], at[:-1] + 1]))
            order, prefix = order[at], prefix[:len(at)]
        fresh = np.sort(enters[edge[i]:edge[i + 1]])
        if len(fresh):
            prefix = np.concatenate([np.zeros(len(fresh) + (len(order) > 0), length), prefix[1:]])
            order = np.concatenate([fresh, order])
        if not len(order):
            continue
        symbol = data[begin[order] + offset[order] + column]
        by = np.argsort(symbol, kind="stable")
        ordered = symbol[by]
        between = np.minimum.reduceat(np.append(prefix, length(0)), by + 1)
        new = np.zeros(len(by), length)
        new[1:] = np.where(ordered[1:] == ordered[:-1], between[:-1] + length(1), 0)
        order, prefix = order[by], new
        yield column, order, prefix


def _equal_windows(data, begin, size, offset, owner, window: int):
    """``string, first byte`` of every window that a string of an earlier owner holds too."""
    string, start = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for column, order, prefix in columns(data, begin, size, offset):
        some = np.flatnonzero(prefix >= window)
        if not len(some):
            continue
        new = np.ones(len(order), bool)
        new[some] = False
        head = np.flatnonzero(new)
        least = np.minimum.reduceat(owner[order], head)[np.cumsum(new) - 1]
        late = order[least < owner[order]]
        string.append(late)
        start.append(offset[late] + column)
    return np.concatenate(string), np.concatenate(start)


def _merge(k: np.ndarray, start: np.ndarray, window: int) -> np.ndarray:
    """Windows as spans: runs of consecutive first bytes of one document."""
    if not len(k):
        return np.zeros((3, 0), np.int64)
    order = np.lexsort((start, k))
    k, start = k[order], start[order]
    new = np.concatenate([[True], (k[1:] != k[:-1]) | (start[1:] > start[:-1] + 1)])
    begin = np.flatnonzero(new)
    last = start[np.append(begin[1:], len(k)) - 1]
    return np.stack([k[begin], start[begin], last - start[begin] + window])


def _spans(strings: DataFrame, groups: int, window: int) -> DataFrame:
    """``home, k, start, size``: removed spans found in each collection."""

    def sort(key: tuple, table: pa.Table) -> pa.Table:
        spans, data, sizes, offsets, k, pos, entry, n = [], [], [], [], [], [], [], 0
        for row in table.to_pylist():
            if row["known"] is not None:
                spans.append(unpack(row["known"], np.int64).reshape(3, -1))
                continue
            data.append(zstandard.decompress(row["data"]))
            for column, name in ((sizes, "size"), (offsets, "offset"), (entry, "entry"), (k, "k"), (pos, "pos")):
                column.append(unpack(row[name], np.int64))
            entry[-1] += n
            n += len(sizes[-1])
        if n:
            whole = b"".join(data)
            size, offset, entry, k, pos = (np.concatenate(c) for c in (sizes, offsets, entry, k, pos))
            begin = np.cumsum(size) - size
            seen: dict[bytes, int] = {}
            which = np.fromiter((seen.setdefault(whole[b:b + s], len(seen)) for b, s in zip(begin.tolist(), size.tolist())), np.int64, n)
            first = np.empty(len(seen), np.int64)
            first[which[::-1]] = np.arange(n)[::-1]
            own = which[entry]
            owner = _earliest(own, k, len(first))
            late = k != owner[own]
            spans.append(np.stack([k[late], pos[late], size[first[own[late]]]]))
            k, pos, own = k[~late], pos[~late], own[~late]
            string, start = _equal_windows(np.frombuffer(whole, np.uint8), begin[first], size[first], offset[first], owner, window)
            order = np.argsort(own, kind="stable")
            edge = np.searchsorted(own[order], np.arange(len(first) + 1))
            count = edge[string + 1] - edge[string]
            at = order[np.repeat(edge[string] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))]
            spans.append(_merge(k[at], pos[at] + np.repeat(start, count), window))
        all_spans = np.concatenate(spans, axis=1)
        order, begin = by_target(home(all_spans[0], groups), groups)
        rows = [(int(g), *(pack(c[order[begin[g]:begin[g + 1]]]) for c in all_spans)) for g in np.flatnonzero(np.diff(begin))]
        return pa.Table.from_batches([_batch(rows, (pa.int32(), *[pa.binary()] * 3), ["home", "k", "start", "size"])])

    return strings.groupBy("part").applyInArrow(sort, "home int, k binary, start binary, size binary")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   hot_strings: int = HOT_STRINGS) -> DataFrame:
    """``id_col, n_bytes, n_removed, n_spans, kept, spans`` per row: the bytes
    that are left, concatenated, and the maximal removed runs (start, size)."""
    own = keyed(docs, id_col, text_col)
    groups = own.groups
    dealt = deal_texts(own.docs, groups)
    shared = materialize(_shared_cells(_anchor_entries(own.docs, groups, window), groups, hot_strings), "suffix-shared")
    lists = [np.frombuffer(r["hot"], np.uint64) for r in shared.where("home < 0").select("hot").collect()]
    hot = np.sort(np.concatenate([np.zeros(0, np.uint64), *lists]))
    found = _spans(_strings(dealt, shared.where("home >= 0"), groups, window, hot), groups, window)

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        spans = [np.stack([unpack(r[c], np.int64) for c in ("k", "start", "size")]) for r in right.to_pylist()]
        spans = np.concatenate(spans, axis=1) if spans else np.zeros((3, 0), np.int64)
        spans = spans[:, np.argsort(spans[0], kind="stable")]
        keys, n_bytes, n_removed, n_spans, kept, runs = [], [], [], [], [], []
        for k, texts in dealt_texts(left):
            mine = spans[:, np.searchsorted(spans[0], k[0]):np.searchsorted(spans[0], k[-1], "right")]
            mine = mine[:, np.isin(mine[0], k)]
            gone = tx.covered(len(texts.data), texts.offsets[np.searchsorted(k, mine[0])] + mine[1], mine[2])
            start, end = texts.runs(gone)
            doc = np.searchsorted(texts.offsets, start, "right") - 1
            left_over = texts.data[~gone].tobytes()
            edge = np.concatenate([[0], np.cumsum(tx.per_text(~gone, texts.offsets))]).tolist()
            keys.append(k)
            n_bytes.append(np.diff(texts.offsets))
            n_removed.append(tx.per_text(gone, texts.offsets))
            n_spans.append(np.bincount(doc, minlength=len(texts)))
            kept += [left_over[a:b] for a, b in zip(edge[:-1], edge[1:])]
            begin = np.searchsorted(doc, np.arange(len(texts) + 1))
            runs += [[{"start": int(s - texts.offsets[d]), "size": int(e - s)} for s, e in zip(start[a:b], end[a:b])]
                     for d, (a, b) in enumerate(zip(begin[:-1], begin[1:]))]
        flat = lambda c: pa.array(np.concatenate(c).astype(np.int64) if c else np.zeros(0, np.int64))
        span = pa.list_(pa.struct([("start", pa.int64()), ("size", pa.int64())]))
        return pa.Table.from_arrays([flat(keys), flat(n_bytes), flat(n_removed), flat(n_spans), pa.array(kept, pa.binary()),
                                     pa.array(runs, span)], names=["k", "n_bytes", "n_removed", "n_spans", "kept", "spans"])

    cut = dealt.groupBy("home").cogroup(found.groupBy("home")).applyInArrow(
        finish, "k long, n_bytes long, n_removed long, n_spans long, kept binary, spans array<struct<start:long,size:long>>")
    return with_ids(cut, own, id_col)
