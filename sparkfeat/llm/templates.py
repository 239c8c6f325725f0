"""Line dedup with a log-template tree.

A line is its tokens; a token with a digit or an ``@`` is a variable field and
reads as a wildcard.  The tree has fixed depth: token count, then the leading
tokens.  Within a leaf the other places are generalised: a token stays where at
least ``min_docs`` documents, and at least the share ``min_share`` of the leaf's
documents, have it in that place; any other token becomes a wildcard.  So a
place has at most ``1 / min_share`` constant values per line of a document,
however large the corpus is.  Lines of equal leaf and equal generalised tokens are one template.
A template that at least ``min_docs`` documents hold, and of whose tokens at
least ``min_fixed`` are constant, recurs: its lines are dropped from every
document but the first that has it.

Leaves never gather: a document's equal lines are collapsed in its task, equal
lines are counted by partial aggregation, tokens are counted per (leaf, place,
token), less the repeats within one document, which its task knows, and the joins that carry results back keep hot keys where they are.
Only leaves with several distinct lines need token counts.

Defined cases: lines of fewer than ``min_tokens`` tokens are kept; null and
empty texts have no tokens and stay empty; documents are ordered by id (null
last); rows of equal id and text are one document and share its result; rows of
equal id and different text are documents of their own, in the order of their
texts' 64-bit hashes; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import text as tx
from .blocks import deal_texts, dealt_texts, gathered, home, in_order, keyed, with_ids
from .common import join_hot

DEPTH = 3
MIN_TOKENS = 3
MIN_DOCS = 3
MIN_FIXED = 0.5
MIN_SHARE = 0.1
_VARIABLE = np.zeros(256, bool)
_VARIABLE[[*range(0x30, 0x3A), 0x40]] = True
_WILDCARD = np.uint64(0x7F4A7C159E3779B9)


class Lines:
    """Parsed lines of a run of texts: ``doc``, ``leaf``, ``line`` (hash of the
    masked tokens), first and last token, and the masked token hashes."""

    def __init__(self, texts: tx.Texts, depth: int, min_tokens: int):
        words = texts.words(texts.data, tx.SPACE)
        start, end = texts.runs(texts.data != 10)
        self.first = np.searchsorted(words.starts, start)
        self.last = np.searchsorted(words.starts, end)
        self.n_all = np.bincount(np.searchsorted(texts.offsets, start, "right") - 1, minlength=len(texts))
        some = self.last - self.first >= min_tokens
        self.first, self.last, start = self.first[some], self.last[some], start[some]
        self.start = start
        self.doc = np.searchsorted(texts.offsets, start, "right") - 1
        marks = np.concatenate([[0], np.cumsum(_VARIABLE[texts.data])])
        self.masked = marks[words.ends] > marks[words.starts]
        self.tokens = np.where(self.masked, _WILDCARD, words.hashes())
        count = (self.last - self.first).astype(np.uint64)
        rolling = tx.Rolling(self.tokens)
        lead = np.minimum(self.first + depth, self.last)
        self.leaf = tx.mix(rolling.spans(self.first, lead) + count * np.uint64(0x9E3779B97F4A7C15))
        self.line = tx.mix(rolling.spans(self.first, self.last) ^ self.leaf)
        below = np.concatenate([[0], np.cumsum(self.masked)])
        self.n_masked = below[self.last] - below[self.first]


_ROWS = "home int, k long, leaf long, line long, n_tokens long, n_masked long, leads long, place long, token long, again long"


def _repeats(x: Lines, own: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, ...]:
    """``leaf, place, token, again``: how often constant tokens stand in the same
    place of several lines (``own``) of one document and leaf, less one each."""
    n = x.last[own] - x.first[own]
    row = np.repeat(own, n)
    place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    token = x.first[row] + place
    fixed = ~x.masked[token]
    columns = x.leaf[row][fixed].view(np.int64), place[fixed], x.tokens[token][fixed].view(np.int64)
    at = key[row][fixed]
    order = np.lexsort((at, *columns[::-1]))
    leaf, place, token = (c[order] for c in columns)
    same = (leaf[1:] == leaf[:-1]) & (place[1:] == place[:-1]) & (token[1:] == token[:-1])
    extra = np.concatenate([[0], same & (at[order][1:] == at[order][:-1])])[:len(order)].astype(np.int64)
    begin = np.flatnonzero(np.concatenate([[True], ~same])[:len(order)])
    again = np.add.reduceat(extra, begin) if len(begin) else extra
    some = again > 0
    return leaf[begin][some], place[begin][some], token[begin][some], again[some]


def _document_lines(docs: DataFrame, groups: int, depth: int, min_tokens: int) -> DataFrame:
    """One row per document and distinct masked line (``leads`` is 1 for one line
    of each document and leaf); and rows of ``_repeats``, with a ``place``."""

    def scan(batches):
        for k, column in in_order(batches):
            for keys, some in gathered(k, column):
                base = 0
                for texts in some:
                    x = Lines(texts, depth, min_tokens)
                    key = keys[base:base + len(texts)][x.doc]
                    base += len(texts)
                    order = np.lexsort((x.line, x.leaf, key))
                    new, leads = np.ones(len(order), bool), np.ones(len(order), bool)
                    leads[1:] = (key[order[1:]] != key[order[:-1]]) | (x.leaf[order[1:]] != x.leaf[order[:-1]])
                    new[1:] = leads[1:] | (x.line[order[1:]] != x.line[order[:-1]])
                    own, leads = order[new], leads[new]
                    many = np.diff(np.append(np.flatnonzero(leads), len(own)))
                    leaf, place, token, again = _repeats(x, own[np.repeat(many > 1, many)], key)
                    lines = [home(key[own], groups), key[own], x.leaf[own].view(np.int64), x.line[own].view(np.int64),
                             x.last[own] - x.first[own], x.n_masked[own], leads.astype(np.int64), None, None, None]
                    repeats = [None, None, leaf, None, None, None, None, place, token, again]
                    for columns, n in ((lines, len(own)), (repeats, len(leaf))):
                        types = [pa.int32(), *[pa.int64()] * 9]
                        yield pa.RecordBatch.from_arrays([
                            pa.nulls(n, t) if c is None else pa.array(c.astype(t.to_pandas_dtype())) for c, t in zip(columns, types)],
                            names=["home", "k", "leaf", "line", "n_tokens", "n_masked", "leads", "place", "token", "again"])

    return docs.select("k", "text").mapInArrow(scan, _ROWS)


def _line_tokens(dealt: DataFrame, wanted: DataFrame, depth: int, min_tokens: int) -> DataFrame:
    """``leaf, line, place, token`` of the constant tokens of the wanted lines
    (``home, k, line``: one document for each distinct line)."""

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        k_wanted, line_wanted = right["k"].to_numpy(), right["line"].to_numpy()
        columns = []
        if len(k_wanted):
            pairs = set(zip(k_wanted.tolist(), line_wanted.tolist()))
            for k, texts in dealt_texts(left):
                if not np.isin(k, k_wanted).any():
                    continue
                x = Lines(texts, depth, min_tokens)
                key, line = k[x.doc], x.line.view(np.int64)
                maybe = np.flatnonzero(np.isin(line, line_wanted))
                taken, own = set(), []
                for i in maybe.tolist():
                    pair = (int(key[i]), int(line[i]))
                    if pair in pairs and pair not in taken:
                        taken.add(pair)
                        own.append(i)
                own = np.array(own, np.int64)
                n = x.last[own] - x.first[own]
                row = np.repeat(own, n)
                place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                token = x.first[row] + place
                fixed = ~x.masked[token]
                columns.append((x.leaf[row].view(np.int64)[fixed], line[row][fixed], place[fixed], x.tokens[token].view(np.int64)[fixed]))
        flat = [np.concatenate(c) for c in zip(*columns)] if columns else [np.zeros(0, np.int64)] * 4
        return pa.Table.from_arrays([pa.array(c.astype(np.int64)) for c in flat], names=["leaf", "line", "place", "token"])

    return dealt.groupBy("home").cogroup(wanted.groupBy("home")).applyInArrow(cut, "leaf long, line long, place long, token long")


def drop_recurring(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH,
                   min_tokens: int = MIN_TOKENS, min_docs: int = MIN_DOCS, min_fixed: float = MIN_FIXED,
                   min_share: float = MIN_SHARE) -> DataFrame:
    """``id_col, n_lines, n_dropped, kept`` per row: non-empty lines, those
    dropped, and the text without them (other lines and their breaks unchanged)."""
    own = keyed(docs, id_col, text_col)
    groups = own.groups
    dealt = deal_texts(own.docs, groups)
    scanned = materialize(_document_lines(own.docs, groups, depth, min_tokens), "template-lines")
    lines, repeats = scanned.where("place is null"), scanned.where("place is not null")

    # Leaves that enough documents have; their distinct lines with the documents that have them.
    full = lines.groupBy("leaf").agg(F.sum("leads").alias("leaf_docs")).where(F.col("leaf_docs") >= min_docs)
    distinct = lines.groupBy("leaf", "line").agg(
        F.count(F.lit(1)).alias("n_docs"), F.min(F.struct("k", "home")).alias("at"), F.min("n_tokens").alias("n_tokens"),
        F.min("n_masked").alias("n_masked")).join(full, "leaf")
    distinct = materialize(distinct, "template-distinct")
    several = materialize(distinct.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("leaf"), "template-leaves")
    opened = distinct.join(several, "leaf", "left_semi")

    # Tokens that enough documents, and enough of the leaf's, have in the same place of a leaf.
    wanted = opened.select(F.col("at.home").alias("home"), F.col("at.k").alias("k"), "line")
    tokens = materialize(_line_tokens(dealt, wanted, depth, min_tokens), "template-tokens")
    counted = join_hot(tokens, distinct.select("leaf", "line", "n_docs", "leaf_docs"), ["leaf", "line"])
    less = repeats.select("leaf", "place", "token", (-F.col("again")).alias("n_docs"), F.lit(None).cast("long").alias("leaf_docs"))
    constant = (counted.drop("line").unionByName(less).groupBy("leaf", "place", "token")
                .agg(F.sum("n_docs").alias("n"), F.max("leaf_docs").alias("leaf_docs"))
                .where((F.col("n") >= min_docs) & (F.col("n") >= min_share * F.col("leaf_docs")))
                .select("leaf", "place", "token", F.lit(True).alias("stays")))
    general = (join_hot(tokens, materialize(constant, "template-constant"), ["leaf", "place", "token"]).where("stays")
               .groupBy("leaf", "line").agg(F.bit_xor(F.xxhash64("place", "token")).alias("pattern"), F.count(F.lit(1)).alias("n_fixed")))

    # Template of each distinct line; a line alone in its leaf is its own.
    alone = distinct.join(several, "leaf", "left_anti").select(
        "leaf", "line", F.xxhash64("leaf", "line").alias("template"), (F.col("n_tokens") - F.col("n_masked")).alias("n_fixed"), "n_tokens")
    mixed = opened.join(general, ["leaf", "line"], "left").select(
        "leaf", "line", F.xxhash64("leaf", F.coalesce("pattern", F.lit(0)), F.lit("general")).alias("template"),
        F.coalesce("n_fixed", F.lit(0)).alias("n_fixed"), "n_tokens")
    template = materialize(alone.unionByName(mixed).where(F.col("n_fixed") >= min_fixed * F.col("n_tokens"))
                           .select("leaf", "line", "template"), "template-of-line")

    with_template = materialize(join_hot(lines.select("home", "k", "leaf", "line"), template, ["leaf", "line"])
                                .where("template is not null").select("home", "k", "line", "template"), "template-of-document")
    recurring = (with_template.groupBy("template").agg(F.countDistinct("k").alias("n"), F.min("k").alias("first"))
                 .where(F.col("n") >= min_docs).select("template", "first"))
    dropped = join_hot(with_template, materialize(recurring, "template-recurring"), ["template"]).where("k <> first").select("home", "k", "line")

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        drops: dict[int, set] = {}
        for k, line in zip(right["k"].to_pylist(), right["line"].to_pylist()):
            drops.setdefault(k, set()).add(line)
        touched = np.array(sorted(drops), np.int64)
        keys, n_lines, n_dropped, kept = [], [], [], []
        for k, texts in dealt_texts(left):
            x = Lines(texts, depth, min_tokens)
            line = x.line.view(np.int64)
            gone: dict[int, set] = {}
            for i in np.flatnonzero(np.isin(k, touched)[x.doc]).tolist():
                if int(line[i]) in drops[int(k[x.doc[i]])]:
                    gone.setdefault(int(x.doc[i]), set()).add(int(x.start[i] - texts.offsets[x.doc[i]]))
            whole = texts.data.tobytes()
            for d, (a, b) in enumerate(zip(texts.offsets[:-1].tolist(), texts.offsets[1:].tolist())):
                body = whole[a:b]
                if d in gone:
                    at, left_over = 0, []
                    for piece in body.split(b"\n"):
                        if at not in gone[d]:
                            left_over.append(piece)
                        at += len(piece) + 1
                    body = b"\n".join(left_over)
                kept.append(body.decode())
            keys.append(k)
            n_lines.append(x.n_all)
            n_dropped.append(np.array([len(gone.get(d, ())) for d in range(len(texts))]))
        flat = lambda c: pa.array(np.concatenate(c).astype(np.int64) if c else np.zeros(0, np.int64))
        return pa.Table.from_arrays([flat(keys), flat(n_lines), flat(n_dropped), pa.array(kept, pa.string())],
                                    names=["k", "n_lines", "n_dropped", "kept"])

    found = dealt.groupBy("home").cogroup(dropped.groupBy("home")).applyInArrow(
        finish, "k long, n_lines long, n_dropped long, kept string")
    return with_ids(found, own, id_col)
