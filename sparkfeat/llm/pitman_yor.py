"""Language-model scoring with a hierarchical Pitman-Yor model.

Every context (the word before, or the text's begin) is a restaurant whose
customers are the words that follow it; all of them share one parent, the
restaurant of single words, whose customers are the tables of its children and
whose base is uniform over the training words and one unknown word.  Seatings
are sampled by Gibbs: a sweep draws, for every word of the parent and then for
every (context, word) pair, how many tables its customers sit at, given all
others.  Predictive probabilities are averaged over the sweeps after the
burn-in and score every text.

The conditional of a pair with ``c`` customers, ``T`` tables of other words in
its restaurant and parent probability ``p`` is, in closed form,
``S_d(c, t) p^t (s + d T)(s + d (T + 1)) ... (s + d (T + t - 1))`` with the
generalised Stirling numbers ``S_d``; it is drawn from, exactly up to ``EXACT``
customers.  Above that the Stirling numbers are read from the row of ``EXACT``
by their scaling law, ``S_d(c, t)`` being proportional in ``t`` to ``d^-t / (t - 1)!``
times a function of ``t / c^d``, so that a pair of any count costs the same.  A
single customer sits at a single
table, so only pairs seen twice or more carry state.  Discounts are
``n1 / (n1 + 2 n2)`` of the counts of each level; the strength is a parameter.

On Spark: texts are scanned in parts; a part sends its distinct (context, word)
pairs, with counts, to blocks dealt by a hash of the pair, so no context and no
word gathers in one task.  A word's numbers over all blocks meet at its home, which
has the word's seat in the restaurant of single words: blocks send the tables
that their pairs add to words and contexts, homes return each word's customers
and tables and each context's tables, as compressed arrays in one row per block
and home.  A second scan scores the
texts: blocks return partial sums for the documents of each part.  Nothing is
broadcast or collected but totals.  Words are told apart by 64-bit hashes; the
expected number of colliding pairs among 10 million words is below 0.00001.

Defined cases: a null text is empty and has the end token alone; a null id is
not held out; repeated rows are documents of their own; if nothing can be
learned every token is unknown; an empty table gives an empty result.
"""

from __future__ import annotations

import io
import math
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import discard, materialize, setting
from . import text as tx
from .common import union_all

BURN_IN = 2
SAMPLES = 2
STRENGTH = 1.0
EXACT = 1024
#: Points at which the law of a larger number of customers is evaluated.
GRID = 257
PART_BYTES = 12 << 20
#: Text that a block stands for; grows with the root of the corpus, so that parts x blocks stays in proportion to it.
BLOCK_BYTES = 28 << 20
#: Bytes of rows that Spark and Python hand each other at once: both keep buffers of that size, and of a
#: whole group's otherwise.  (One row may be larger.)
BATCH_BYTES = 2 << 20
#: Pairs of a block's parts that are gathered before they are summed.
FOLD = 1 << 20
SEED = 12

BEGIN, END = (tx.mix(np.array([x], np.uint64))[0] for x in (0xB0, 0xE0))


def held_out(id_col) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 7 == 2, F.lit(False))


# ---- Arrays that travel ---------------------------------------------------

def _pack(**arrays: np.ndarray) -> bytes:
    """Arrays as one compressed blob, the bytes of equal weight next to each other."""
    heads = [f"{name} {a.dtype.str} {len(a)} {a.nbytes}\n".encode() for name, a in arrays.items()]
    out = zstandard.ZstdCompressor(3).compressobj(size=sum(len(h) + a.nbytes for h, a in zip(heads, arrays.values())))
    blob = []
    for head, a in zip(heads, arrays.values()):
        blob.append(out.compress(head))
        if len(a):
            for plane in np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T:
                blob.append(out.compress(np.ascontiguousarray(plane)))
    return b"".join([*blob, out.flush()])


def _unpack(blob) -> dict[str, np.ndarray]:
    raw, at, out = zstandard.decompress(blob), 0, {}
    while at < len(raw):
        end = raw.index(b"\n", at) + 1
        name, kind, n, size = raw[at:end].decode().split()
        planes = np.frombuffer(raw, np.uint8, int(size), end).reshape(np.dtype(kind).itemsize, int(n))
        out[name] = np.ascontiguousarray(planes.T).view(kind).reshape(-1)
        at = end + int(size)
    return out


def _steps(a: np.ndarray) -> np.ndarray:
    return np.diff(a, prepend=a.dtype.type(0))


# ---- Scanning -------------------------------------------------------------

class _Tokens:
    """Tokens of a run of texts: word, word before, document."""

    def __init__(self, texts: tx.Texts):
        words = texts.words(tx.LOWER[texts.data], tx.SPACE)
        n = len(texts)
        self.counts = words.counts + 1
        self.word = np.full(len(words) + n, END, np.uint64)
        self.word[np.arange(len(words)) + words.doc()] = words.hashes()
        self.first = np.cumsum(self.counts) - self.counts


def _ranked(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values, ascending, and each element's place among them (32
    bits: a part has fewer tokens).  ``a`` is left sorted."""
    order = np.argsort(a, kind="stable" if a.dtype.itemsize < 8 else None)
    a[:] = a[order]
    new = np.empty(len(a), bool)
    new[:1] = True
    np.not_equal(a[1:], a[:-1], out=new[1:])
    place = np.cumsum(new, dtype=np.int32)
    place -= 1
    out = np.empty(len(order), np.int32)
    out[order] = place
    return a[new], out


def _named(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``_ranked``, by a hash table: only the distinct values, few among words, are sorted."""
    coded = pa.array(a).dictionary_encode()
    names = coded.dictionary.to_numpy()
    order = np.argsort(names)
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    return names[order], rank[coded.indices.to_numpy()]


class _Part:
    """Tokens of several runs, gathered until they are dealt to the blocks."""

    def __init__(self):
        self.words, self.counts, self.rows, self.size = [], [], [], 0

    def add(self, tokens: _Tokens, rows: pa.Table, size: int):
        self.words.append(tokens.word)
        self.counts.append(tokens.counts)
        self.rows.append(rows)
        self.size += size

    def pairs(self, blocks: int):
        """``(names, context, word, block, at)``: the distinct words' hashes
        (ascending), the distinct pairs in the order of their block, as indexes
        into ``names``, and of every token the place of its pair."""
        word = np.full(sum(map(len, self.words)) + 1, BEGIN, np.uint64)
        end = len(word) - 1
        while self.words:
            last = self.words.pop()
            word[end - len(last):end] = last
            end -= len(last)
        del last
        names, index = _named(word)
        del word
        begin, n = index[-1], len(index) - 1
        first = np.cumsum(np.concatenate(self.counts))
        key = np.empty(n, np.int64)
        key[1:] = index[:n - 1]
        key[np.concatenate([[0], first[:-1]])] = begin
        key *= len(names)
        key += index[:n]
        del index
        key, at = _ranked(key)
        context, own = (key // len(names)).astype(np.int32), (key % len(names)).astype(np.int32)
        del key
        block = (tx.mix(names[context] * np.uint64(0x9E3779B97F4A7C15) + names[own]) % np.uint64(blocks)).astype(np.int32)
        order = np.argsort(block, kind="stable")
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        return names, context[order], own[order], block[order], rank[at]

    def dealt(self, blocks: int):
        """``(block, names, context, word, slice)`` of the pairs of each block,
        indexes into the block's own ``names``; and the place of every token's pair."""
        names, context, own, block, at = self.pairs(blocks)
        edge = np.searchsorted(block, np.arange(blocks + 1))

        def each():
            for b in np.flatnonzero(np.diff(edge)).tolist():
                part = slice(edge[b], edge[b + 1])
                used = np.zeros(len(names), bool)
                used[context[part]] = True
                used[own[part]] = True
                local = np.cumsum(used) - 1
                yield b, names[used], local[context[part]], local[own[part]], part

        return each(), at


def _each_part(batches, part_bytes: int):
    """``_Part`` after ``_Part``; the text is the last column."""
    part = _Part()
    for batch in batches:
        for texts in tx.chunks(batch.column(batch.num_columns - 1)):
            rows = pa.Table.from_batches([batch.slice(texts.first, len(texts)).select(list(range(batch.num_columns - 1)))])
            part.add(_Tokens(texts), rows, len(texts.data))
            if part.size >= part_bytes:
                yield part
                part = _Part()
                tx.release()
    if part.rows:
        yield part


def _record(names, context, own, **more) -> bytes:
    return _pack(names=_steps(names), context=_steps(context.astype(np.int32)), word=own.astype(np.int32), **more)


def _read(blob) -> dict[str, np.ndarray]:
    out = _unpack(blob)
    out["names"] = np.cumsum(out["names"])
    out["context"] = np.cumsum(out["context"], dtype=np.int64)
    out["word"] = out["word"].astype(np.int64)
    return out


def _counted(docs: DataFrame, blocks: int, part_bytes: int) -> DataFrame:
    """Distinct pairs of each part with their training counts (0: only in held-out
    texts), to their blocks."""

    def scan(batches):
        for part in _each_part(batches, part_bytes):
            held = np.concatenate([r.column(0).to_numpy() for r in part.rows])
            each, at = part.dealt(blocks)
            n = np.bincount(at[np.repeat(~held, np.concatenate(part.counts))], minlength=int(at.max()) + 1).astype(np.int32)
            del at
            for b, names, context, own, piece in each:
                yield _batch([(b, 0, _PAIRS, _record(names, context, own, n=n[piece]))])

    return docs.select("held_out", "text").mapInArrow(scan, _SENT)


# ---- The model ------------------------------------------------------------

#: Rows that travel: to a block or a home (``to``), from the other, with arrays.
_SENT = "to int, origin int, kind int, data binary"
_COLUMNS = {"to": pa.int32(), "origin": pa.int32(), "kind": pa.int32(), "data": pa.binary()}
_PAIRS, _SEATS, _WORDS, _STATE, _ROOT, _REPLY, _TEXTS, _BITS = range(8)
_ROLES = ("d", "c")   # as a dish (the word itself), as a context


def _sums(index: np.ndarray, size: int, *values) -> list[np.ndarray]:
    return [np.bincount(index, weights=v, minlength=size).astype(np.int64) for v in values]


def _home(names: np.ndarray, homes: int) -> np.ndarray:
    """Home of each word: where its counts of all blocks meet."""
    return (tx.mix(names ^ np.uint64(0xA5A5A5A5A5A5A5A5)) % np.uint64(homes)).astype(np.int64)


def _batch(rows: list[tuple], columns: dict = _COLUMNS) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), columns.values())], names=list(columns))


def _batches(found, columns: dict = _COLUMNS):
    """Batches of about ``BATCH_BYTES`` of the tuples ``found``."""
    rows, size = [], 0
    for row in found:
        rows.append(row)
        size += sum(len(x) for x in row if isinstance(x, bytes))
        if size >= BATCH_BYTES:
            yield _batch(rows, columns)
            rows, size = [], 0
    if rows:
        yield _batch(rows, columns)


def _each_row(batches):
    """``(kind, origin, data)`` of every row; batch after batch, none is kept."""
    for batch in batches:
        for kind, origin, data in zip(batch.column("kind").to_pylist(), batch.column("origin").to_pylist(), batch.column("data")):
            yield kind, origin, data.as_buffer()


def _by_kind(rows) -> dict[int, list]:
    """``{kind: [(origin, arrays)]}``, in one order."""
    out: dict[int, list] = {}
    for kind, origin, data in sorted((kind, origin, data.to_pybytes()) for kind, origin, data in rows):
        out.setdefault(kind, []).append((origin, data))
    return out


def _grouped(frames: list[DataFrame], groups: int, function, name: str, schema: str = _SENT) -> DataFrame:
    """``function(to, rows)`` of every group's ``(kind, origin, data)``, in no order, written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches)
        yield from _batches(function(first.column("to")[0].as_py(), _each_row(chain([first], batches))))
        tx.release()

    dealt = union_all(frames).repartition(groups, "to")
    return materialize(dealt.groupBy("to").applyInArrow(run, schema), name)


def _of(sent: DataFrame, kind: int) -> DataFrame:
    return sent.where(F.col("kind") == kind)


def _to_homes(block: int, names: np.ndarray, homes: int, columns: dict[str, np.ndarray]):
    """A block's words and their numbers, one row for each home."""
    home = _home(names, homes)
    for h in np.unique(home).tolist():
        own = home == h
        yield h, block, _WORDS, _pack(names=_steps(names[own]), **{k: v[own].astype(np.int32) for k, v in columns.items()})


def _words(blob: bytes) -> dict[str, np.ndarray]:
    out = _unpack(blob)
    out["names"] = np.cumsum(out["names"])
    return out


def _folded(records: list[dict]) -> dict[str, np.ndarray]:
    """The pairs of ``records`` with their counts, as one record; the list is emptied."""
    names = np.unique(np.concatenate([r["names"] for r in records]))
    key, n = np.empty(sum(len(r["n"]) for r in records), np.int64), np.concatenate([r["n"] for r in records])
    end = len(key)
    while records:  # from the last on
        r = records.pop()
        at = np.searchsorted(names, r["names"])
        own = key[end - len(r["n"]):end]
        np.multiply(at[r["context"]], len(names), out=own)
        own += at[r["word"]]
        end -= len(own)
    del r, at, own
    order = np.argsort(key)
    key, n = key[order], n[order]
    del order
    begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    key, n = key[begin], np.add.reduceat(n, begin)
    return {"names": names, "context": (key // len(names)).astype(np.int32), "word": (key % len(names)).astype(np.int32), "n": n}


def _merged(counted: DataFrame, groups: int) -> DataFrame:
    """A block's pairs with their counts over all parts, those seen twice or
    more with one table each, and per home its words: training count, distinct
    pairs, and pairs seen once, as a word and as a context."""

    def merge(block: int, rows):
        sums, some, size = [], [], 0
        for _, _, x in rows:
            some.append(_read(x))
            size += len(some[-1]["n"])
            if size >= FOLD:
                sums.append(_folded(some))
                size = 0
        del x
        sums += some
        some.clear()
        names, context, word, n = _folded(sums).values()
        many = n >= 2
        used = np.zeros(len(names), bool)
        used[context[many]] = True
        used[word[many]] = True
        local = np.cumsum(used) - 1
        ones = np.ones(int(many.sum()), np.int32)
        yield block, block, _PAIRS, _record(names, context, word, n=n.astype(np.int32))
        # So many leading bits tell all names of the block apart.
        nearest = int((names[1:] ^ names[:-1]).min()) if len(names) > 1 else 1 << 63
        yield block, block, _BITS, _pack(total=np.array([65 - nearest.bit_length()], np.int64))
        yield block, block, _SEATS, _record(names[used], local[context[many]], local[word[many]], n=n[many].astype(np.int32), tables=ones, total=0 * ones)
        columns = {}
        del local, ones
        for role, index in zip(_ROLES, (word, context)):
            columns[role + "n"], columns[role + "types"], columns[role + "once"], columns[role + "twice"] = _sums(
                index, len(names), n, n > 0, n == 1, n == 2)
        yield from _to_homes(block, names, groups, columns)

    return _grouped([counted], groups, merge, "py-pairs")


def _gathered(sent: DataFrame, groups: int) -> DataFrame:
    """Per home its words with their counts over all blocks, and totals."""

    def gather(home: int, rows):
        rows = _by_kind(rows)
        records = [_words(x) for _, x in rows[_WORDS]]
        names = np.unique(np.concatenate([r["names"] for r in records]))
        sums = {k: np.zeros(len(names), np.int64) for k in records[0] if k != "names"}
        for r in records:
            at = np.searchsorted(names, r["names"])
            for k in sums:
                sums[k][at] += r[k]
        total = np.array([sums["dn"].sum(), (sums["dn"] > 0).sum(), sums["donce"].sum(), sums["dtwice"].sum(),
                          (sums["dtypes"] == 1).sum(), (sums["dtypes"] == 2).sum()], np.int64)
        yield home, home, _STATE, _pack(names=_steps(names), total=total, **{k: sums[k] for k in ("dn", "dtypes", "donce", "cn", "ctypes", "conce")})

    return _grouped([_of(sent, _WORDS)], groups, gather, "py-words")


def _totals(sent: DataFrame, kind: int, width: int, how=F.sum) -> np.ndarray:
    """Sums of the ``total`` arrays of a kind of rows (one row per home or block)."""

    def read(batches):
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array([_unpack(blob)["total"].tolist()], pa.list_(pa.int64()))], names=["total"])

    found = _of(sent, kind).select("data").mapInArrow(read, "total array<long>")
    row = found.agg(*[F.coalesce(how(F.col("total")[i]), F.lit(0)) for i in range(width)]).first()
    return np.array(row, np.int64)


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Log of the gamma function for ``x > 0``, by its asymptotic series."""
    shift = np.zeros_like(x)
    y = x.copy()
    for _ in range(8):
        small = y < 8
        shift[small] += np.log(y[small])
        y[small] += 1
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - shift


@lru_cache(4)
def stirling(d: float, most: int = EXACT) -> np.ndarray:
    """Logs of the generalised Stirling numbers ``S_d(c, t)`` for ``c, t <= most``."""
    out = np.full((most + 1, most + 2), -np.inf)
    out[1, 1] = 0.0
    for c in range(1, most):
        t = np.arange(1, c + 1)
        out[c + 1, 1:c + 1] = out[c, 1:c + 1] + np.log(c - t * d)
        out[c + 1, 1:c + 2] = np.logaddexp(out[c + 1, 1:c + 2], out[c, 0:c + 1])
    return out


def seat(rng, customers: np.ndarray, others, parent, d: float, strength: float, exact: int = EXACT) -> np.ndarray:
    """Tables drawn for each row: ``customers`` of one word, ``others`` tables of
    the other words in its restaurant, ``parent`` probability of the word."""
    n = len(customers)
    others, parent = (np.broadcast_to(np.asarray(x, float), n) for x in (others, parent))
    table = stirling(d, exact)
    out = np.ones(n, np.int64)
    u = rng.random(n)
    for c in np.unique(customers[(customers >= 2) & (customers <= exact)]).tolist():
        rows = np.flatnonzero(customers == c)
        t = np.arange(c)
        for own in np.array_split(rows, max(1, len(rows) * c >> 20)):
            log = np.cumsum(np.log(strength + d * (others[own][:, None] + t)), axis=1)
            log += (t + 1) * np.log(parent[own])[:, None] + table[c, 1:c + 1]
            share = np.cumsum(np.exp(log - log.max(axis=1, keepdims=True)), axis=1)
            out[own] = 1 + (share < (u[own] * share[:, -1])[:, None]).sum(axis=1)

    rows = np.flatnonzero(customers > exact)
    t0 = np.arange(1.0, exact + 1)
    law = table[exact, 1:exact + 1] + _log_gamma(t0) + t0 * math.log(d)
    for own in np.array_split(rows, max(1, len(rows) >> 12)):
        if not len(own):
            continue
        c, more, p = (x[own].astype(float)[:, None] for x in (customers, others, parent))
        scale = (exact / c) ** d

        def log_weight(t):
            s = t * scale
            found = np.interp(s, t0, law) + np.where(s < 1, (s - 1) * (law[1] - law[0]), 0.0)
            return _log_gamma(strength / d + more + t) - _log_gamma(t) + t * np.log(p) + found

        low, high = np.ones((len(own), 1)), np.floor(exact / scale)
        # Narrow the range to where the weight is, then draw from a grid of whole numbers (or of cells).
        for _ in range(6):
            grid = np.round(low + (high - low) * np.linspace(0, 1, GRID))
            log = log_weight(grid)
            live = log >= log.max(axis=1, keepdims=True) - 30
            first, last = live.argmax(axis=1), GRID - 1 - live[:, ::-1].argmax(axis=1)
            pick = lambda at: np.take_along_axis(grid, at[:, None], axis=1)  # noqa: E731, B023
            low, high = pick(np.maximum(first - 1, 0)), pick(np.minimum(last + 1, GRID - 1))
        grid = np.round(low + (high - low) * np.linspace(0, 1, GRID))
        width = np.diff(grid, axis=1, append=high + 1)        # 0 where a whole number comes twice
        log = np.where(width > 0, log_weight(grid) + np.log(np.maximum(width, 1)), -np.inf)
        share = np.cumsum(np.exp(log - log.max(axis=1, keepdims=True)), axis=1)
        at = (share < (u[own] * share[:, -1])[:, None]).sum(axis=1)[:, None]
        inside = np.floor(rng.random(len(own)) * np.take_along_axis(width, at, axis=1)[:, 0])
        out[own] = np.clip(np.take_along_axis(grid, at, axis=1)[:, 0] + inside, 1, customers[own])
    return out


def discount(n1: float, n2: float) -> float:
    """``n1 / (n1 + 2 n2)``, kept inside (0, 1)."""
    return min(0.95, max(0.05, n1 / (n1 + 2 * n2))) if n1 else 0.5


def _generator(*key: int):
    return np.random.Generator(np.random.Philox(key=[SEED, int.from_bytes(b"".join(int(k).to_bytes(4, "little") for k in key[:2]), "little")]))


def _root(state: DataFrame, sent: DataFrame | None, groups: int, sweep: int, d: float, strength: float, base: float, total: int) -> DataFrame:
    """The restaurant of single words: every word's customers (its tables in all
    contexts) and their sampled tables, and every context's tables; and the same
    numbers as replies to the blocks, in the order of the words each has sent."""

    def sample(home: int, rows):
        rows = _by_kind(rows)
        (_, blob), = rows[_STATE]
        w = _words(blob)
        customers, tables_in = w["donce"].copy(), w["conce"].copy()
        asked = []
        if _WORDS not in rows:  # the first sweep: one table for every pair
            customers, tables_in = w["dtypes"].copy(), w["ctypes"].copy()
        for origin, data in rows.get(_WORDS, []):
            r = _words(data)
            at = np.searchsorted(w["names"], r["names"])
            customers[at] += r["d"]
            tables_in[at] += r["c"]
            asked.append((origin, at))
        tables = np.minimum(customers, 1)
        many = customers >= 2
        tables[many] = seat(_generator(sweep, home), customers[many], max(0, total - 1), base, d, strength)
        yield home, home, _ROOT, _pack(customers=customers, tables=tables, seated=tables_in, total=np.array([customers.sum(), tables.sum()], np.int64))
        for origin, at in asked:
            yield origin, home, _REPLY, _pack(customers=customers[at], tables=tables[at], seated=tables_in[at])

    return _grouped([state, *([sent] if sent is not None else [])], groups, sample, "py-root")


def _placed(names: np.ndarray, groups: int, replies: list, columns: list[str]) -> dict[str, np.ndarray]:
    """Numbers that the homes returned, in the order of ``names``."""
    home = _home(names, groups)
    out = {c: np.zeros(len(names), np.int64) for c in columns}
    for origin, data in replies:
        r, own = _unpack(data), home == origin
        for c in columns:
            out[c][own] = r[c]
    return out


def _asked(seats: DataFrame, groups: int) -> DataFrame:
    """The words of every block's pairs in ``seats``, with the tables of these pairs."""

    def ask(batches):
        for batch in batches:
            for block, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield from _batches(_tables(block, _read(blob), groups))

    return _of(seats, _SEATS).select("to", "data").mapInArrow(ask, _SENT)


def _tables(block: int, s: dict, groups: int):
    d, = _sums(s["word"], len(s["names"]), s["tables"])
    c, = _sums(s["context"], len(s["names"]), s["tables"])
    return _to_homes(block, s["names"], groups, {"d": d, "c": c})


def _sweep(seats: DataFrame, replies: DataFrame, groups: int, sweep: int, add: bool, d: float, strength: float, parent) -> DataFrame:
    """New tables of every pair in ``seats``, given the parent's probabilities
    and the other tables of its restaurant."""

    def draw(block: int, rows):
        rows = _by_kind(rows)
        (_, blob), = rows[_SEATS]
        s = _read(blob)
        told = _placed(s["names"], groups, rows.get(_REPLY, []), ["customers", "tables", "seated"])
        p = parent(told["customers"], told["tables"])
        old = s["tables"].astype(np.int64)
        new = seat(_generator(sweep, block), s["n"], told["seated"][s["context"]] - old, p[s["word"]], d, strength)
        total = (s["total"] + old if add else s["total"]).astype(np.int32)
        yield block, block, _SEATS, _record(s["names"], s["context"], s["word"], n=s["n"], tables=new.astype(np.int32), total=total)

    return _grouped([_of(seats, _SEATS), replies], groups, draw, "py-seats")


class Model:
    """A fitted model.  ``pairs``: rows of the blocks (all pairs and counts) and
    their words per home; ``seats``: the pairs with state, tables summed over the
    samples; ``state``: counts of the words per home; ``roots``: per sample, the
    restaurant of single words; ``scalars``: its ``(customers, tables)``."""

    def __init__(self, **values):
        self.__dict__.update(values)

    def parent(self, sample: int):
        return _parent(*self.scalars[sample], self.d_root, self.strength, self.base)


def _parent(n: int, t: int, d: float, strength: float, base: float):
    """Function of a word's customers and tables in the restaurant of single words:
    its probability there."""
    return lambda customers, tables: (customers - d * tables + (strength + d * t) * base) / (strength + n)


def fit(docs: DataFrame, blocks: int, burn_in: int = BURN_IN, samples: int = SAMPLES, strength: float = STRENGTH,
        part_bytes: int = PART_BYTES) -> Model:
    """Sample the model from ``docs`` (``held_out``, ``text``)."""
    pairs = _merged(_counted(docs, blocks, part_bytes), blocks)
    state = _gathered(pairs, blocks)
    n, v, n1, n2, m1, m2 = _totals(state, _STATE, 6).tolist()
    bits = max(1, int(_totals(pairs, _BITS, 1, F.max)[0]))
    model = Model(pairs=pairs, state=state, bits=bits, blocks=blocks, n=n, v=v, strength=strength, base=1.0 / (v + 1), samples=samples,
                  d=discount(n1, n2), d_root=discount(m1, m2), roots=[], scalars=[])
    seats, tables = pairs, v
    for sweep in range(burn_in + samples):
        root = _root(state, _asked(seats, blocks), blocks, sweep, model.d_root, strength, model.base, tables)
        customers, tables = _totals(root, _ROOT, 2).tolist()
        if sweep >= burn_in:
            model.roots.append(_of(root, _ROOT))
            model.scalars.append((customers, tables))
        if sweep + 1 < burn_in + samples:
            parent = _parent(customers, tables, model.d_root, strength, model.base)
            before, seats = seats, _sweep(seats, _of(root, _REPLY), blocks, sweep, sweep >= burn_in, model.d, strength, parent)
            if before is not pairs:
                discard(before)
            if sweep < burn_in:
                discard(root)
    model.seats = seats
    return model


# ---- Scoring --------------------------------------------------------------

def _told(model: Model) -> DataFrame:
    """What every block must know of the words in its pairs: counts, and per
    sample the word's customers and tables and the context's tables."""
    samples = model.samples

    def tell(home: int, rows):
        rows = _by_kind(rows)
        (_, blob), = rows[_STATE]
        w = _words(blob)
        known = {"dn": w["dn"], "cn": w["cn"]}
        for s, (_, data) in enumerate(rows[_ROOT]):
            r = _unpack(data)
            known |= {f"{k}{s}": r[k] for k in ("customers", "tables", "seated")}
        for origin, data in rows[_WORDS]:
            at = np.searchsorted(w["names"], _words(data)["names"])
            yield origin, home, _REPLY, _pack(**{k: x[at].astype(np.int32) for k, x in known.items()})

    # The samples keep their order: it stands in ``origin``, which a root's row has no other use for.
    roots = [r.withColumn("origin", F.lit(s)) for s, r in enumerate(model.roots)]
    return _grouped([model.state, *roots, _of(model.pairs, _WORDS)], model.blocks, tell, "py-told")


def _occurrences(docs: DataFrame, blocks: int, part_bytes: int, bits: int) -> DataFrame:
    """Of each part and block the pairs with the documents they occur in;
    ``head`` (ids, numbers of tokens) once per part.  Words are named by their
    hashes' leading ``bits``: the model's block knows them all."""
    cut = np.uint64(64 - bits)

    def scan(batches):
        name = TaskContext.get().partitionId() << 32
        for part in _each_part(batches, part_bytes):
            counts = np.concatenate(part.counts)
            rows = pa.concat_tables(part.rows).append_column("n_tokens", pa.array(counts))
            out = io.BytesIO()
            with pa.ipc.new_stream(out, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                w.write_table(rows)
            yield _occurrence(int(tx.mix(np.array([name], np.uint64))[0] % np.uint64(blocks)), name, out.getvalue(), None)
            each, at = part.dealt(blocks)
            # (pair, document) ascending, with how often.
            key = at * np.int64(len(counts))
            key += np.repeat(np.arange(len(counts), dtype=np.int32), counts)
            key.sort()
            begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            times = np.diff(np.append(begin, len(key))).astype(np.int32)
            key = key[begin]
            del begin
            pair, doc = (key // len(counts)).astype(np.int32), (key % len(counts)).astype(np.int32)
            last = int(at.max())
            del key, at
            edge = np.searchsorted(pair, np.arange(last + 2, dtype=np.int32))
            del pair
            for b, names, context, own, piece in each:
                mine = slice(edge[piece.start], edge[piece.stop])
                yield _occurrence(b, name, None, _record(
                    names >> cut, context, own, docs=np.diff(edge[piece.start:piece.stop + 1]).astype(np.int32),
                    doc=doc[mine].astype(np.int32), times=times[mine].astype(np.int32)))
            name += 1

    return docs.select("id", "held_out", "text").mapInArrow(scan, _SENT + ", part long, head binary")


def _occurrence(block: int, part: int, head, data) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([0], pa.int32()), pa.array([_TEXTS], pa.int32()), pa.array([data], pa.binary()),
                                       pa.array([part]), pa.array([head], pa.binary())], names=["to", "origin", "kind", "data", "part", "head"])


def _probabilities(few: dict, told: dict, context: np.ndarray, word: np.ndarray, n: np.ndarray, mean: np.ndarray):
    """Per pair of a block: log10 probability, log10 base, known."""
    parents = [parent(told[f"customers{s}"], told[f"tables{s}"]) for s, parent in enumerate(few["parents"])]
    log = np.empty(len(n))
    for at in range(0, len(n), FOLD >> 2):
        own = slice(at, at + (FOLD >> 2))
        c, w = context[own], word[own]
        p = n[own] - few["d"] * mean[own]
        for s, x in enumerate(parents):
            p += (few["strength"] + few["d"] * told[f"seated{s}"][c]) * x[w] / len(parents)
        log[own] = np.log10(p / (few["strength"] + told["cn"][c]))
    base = np.log10((told["dn"] + 1.0) / (few["n"] + 1.0 * (few["v"] + 1)))
    return log, base[word], (told["dn"] > 0)[word]


def score(docs: DataFrame, model: Model, id_col: str = "id", part_bytes: int = PART_BYTES) -> DataFrame:
    """``id, held_out, n_tokens, n_known, base_score, score`` of every row of
    ``docs`` (``id, held_out, text``), whose pairs the model has counted.
    The model's tables are removed."""
    few = {"strength": model.strength, "d": model.d, "n": model.n, "v": model.v, "parents": [model.parent(s) for s in range(model.samples)]}
    blocks, samples = model.blocks, model.samples
    columns = ["dn", "cn", *[f"{k}{s}" for s in range(samples) for k in ("customers", "tables", "seated")]]
    told = _told(model)
    none = [F.lit(None).cast("long").alias("part"), F.lit(None).cast("binary").alias("head")]
    frames = [x.select("to", "origin", "kind", "data", *none) for x in (_of(model.pairs, _PAIRS), _of(model.seats, _SEATS), told)]
    result = "part long, head binary, data binary"

    def block_sums(batches):
        held: dict[int, list] = {}
        names = None
        for batch in batches:
            for kind, origin, data, part, head in zip(*(batch.column(c).to_pylist() for c in ("kind", "origin")), batch.column("data"),
                                                      batch.column("part").to_pylist(), batch.column("head").to_pylist()):
                if kind != _TEXTS:
                    if names is not None:
                        raise RuntimeError("a block's model came after its texts")
                    held.setdefault(kind, []).append((origin, data.as_buffer()))
                    continue
                if head is not None:
                    yield part, head, None
                    continue
                if names is None:
                    (_, m), = held.pop(_PAIRS)
                    m = _read(m)
                    (_, s), = held.pop(_SEATS)
                    s = _read(s)
                    names, n = m["names"], m["n"]
                    mean = (n == 1).astype(float)
                    mean[n >= 2] = (s["total"] + s["tables"]) / samples
                    del s
                    log, base, known = _probabilities(few, _placed(names, blocks, held.pop(_REPLY), columns), m["context"], m["word"], n, mean)
                    key = m["context"] * np.int64(len(names)) + m["word"]
                    short = names >> cut
                    del m, n, mean
                    tx.release()
                r = _read(data.as_buffer())
                at = np.searchsorted(short, r["names"])
                at = np.repeat(np.searchsorted(key, at[r["context"]] * np.int64(len(names)) + at[r["word"]]), r["docs"])
                docs_of, index = np.unique(r["doc"], return_inverse=True)
                add = lambda v: np.bincount(index, weights=v[at] * r["times"], minlength=len(docs_of))  # noqa: E731, B023
                yield part, None, _pack(doc=_steps(docs_of), known=add(known).astype(np.int32), base=add(base), score=add(log))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(block_sums(batches), {"part": pa.int64(), "head": pa.binary(), "data": pa.binary()})
        tx.release()

    texts = _occurrences(docs, blocks, part_bytes, model.bits)
    cut = np.uint64(64 - model.bits)
    # The groups keep this order (judge looks after that): of a block, its model comes before its texts.
    dealt = union_all([*frames, texts]).repartition(blocks, "to").sortWithinPartitions("to", "kind")
    sums = dealt.groupBy("to").applyInArrow(judge, result)
    sums = materialize(sums, "py-sums")
    for done in (told, model.seats, model.pairs, model.state):
        discard(done)
    final = docs.select("id", "held_out").schema.add("n_tokens", "long").add("n_known", "long").add("base_score", "double").add("score", "double")

    def finish(group: pa.Table) -> pa.Table:
        head = next(x for x in group["head"].to_pylist() if x is not None)
        table = pa.ipc.open_stream(head).read_all()
        known, base, log = np.zeros(table.num_rows, np.int64), np.zeros(table.num_rows), np.zeros(table.num_rows)
        for blob in sorted(x for x in group["data"].to_pylist() if x is not None):  # in one order, so that reruns agree
            r = _unpack(blob)
            doc = np.cumsum(r["doc"])
            known[doc] += r["known"]
            base[doc] += r["base"]
            log[doc] += r["score"]
        return pa.Table.from_arrays([*table.columns, pa.array(known), pa.array(base), pa.array(log)], names=final.names)

    return sums.groupBy("part").applyInArrow(finish, final).withColumnRenamed("id", id_col)


def block_count(docs: DataFrame, text_col: str, block_bytes: int = BLOCK_BYTES) -> int:
    size = int(docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string"))).alias("b")).first()["b"] or 0)
    return max(1, -(-size // max(block_bytes, math.isqrt(size << 10))))


@contextmanager
def _bounded(spark: SparkSession):
    """Whole texts and arrays travel a few megabytes at a time.  The arrays are
    compressed already; a codec of the written files would keep buffers outside
    the heap as large as all arrays of a file."""
    with (setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", "1000"),
          setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES)),
          setting(spark, "spark.sql.parquet.compression.codec", "uncompressed")):
        yield


def score_corpus(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", burn_in: int = BURN_IN, samples: int = SAMPLES,
                 strength: float = STRENGTH, part_bytes: int = PART_BYTES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``id_col, held_out, n_tokens, n_known, train_tokens, base_score, score`` of
    every row, learned from the rows that are not held out."""
    blocks = block_count(docs, text_col, block_bytes)
    slim = docs.select(F.col(id_col).alias("id"), held_out(id_col).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    with _bounded(docs.sparkSession):
        model = fit(slim, blocks, burn_in, samples, strength, part_bytes)
        scored = score(slim, model, id_col, part_bytes)
    return scored.withColumn("train_tokens", F.lit(model.n).cast("long"))


def perplexity(scored: DataFrame) -> DataFrame:
    """``held_out, n_tokens, perplexity, base_perplexity`` over all texts of either part."""
    per = lambda c: F.pow(F.lit(10.0), -F.sum(c) / F.sum("n_tokens"))
    return scored.groupBy("held_out").agg(F.sum("n_tokens").alias("n_tokens"), per("score").alias("perplexity"), per("base_score").alias("base_perplexity"))
