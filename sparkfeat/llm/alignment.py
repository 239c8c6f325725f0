"""Links between the tokens of two tokenizers on the same texts.

Each text is encoded twice: space + text by a byte-level BPE (A), the text by
a sentence-piece BPE (B, which adds the space itself).  Token-byte incidence
matrices are built as CSR arrays; Gustavson row products A x B' give the links
of tokens that overlap in bytes, and products of the group incidences (a group
is what lies between two byte offsets at which tokens of both end) give the
links of tokens that share a group.  Repeated ids inside a large group are
merged with their multiplicity first, so a group is never expanded pair by
pair of occurrences.

How often an id pair is linked is counted over the whole corpus.  Texts are
scanned once, in parts of bounded bytes.  A part keeps its documents' links as
indexes into its own distinct pairs; only these pairs, at most once per part,
are counted, looked up and sent back by Spark's aggregates and joins, so a pair
that occurs everywhere is one row per part.

Tokenizer files are read on the driver from the paths given and broadcast as
they are (a few MB, fixed by the vocabularies).  The byte-level BPE is run by
a merge engine built from the file's own vocabulary and merges: where the ids
are the ranks of the merges (checked) both give the same tokens, and this one
takes a quarter of the time; otherwise the file's own library encodes.

Defined cases: a text that is null or empty, or whose tokens of A or of B do
not join to space + text, has no tokens: all numbers 0 and the digest ''.
Every row counts as a document of its own, repeated rows and null ids too.  An
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import io
import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import text as tx

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_BPE = "/opt/tokenizers/piece_bpe_32k.model"
PART_BYTES = 24 << 20
#: Entries of a matrix product that are held at once.
EXPAND = 1 << 21
#: Fixed value: the split of byte-level BPE into pieces before merging.
PIECES = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
NUMBERS = ["n_a", "n_b", "n_groups", "n_overlaps", "n_links"]


# ---- CSR ------------------------------------------------------------------

@dataclass
class Csr:
    """Rows ``indices[indptr[i]:indptr[i + 1]]`` with values ``data``."""
    indptr: np.ndarray
    indices: np.ndarray
    data: np.ndarray
    columns: int

    @classmethod
    def of(cls, rows: np.ndarray, indices: np.ndarray, data: np.ndarray, n_rows: int, columns: int) -> "Csr":
        """From entries whose ``rows`` ascend."""
        return cls(np.searchsorted(rows, np.arange(n_rows + 1)), indices, data, columns)

    @classmethod
    def intervals(cls, ends: np.ndarray, n: int) -> "Csr":
        """Token-byte incidence of tokens that follow one another and end at ``ends``."""
        return cls(np.concatenate([[0], ends]), np.arange(n), np.ones(n, np.int64), n)

    def transposed(self) -> "Csr":
        order = np.argsort(self.indices, kind="stable")
        rows = np.repeat(np.arange(len(self.indptr) - 1), np.diff(self.indptr))
        return Csr.of(self.indices[order], rows[order], self.data[order], self.columns, len(self.indptr) - 1)


def products(a: Csr, b: Csr, expand: int = EXPAND):
    """``a @ b`` by row products: row ``i`` is the sum of ``b``'s rows at the
    columns of ``a``'s row ``i``.  Yields ``(row, column, value)`` arrays, one
    entry per cell, rows ascending, for runs of whole entries of ``a`` that
    expand to about ``expand`` cells (cells of a row may come in several runs)."""
    width = np.diff(b.indptr)[a.indices]
    owner = np.repeat(np.arange(len(a.indptr) - 1), np.diff(a.indptr))
    total = np.concatenate([[0], np.cumsum(width)])
    at = 0
    while at < len(width):
        to = max(at + 1, int(np.searchsorted(total, total[at] + expand, "right")) - 1)
        own = slice(at, to)
        w = width[own]
        place = np.arange(total[to] - total[at]) - np.repeat(total[at:to] - total[at] - b.indptr[a.indices[own]], w)
        key = np.repeat(owner[own], w) * np.int64(b.columns) + b.indices[place]
        yield *_summed(key, np.repeat(a.data[own], w) * b.data[place], b.columns),
        at = to


def _summed(key: np.ndarray, value: np.ndarray, columns: int):
    if len(key) and not (key[1:] >= key[:-1]).all():
        order = np.argsort(key, kind="stable")
        key, value = key[order], value[order]
    key, value = _merged(key, value)
    return key // columns, key % columns, value


def _merged(key: np.ndarray, value: np.ndarray):
    """One entry per distinct key of a sorted array, values summed."""
    if not len(key):
        return key, value
    begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[begin], np.add.reduceat(value, begin)


# ---- Tokenizers -----------------------------------------------------------

def _byte_of_symbol() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 stands for itself, the other
    bytes follow from code point 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Tokenizer:
    def __init__(self, entries: list[bytes]):
        self.size = len(entries)
        self.length = np.array([len(e) for e in entries], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.data = np.frombuffer(b"".join(entries), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the tokens, one after another."""
        n = self.length[ids]
        end = np.cumsum(n)
        return self.data[np.arange(int(end[-1]) if len(end) else 0) + np.repeat(self.start[ids] - (end - n), n)]


class ByteBpe(_Tokenizer):
    def __init__(self, content: bytes):
        model = json.loads(content)
        byte = _byte_of_symbol()
        vocabulary = dict(model["model"]["vocab"])
        special = {t["content"]: t["id"] for t in model.get("added_tokens", [])}
        entries = [b""] * (1 + max([*vocabulary.values(), *special.values()]))
        plain = {}
        for token, i in vocabulary.items():
            if token in special:
                entries[i] = token.encode()
            else:
                entries[i] = bytes(byte[c] for c in token)
                plain[entries[i]] = i
        super().__init__(entries)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
        merged = [vocabulary.get(a + b) for a, b in pairs]
        pre = model.get("pre_tokenizer") or {}
        ranks = merged == list(range(256, 256 + len(merged))) and len(plain) == 256 + len(merged)
        if ranks and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and not model.get("normalizer"):
            import tiktoken

            engine = tiktoken.Encoding("own", pat_str=PIECES, mergeable_ranks=plain, special_tokens={})
            self.encode = lambda texts: [engine.encode_to_numpy(" " + t, disallowed_special=()) for t in texts]
        else:
            from tokenizers import Tokenizer

            own = Tokenizer.from_buffer(content)
            own.encode_special_tokens = True
            own.no_padding(), own.no_truncation()
            self.encode = lambda texts: [e.ids for e in own.encode_batch([" " + t for t in texts], add_special_tokens=False)]


class PieceBpe(_Tokenizer):
    def __init__(self, content: bytes):
        import sentencepiece

        own = sentencepiece.SentencePieceProcessor(model_proto=content)
        piece = [own.id_to_piece(i) for i in range(own.vocab_size())]
        super().__init__([bytes([int(p[3:5], 16)]) if own.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(piece)])
        self.encode = lambda texts: own.encode(texts, num_threads=1)


_LOADED: dict[int, tuple] = {}


def _load(shared) -> tuple[ByteBpe, PieceBpe]:
    """Both tokenizers, built once per worker."""
    if shared.value[0] not in _LOADED:
        _LOADED[shared.value[0]] = (ByteBpe(shared.value[1]), PieceBpe(shared.value[2]))
    return _LOADED[shared.value[0]]


# ---- One run of texts -----------------------------------------------------

def _flat(lists) -> tuple[np.ndarray, np.ndarray]:
    n = np.array([len(x) for x in lists], np.int64)
    out = np.empty(int(n.sum()), np.int64)
    at = 0
    for x, k in zip(lists, n.tolist()):
        out[at:at + k] = x
        at += k
    return out, n


def _faithful(side: _Tokenizer, ids: np.ndarray, n: np.ndarray, data: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Of which texts the tokens join to the text's bytes."""
    first = np.concatenate([[0], np.cumsum(n)])
    good = tx.per_text(side.length[ids], first) == size
    own = side.joined(ids[np.repeat(good, n)])
    want = data[np.repeat(good, size)]
    edge = np.concatenate([[0], np.cumsum(size[good])])
    good[good] = tx.per_text(own != want, edge) == 0
    return good


def _digests(table: np.ndarray, width: np.ndarray, a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray,
             group_doc: np.ndarray, n_docs: int) -> list[str]:
    """Digest of ``a1,a2|b1;a3|b2,b3`` of each document."""
    groups = len(group_doc)
    n_a, n_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
    end_a, end_b = np.cumsum(n_a), np.cumsum(n_b)
    ids = np.empty(len(a) + len(b), np.int64)
    ids[np.arange(len(a)) + (end_b - n_b)[group_a]] = a
    ids[np.arange(len(b)) + end_a[group_b]] = b
    mark = np.full(len(ids), ord(","), np.uint8)
    last = end_a + end_b - 1
    mark[last - n_b] = ord("|")
    mark[last] = ord(";")
    rows = table[ids]
    length = width[ids]
    rows[np.arange(len(ids)), length] = mark
    size = length + 1
    text = rows[np.arange(rows.shape[1]) < size[:, None]].tobytes()
    doc_end = np.cumsum(size)[last[np.searchsorted(group_doc, np.arange(n_docs), "right") - 1]] if groups else np.zeros(n_docs, np.int64)
    out, at = [], 0
    has = np.bincount(group_doc, minlength=n_docs) > 0
    for end, some in zip(doc_end.tolist(), has.tolist()):
        if some:
            out.append(hashlib.sha256(memoryview(text)[at:end - 1]).hexdigest())
            at = end
        else:
            out.append("")
    return out


def _digits(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of 0 to n - 1, with one place to spare, and their number."""
    names = [str(i).encode() for i in range(n)]
    width = np.array([len(x) for x in names])
    table = np.array(names, f"S{width.max() + 1}").view(np.uint8).reshape(n, -1)
    return table, width


def _compressed(group: np.ndarray, ids: np.ndarray, merge: np.ndarray, size: int):
    """(group, id, multiplicity) of tokens, groups ascending; ids of the groups in
    ``merge`` are merged."""
    inside = merge[group]
    if not inside.any():
        return group, ids, np.ones(len(ids), np.int64)
    key, n = np.unique(group[inside] * np.int64(size) + ids[inside], return_counts=True)
    g = np.concatenate([group[~inside], key // size])
    order = np.argsort(g, kind="stable")
    return (g[order], np.concatenate([ids[~inside], key % size])[order],
            np.concatenate([np.ones(int((~inside).sum()), np.int64), n])[order])


class Aligner:
    def __init__(self, a: _Tokenizer, b: _Tokenizer):
        self.a, self.b = a, b
        self.table, self.width = _digits(max(a.size, b.size))

    def run(self, texts: list[str]):
        """Numbers (one column of ``NUMBERS`` each) and digests of the texts, and
        the entries ``(text, pair, multiplicity)`` of their shared-group links;
        a pair is ``a * size of B + b``."""
        n_docs = len(texts)
        own = [t for t in texts if t]
        place = np.array([i for i, t in enumerate(texts) if t], np.int64)
        raw = [b" " + t.encode() for t in own]
        size = np.array([len(x) for x in raw], np.int64)
        data = np.frombuffer(b"".join(raw), np.uint8)
        ids_a, n_a = _flat(self.a.encode(own) if own else [])
        ids_b, n_b = _flat(self.b.encode(own) if own else [])
        good = _faithful(self.a, ids_a, n_a, data, size) & _faithful(self.b, ids_b, n_b, data, size)
        ids_a, ids_b, place = ids_a[np.repeat(good, n_a)], ids_b[np.repeat(good, n_b)], place[good]
        n_a, n_b, size = n_a[good], n_b[good], size[good]
        total = int(size.sum())

        end_a, end_b = np.cumsum(self.a.length[ids_a]), np.cumsum(self.b.length[ids_b])
        ends = np.zeros(total + 1, bool)
        ends[end_a] = True
        both = end_b[ends[end_b]]
        ends[:] = False
        ends[both] = True
        before = np.cumsum(ends) - ends          # groups that end before each offset
        group_a, group_b = before[end_a], before[end_b]
        group_text = np.searchsorted(np.cumsum(size), both)  # a group ends inside its text or at its end
        groups = len(both)

        number = np.zeros((len(NUMBERS), n_docs), np.int64)
        number[0, place], number[1, place] = n_a, n_b
        number[2, place] = np.bincount(group_text, minlength=len(place))
        byte_b = Csr.intervals(end_b, total)
        by_byte = Csr(np.arange(total + 1), np.repeat(np.arange(len(ids_b)), np.diff(byte_b.indptr)), byte_b.data, max(1, len(ids_b)))
        text_a = np.repeat(np.arange(len(place)), n_a)
        shared = np.zeros(len(place), np.int64)
        last = (-1, -1)
        for row, column, _ in products(Csr.intervals(end_a, total), by_byte):
            # A run may begin inside a token, whose last cell then comes twice.
            skip = int(len(row) > 0 and (int(row[0]), int(column[0])) == last)
            shared += np.bincount(text_a[row[skip:]], minlength=len(place))
            last = (int(row[-1]), int(column[-1]))
        number[3, place] = shared

        in_a, in_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
        number[4, place] = tx.per_text(in_a * in_b, np.searchsorted(group_text, np.arange(len(place) + 1)))
        merge = in_a * in_b > 64
        ga, xa, ma = _compressed(group_a, ids_a, merge, self.a.size)
        gb, xb, mb = _compressed(group_b, ids_b, merge, self.b.size)
        left = Csr(np.arange(len(ga) + 1), ga, ma, groups)
        right = Csr.of(gb, np.arange(len(gb)), mb, groups, max(1, len(gb)))
        found = []
        for row, column, value in products(left, right):
            key = (group_text[ga[row]] << 32) + xa[row] * np.int64(self.b.size) + xb[column]
            order = np.argsort(key, kind="stable")
            found.append(_merged(key[order], value[order]))
        if len(found) > 1:
            key, value = (np.concatenate(c) for c in zip(*found))
            order = np.argsort(key, kind="stable")
            found = [_merged(key[order], value[order])]
        key, value = found[0] if found else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        digest = np.full(n_docs, "", object)
        digest[place] = _digests(self.table, self.width, ids_a, ids_b, group_a, group_b, group_text, len(place))
        return number, digest, (place[key >> 32], key & 0xFFFFFFFF, value)


# ---- Spark ----------------------------------------------------------------

def _pack(a: np.ndarray, dtype) -> bytes:
    return zstandard.compress(a.astype(dtype).tobytes(), 1)


def _unpack(b: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(b), dtype).astype(np.int64)


def _to_bytes(table: pa.Table) -> bytes:
    out = io.BytesIO()
    with pa.ipc.new_stream(out, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_table(table)
    return out.getvalue()


class _Part:
    """Documents of a part and their links, as indexes into the distinct pairs."""

    def __init__(self):
        self.rows, self.numbers, self.digests, self.links, self.size, self.n = [], [], [], [], 0, 0

    def add(self, rows: pa.Table, size: int, number, digest, entries):
        doc, pair, times = entries
        self.rows.append(rows)
        self.numbers.append(number)
        self.digests.append(digest)
        self.links.append((np.bincount(doc, minlength=rows.num_rows), pair.astype(np.int32), times.astype(np.int32)))
        self.size += size

    def packed(self, name: int) -> pa.RecordBatch:
        table = pa.concat_tables(self.rows)
        for i, c in enumerate(NUMBERS):
            table = table.append_column(c, pa.array(np.concatenate([x[i] for x in self.numbers])))
        table = table.append_column("groups_sha256", pa.array(np.concatenate(self.digests), pa.string()))
        count, pair, times = (np.concatenate(c) for c in zip(*self.links))
        distinct, index, docs = np.unique(pair, return_inverse=True, return_counts=True)
        # Within a document the pairs ascend, so index differences are small.
        step = np.diff(index, prepend=0)
        blob = [_to_bytes(table), _pack(count, np.int32), _pack(step, np.int32), _pack(times, np.int32),
                _pack(np.diff(distinct, prepend=distinct.dtype.type(0)), np.int32), _pack(docs, np.int32)]
        return pa.RecordBatch.from_arrays([pa.array([name]), *[pa.array([x], pa.binary()) for x in blob]],
                                          names=["part", "docs", "n_pairs", "steps", "times", "pairs", "n"])


_PART_SCHEMA = "part long, docs binary, n_pairs binary, steps binary, times binary, pairs binary, n binary"


def _parts(docs: DataFrame, shared, part_bytes: int) -> DataFrame:
    def scan(batches):
        a, b = _load(shared)
        aligner, part, seq = Aligner(a, b), _Part(), TaskContext.get().partitionId() << 32
        for batch in batches:
            for texts in tx.chunks(batch.column(1)):
                own = slice(texts.first, texts.first + len(texts))
                rows = pa.Table.from_batches([batch.slice(own.start, len(texts)).select([0])])
                part.add(rows, len(texts.data), *aligner.run(batch.column(1).slice(own.start, len(texts)).to_pylist()))
                if part.size >= part_bytes:
                    yield part.packed(seq)
                    part, seq = _Part(), seq + 1
        if part.rows:
            yield part.packed(seq)

    return materialize(docs.mapInArrow(scan, _PART_SCHEMA), "align-parts")


def _pairs(parts: DataFrame) -> DataFrame:
    def unfold(batches):
        for batch in batches:
            for row in batch.to_pylist():
                pair = np.cumsum(_unpack(row["pairs"], np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pair), row["part"])), pa.array(pair.astype(np.int32)),
                                                  pa.array(_unpack(row["n"], np.int32))], names=["part", "pair", "n"])

    return parts.select("part", "pairs", "n").mapInArrow(unfold, "part long, pair int, n long")


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", byte_bpe: str = BYTE_BPE,
          piece_bpe: str = PIECE_BPE, part_bytes: int = PART_BYTES) -> tuple[DataFrame, DataFrame]:
    """``(documents, pairs)``.  ``documents``: ``id_col``, numbers of tokens,
    groups, overlap links and shared-group links, ``n_best``, ``count_sum`` and
    ``groups_sha256`` of every row.  ``pairs``: ``a, b, n_docs, best`` of every
    linked id pair of the corpus (best: no pair of the same A id is in more)."""
    spark = docs.sparkSession
    files = []
    for path in (byte_bpe, piece_bpe):
        with open(path, "rb") as f:
            files.append(f.read())
    import sentencepiece

    size_b = sentencepiece.SentencePieceProcessor(model_proto=files[1]).vocab_size()
    shared = spark.sparkContext.broadcast((hash((byte_bpe, piece_bpe, len(files[0]), len(files[1]))), *files))
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    parts = _parts(slim, shared, part_bytes)
    pairs = _pairs(parts)
    counts = materialize(pairs.groupBy("pair").agg(F.sum("n").alias("n_docs")).withColumn("a", F.floor(F.col("pair") / size_b).cast("int")), "align-counts")
    most = counts.groupBy("a").agg(F.max("n_docs").alias("most"))  # a row per id of A: bounded by its vocabulary
    counted = counts.join(F.broadcast(most), "a").select("a", "pair", "n_docs", (F.col("n_docs") == F.col("most")).alias("best"))
    found = pairs.select("part", "pair").join(counted.select("pair", "n_docs", "best"), "pair")

    id_type = slim.schema["id"].dataType
    schema = slim.select("id").withColumnRenamed("id", id_col).schema
    for c in [*NUMBERS, "n_best", "count_sum"]:
        schema = schema.add(c, "long")
    schema = schema.add("groups_sha256", "string")
    assert id_type == schema[id_col].dataType

    def finish(own: pa.Table, looked_up: pa.Table) -> pa.Table:
        row = own.to_pylist()[0]
        table = pa.ipc.open_stream(row["docs"]).read_all()
        order = np.argsort(looked_up["pair"].to_numpy())
        n_docs, best = looked_up["n_docs"].to_numpy()[order], looked_up["best"].to_numpy()[order]
        first = np.concatenate([[0], np.cumsum(_unpack(row["n_pairs"], np.int32))])
        index, times = np.cumsum(_unpack(row["steps"], np.int32)), _unpack(row["times"], np.int32)
        columns = [table.column(i) for i in range(1 + len(NUMBERS))]
        columns += [pa.array(tx.per_text(times * best[index], first)), pa.array(tx.per_text(times * n_docs[index], first))]
        return pa.Table.from_arrays([*columns, table["groups_sha256"]], names=schema.names)

    done = parts.select("part", "docs", "n_pairs", "steps", "times").groupBy("part").cogroup(found.groupBy("part")).applyInArrow(finish, schema)
    return done, counted.select("a", (F.col("pair") % size_b).alias("b"), "n_docs", "best")
