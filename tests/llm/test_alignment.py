import bisect
import collections
import hashlib

import numpy as np
import pytest

from sparkfeat.llm import alignment, queries

from ..conftest import SF_SMOKE


def _brute(texts):
    """Plain loops over the libraries' own tokens."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(alignment.BYTE_BPE)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=alignment.PIECE_BPE)
    byte = alignment._byte_of_symbol()
    rows, counts = [], collections.Counter()
    for text in texts:
        want = (" " + (text or "")).encode()
        x = a.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        y = b.encode(text) if text else []
        bx = [bytes(byte[c] for c in a.id_to_token(i)) for i in x]
        by = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in y]
        if not text or b"".join(bx) != want or b"".join(by) != want:
            rows.append(None)
            continue
        ends = lambda s: list(np.cumsum([len(t) for t in s]))
        ex, ey = ends(bx), ends(by)
        cuts = sorted(set(ex) & set(ey))
        groups, at = [], 0
        for cut in cuts:
            groups.append(([i for i in (x[k] for k in range(bisect.bisect(ex, at), bisect.bisect(ex, cut)))],
                           [i for i in (y[k] for k in range(bisect.bisect(ey, at), bisect.bisect(ey, cut)))]))
            at = cut
        overlaps = len({*zip((i for i, t in enumerate(bx) for _ in t), (j for j, t in enumerate(by) for _ in t))})
        links = collections.Counter((i, j) for g in groups for i in g[0] for j in g[1])
        counts.update(links.keys())
        rows.append((len(x), len(y), groups, overlaps, links))
    most = collections.defaultdict(int)
    for (i, _), n in counts.items():
        most[i] = max(most[i], n)
    out = []
    for r in rows:
        if r is None:
            out.append((0, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_x, n_y, groups, overlaps, links = r
        text = ";".join(f"{','.join(map(str, g[0]))}|{','.join(map(str, g[1]))}" for g in groups)
        out.append((n_x, n_y, len(groups), overlaps, sum(links.values()), sum(m for p, m in links.items() if counts[p] == most[p[0]]),
                    sum(m * counts[p] for p, m in links.items()), hashlib.sha256(text.encode()).hexdigest()))
    return out, counts


COLUMNS = ["n_a", "n_b", "n_groups", "n_overlaps", "n_links", "n_best", "count_sum", "groups_sha256"]


def _check(spark, rows, part_bytes):
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, part string").repartition(3)
    got, pairs = alignment.align(docs, part_bytes=part_bytes)
    want, counts = _brute([t for _, t in rows])
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted((tuple(r) for r in got.select("doc_id", *COLUMNS).collect()), key=key) == sorted(
        ((i, *w) for (i, _), w in zip(rows, want)), key=key)
    assert {(r["a"], r["b"]): r["n_docs"] for r in pairs.collect()} == counts


def test_odd_rows_against_plain_loops(spark, odd_rows):
    extra = ["<|endoftext|> a <s> b </s> <unk> <0x41>", "emoji 👩‍👩‍👧 \u0000 nul", "   lead", "tail   ", "\n\n\r\n\t", " ", "▁ under", "日本語のテキスト", "a" * 300,
             "ab " * 50 + " " * 200, "I'll we've don't 123456 !!!???", "ﬁ ligature Å é"]
    rows = [(r[0], r[1]) for r in odd_rows if r[1] is None or len(r[1]) < 3000] + [(900 + i, t) for i, t in enumerate(extra)]
    rows += [(950, rows[3][1]), (950, rows[3][1])]
    _check(spark, rows, 2000)


def test_long_texts(spark):
    rows = [(1, "x" * 30000), (2, " ".join(f"word{i % 97}" for i in range(6000))), (3, " " * 2500)]
    _check(spark, rows, 1 << 20)


def test_large_groups_are_not_expanded():
    """One group of many repeated tokens: multiplicities, not pairs of occurrences."""
    a, b = alignment._Tokenizer([b"aaa", b"a"]), alignment._Tokenizer([b"aa", b"aaaa", b" "])
    n = 4096
    text = "a" * (2 + 3 * n)

    class Side:
        def __init__(self, base, ids):
            self.__dict__.update(base.__dict__)
            self.joined, self.encode = base.joined, lambda texts: [ids for _ in texts]

    size = len(text) + 1
    left = alignment._Tokenizer([b" a", b"aaa", b"a"])
    right = alignment._Tokenizer([b" ", b"aa"])
    ids_a = [0, *[1] * n, 2]
    ids_b = [0, *[1] * ((size - 1) // 2)]
    assert sum(len([b" a", b"aaa", b"a"][i]) for i in ids_a) == size and (size - 1) % 2 == 0
    number, _, (doc, pair, times) = alignment.Aligner(Side(left, ids_a), Side(right, ids_b)).run([text])
    ends_a, ends_b = np.cumsum(left.length[ids_a]), np.cumsum(right.length[ids_b])
    cuts = np.intersect1d(ends_a, ends_b)
    want, at = collections.Counter(), 0
    for cut in cuts:
        x = collections.Counter(i for i, e in zip(ids_a, ends_a) if at < e <= cut)
        y = collections.Counter(i for i, e in zip(ids_b, ends_b) if at < e <= cut)
        for i, k in x.items():
            for j, m in y.items():
                want[i * right.size + j] += k * m
        at = cut
    assert dict(zip(pair.tolist(), times.tolist())) == want and number[4, 0] == sum(want.values())
    assert a.size and b.size


def test_products_against_dense():
    r = np.random.default_rng(5)
    x, y = (r.random((13, 7)) < 0.4) * r.integers(1, 5, (13, 7)), (r.random((7, 11)) < 0.5) * r.integers(1, 5, (7, 11))
    csr = lambda m: alignment.Csr.of(*np.nonzero(m), m[np.nonzero(m)], m.shape[0], m.shape[1])
    for expand in (1, 10, 1 << 20):
        out = np.zeros((13, 11), np.int64)
        for row, column, value in alignment.products(csr(x), csr(y), expand):
            np.add.at(out, (row, column), value)
        assert (out == x @ y).all()
    t = csr(x).transposed()
    assert all((t.data[t.indptr[j]:t.indptr[j + 1]] == x[:, j][x[:, j] > 0]).all() for j in range(7))


def test_empty_table(spark, no_docs):
    got, pairs = alignment.align(no_docs)
    assert got.count() == 0 and pairs.count() == 0


@pytest.mark.parametrize("engine", ["same", "reordered"])
def test_engine_follows_the_file(engine):
    """The merge engine is used only where the file's ids are its merge ranks."""
    import json

    content = open(alignment.BYTE_BPE, "rb").read()
    texts = ["Hello world  it's 2024!\n\n\tTabs", "naïve café ñandú 東京   em", "x" * 50, " "]
    from tokenizers import Tokenizer
    if engine == "reordered":
        model = json.loads(content)
        vocab = model["model"]["vocab"]
        a, b = "Ġthe", "Ġof"
        vocab[a], vocab[b] = vocab[b], vocab[a]
        content = json.dumps(model).encode()
    own = Tokenizer.from_buffer(content)
    own.encode_special_tokens = True
    got = alignment.ByteBpe(content).encode(texts)
    assert [list(map(int, g)) for g in got] == [e.ids for e in own.encode_batch([" " + t for t in texts], add_special_tokens=False)]


def test_query_against_plain_loops(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMOKE}/documents.parquet").select("doc_id", "text").collect()]
    short = [r for r in rows if r[1] is None or len(r[1]) < 4000]
    assert len(short) > 100
    _check(spark, short, 1 << 18)
    got = queries.op13_alignment(spark, SF_SMOKE)
    assert got.columns[:9] == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps"]
    assert got.count() == len(rows)
