import collections
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkfeat.llm import pitman_yor as P
from sparkfeat.llm import queries

from . import brute
from ..conftest import SF_SMALL

IN = "doc_id long, text string"


def _partitions(n):
    """Block sizes of every set partition of n customers."""
    def grow(sizes, left):
        if not left:
            yield tuple(sizes)
            return
        for i in range(len(sizes)):
            yield from grow([*sizes[:i], sizes[i] + 1, *sizes[i + 1:]], left - 1)
        yield from grow([*sizes, 1], left - 1)
    yield from grow([], n)


def test_seating_follows_the_exact_conditional():
    d, strength, others, parent = 0.6, 1.3, 7, 0.08
    rng = np.random.default_rng(3)
    for c in (2, 5, 7):
        weight = np.zeros(c + 1)
        for sizes in _partitions(c):
            w = np.prod([np.prod(np.arange(1, k) - d) for k in sizes])
            for i in range(len(sizes)):
                w *= (strength + d * (others + i)) * parent
            weight[len(sizes)] += w
        n = 60000
        got = np.bincount(P.seat(rng, np.full(n, c), others, parent, d, strength), minlength=c + 1) / n
        assert np.abs(got - weight / weight.sum()).max() < 0.01


@pytest.mark.parametrize("others, parent", [(3, 0.01), (500, 0.02), (20000, 1e-4), (100, 0.3)])
@pytest.mark.parametrize("d", [0.3, 0.8])
def test_many_customers_follow_the_same_law(others, parent, d):
    n = 4000
    exact = P.seat(np.random.default_rng(1), np.full(n, 900), others, parent, d, 1.0)
    scaled = P.seat(np.random.default_rng(2), np.full(n, 900), others, parent, d, 1.0, exact=300)
    assert abs(exact.mean() - scaled.mean()) < 0.05 * exact.mean() + 0.05
    assert abs(exact.std() - scaled.std()) < 0.15 * exact.std() + 0.1


def test_hot_pair_costs_no_more():
    got = P.seat(np.random.default_rng(0), np.array([10**9, 2000, 2, 1]), 5000, 0.01, 0.5, 1.0)
    assert 1 < got[0] < 10**7 and 1 <= got[1] <= 2000 and got[3] == 1
    x = np.array([0.5, 1.0, 3.3, 40.0, 1e6])
    assert np.allclose(P._log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-10, atol=1e-9)


def _tokens(text):
    return brute.SPACE.findall(brute.lower(text or "")) + [None]


def _held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def _hashes(words):
    import pyarrow as pa
    from sparkfeat.llm import text as tx

    if not words:
        return {}
    t = next(tx.chunks(pa.array([" ".join(words)]), 1 << 40))
    return dict(zip(words, t.words(t.data, tx.SPACE).hashes().tolist()))


def _brute_base(rows):
    counts = collections.Counter(w for i, t in rows if not _held(i) for w in _tokens(t))
    n, v = sum(counts.values()), len(counts)
    return n, {(i, t): (_held(i), len(_tokens(t)), sum(counts[w] > 0 for w in _tokens(t)), n,
                        sum(math.log10((counts[w] + 1) / (n + 1 * (v + 1))) for w in _tokens(t))) for i, t in rows}


def _close(a, b):
    return abs(a - b) <= 1e-6 * max(1.0, abs(b))


@pytest.mark.parametrize("part, blocks", [(1 << 20, 1), (3000, 5)])
def test_scores_follow_the_sampled_seatings(spark, odd_rows, part, blocks):
    """Scores recomputed with dictionaries from the model's tables; the tables
    themselves are consistent at every level."""
    rows = [(r[0], r[1]) for r in odd_rows]
    docs = spark.createDataFrame(rows, IN).repartition(4)
    slim = docs.select(F.col("doc_id").alias("id"), P.held_out("doc_id").alias("held_out"), "text")
    model = P.fit(slim, blocks, part_bytes=part)
    names = _hashes(sorted({w for _, t in rows for w in _tokens(t) if w}))
    names[None] = int(P.END)
    pairs = collections.Counter()
    for i, t in rows:
        w = _tokens(t)
        if not _held(i):
            pairs.update(zip([int(P.BEGIN), *[names[x] for x in w[:-1]]], [names[x] for x in w]))
    # Counts of the model.
    got, mean, last = {}, {}, {}
    for r in P._of(model.pairs, P._PAIRS).collect():
        m = P._read(bytes(r["data"]))
        got |= {(int(m["names"][c]), int(m["names"][w])): int(n) for c, w, n in zip(m["context"], m["word"], m["n"])}
    assert {p: n for p, n in got.items() if n} == dict(pairs)
    for r in P._of(model.seats, P._SEATS).collect():
        s = P._read(bytes(r["data"]))
        for c, w, n, t, total in zip(s["context"], s["word"], s["n"], s["tables"], s["total"]):
            p = (int(s["names"][c]), int(s["names"][w]))
            assert n == pairs[p] >= 2 and 1 <= t <= n and model.samples <= total + t <= model.samples * n
            mean[p], last[p] = (total + t) / model.samples, int(t)
    assert set(mean) == {p for p, n in pairs.items() if n >= 2}
    word, context, samples = collections.Counter(), collections.Counter(), []
    for (c, w), n in pairs.items():
        word[w] += n
        context[c] += n
    for root, (total, tables) in zip(model.roots, model.scalars):
        customers, t, seated = collections.Counter(), collections.Counter(), collections.Counter()
        home = {r["to"]: P._words(bytes(r["data"])) for r in P._of(model.state, P._STATE).collect()}
        for r in root.collect():
            x, w = P._unpack(bytes(r["data"])), home[r["to"]]
            for key, n, dn, k, seats, here in zip(w["names"].tolist(), [word[k] for k in w["names"].tolist()], w["dn"], x["customers"], x["tables"], x["seated"]):
                assert n == dn and min(1, n) <= seats <= k <= n and word[key] == n
                customers[key], t[key], seated[key] = int(k), int(seats), int(here)
        assert sum(customers.values()) == total == sum(seated.values()) and sum(t.values()) == tables
        seated = collections.Counter({c: n for c, n in seated.items() if n})
        samples.append((customers, t, seated, total, tables))
    own_tables = collections.Counter()
    for p, n in pairs.items():
        own_tables[p[0]] += last.get(p, 1)
    assert own_tables == samples[-1][2]  # the last sample's restaurants

    def parent(s, w):
        customers, t, _, total, tables = samples[s]
        return (customers[w] - model.d_root * t[w] + (1 + model.d_root * tables) / (model.v + 1)) / (1 + total)

    def probability(c, w):
        n = pairs[c, w]
        p = n - model.d * (mean[c, w] if n >= 2 else n)
        p += sum((1 + model.d * samples[s][2][c]) * parent(s, w) for s in range(model.samples)) / model.samples
        return p / (1 + context[c])

    for c in [*list(context)[:20], int(P.BEGIN), 12345]:
        assert _close(sum(probability(c, w) for w in word) + probability(c, 99), 1.0)
    n, base = _brute_base(rows)
    assert (model.n, model.v) == (n, len(word))
    plain = {}
    for i, t in rows:
        w = [names[x] for x in _tokens(t)]
        plain.setdefault(i, []).append((len(w), sum(math.log10(probability(c, x)) for c, x in zip([int(P.BEGIN), *w], w))))
    got = collections.defaultdict(list)
    for r in P.score(slim, model, part_bytes=part).collect():
        got[r["id"]].append((r["n_tokens"], r["score"]))
    assert set(got) == set(plain)
    for i in plain:
        for a, b in zip(sorted(got[i]), sorted(plain[i]), strict=True):
            assert a[0] == b[0] and abs(a[1] - b[1]) <= 2e-6 * max(1, abs(b[1])), i


def test_a_group_is_never_held_whole(spark):
    """A block's rows come to Python in batches, and written arrays pass no codec
    (both kept buffers of a whole block's or file's size per task before)."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    rows = [(i % 2, i, P._PAIRS, np.random.default_rng(i).bytes(400_000)) for i in range(80)]

    def most(to, rows):
        held = [pa.total_allocated_bytes() for _ in rows]
        yield to, len(held), P._PAIRS, str(max(held)).encode()

    with P._bounded(spark):
        found = P._grouped([spark.createDataFrame(rows, P._SENT)], 2, most, "py-test")
    assert sorted((r["to"], r["origin"]) for r in found.collect()) == [(0, 40), (1, 40)]
    assert all(int(bytes(r["data"])) < 8_000_000 for r in found.collect())  # 16,000,000 a group
    for path in found.inputFiles():
        meta = pq.read_metadata(path.removeprefix("file://"))
        assert all(meta.row_group(g).column(3).compression == "UNCOMPRESSED" for g in range(meta.num_row_groups))


def test_pairs_of_many_parts_fold_in_steps():
    rng = np.random.default_rng(0)
    want, runs, some = collections.Counter(), [], []
    for i in range(7):
        names = np.unique(rng.integers(0, 60, 30).astype(np.uint64) << np.uint64(50))
        key = np.unique(rng.integers(0, len(names) ** 2, 200))
        r = {"names": names, "context": key // len(names), "word": key % len(names), "n": rng.integers(0, 4, len(key)).astype(np.int32)}
        for c, w, n in zip(r["context"], r["word"], r["n"]):
            want[int(names[c]), int(names[w])] += int(n)
        some.append(r)
        if i % 3 == 2:
            runs.append(P._folded(some))
    got = P._folded(runs + some)
    pairs = list(zip(got["names"][got["context"]].tolist(), got["names"][got["word"]].tolist()))
    assert pairs == sorted(set(pairs)) and dict(zip(pairs, got["n"].tolist())) == dict(want)


def test_odd_rows_base(spark, odd_docs, odd_rows):
    rows = [(r[0], r[1]) for r in odd_rows]
    n, want = _brute_base(rows)
    got = P.score_corpus(odd_docs, part_bytes=5000, block_bytes=20000).collect()
    flat = lambda rows: sorted(((r[0] is None, r[0] or 0, *r[1:5], round(r[5], 6)) for r in rows))
    assert flat((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got) == flat(
        (i, *want[i, t]) for i, t in rows)
    assert all(r["score"] < 0 for r in got)


def test_nothing_to_learn(spark, no_docs):
    assert P.score_corpus(no_docs).count() == 0
    held = next(i for i in range(100) if _held(i))
    row = P.score_corpus(spark.createDataFrame([(held, "a b c")], IN)).first()
    assert (row["held_out"], row["n_tokens"], row["n_known"], row["train_tokens"]) == (True, 4, 0, 0)
    assert row["base_score"] == 0.0 and abs(row["score"]) < 1e-6


def test_query_beats_single_words_on_held_out_texts(spark):
    scored = queries.op12_pitman_yor(spark, SF_SMALL).cache()
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    _, want = _brute_base(rows)
    want = {i: w for (i, _), w in want.items()}
    got = scored.collect()
    assert len(got) == len(rows)
    for r in got:
        w = want[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == w[:4] and _close(r["base_score"], w[4])
    for r in P.perplexity(scored).collect():
        assert r["perplexity"] < 0.5 * r["base_perplexity"]
