"""Quality rules whose thresholds are set under a proven risk.

Each rule compares a score of a document with a cutoff.  On labelled documents
(quality 1 = good) the number of good documents a cutoff would reject is a
binomial count, so an exact binomial test tells whether the cutoff's false
rejection rate exceeds the allowed one.  Per stratum and rule the cutoffs are
tested from the loosest to the strictest and the last certified one is used
(fixed-sequence testing, which needs no correction along the sequence); the
error probability is shared among all strata and rules (Bonferroni).  A rule
that cannot be certified in a stratum rejects nothing there.

The holdout has one trial per document and per text: rows of one id, and copies
of one text, are not independent.  Good is quality 1 and not toxic.  Toxic
texts are caught by a content score, the number of words that a share of the
labelled documents (at most ``LEARN`` of either kind, none of them in the
holdout) shows to be typical of toxic ones; its cutoff is certified like the
others.

Defined cases: a null text has no words (so its base rules fail); null strata
are a stratum of their own; labels without a document, null labels and
conflicting repeated labels of a document are ignored; without labels only
the base rules act; an empty table gives an empty result.  Repeated rows are
judged alike.  Extra input columns are kept by ``apply_rules``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import text as tx

SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
REPEAT_WINDOW = 8
#: Of this many labelled documents one teaches the content score; the others are the holdout.
TEACH_EVERY = 8
LEARN = 20_000
#: Least log-likelihood ratio of a word that is typical of toxic texts, and their largest number.
TYPICAL, MOST_TYPICAL = 30.0, 10_000
METRICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words", "n_upper", "n_letters",
           "n_marks", "n_toxic", "n_texts"]


@dataclass(frozen=True)
class Rule:
    """Reject where the ratio of two metrics exceeds the cutoff (no verdict where
    the divisor is 0); ``cutoffs`` run from the loosest to the strictest."""
    name: str
    part: str
    whole: str
    cutoffs: tuple[float, ...]

    def exceeds(self, cutoff) -> F.Column:
        return F.coalesce(F.try_divide(F.col(self.part), F.col(self.whole)) > cutoff, F.lit(False))


PRODUCTION_RULES = (
    Rule("symbols_per_word", "n_symbols", "n_words", (2.0, 1.5, 1.0, 0.75, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1)),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", (0.9, 0.8, 0.7, 0.6, 0.5, 0.45, 0.4, 0.35, 0.3)),
    Rule("repeated_words", "n_repeat_words", "n_words", (0.28, 0.25, 0.22, 0.2, 0.18, 0.15)),
    Rule("upper_case", "n_upper", "n_letters", (0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4)),
    Rule("exclamations", "n_marks", "n_words", (2.0, 1.5, 1.0, 0.8, 0.6, 0.5, 0.4, 0.3)),
    Rule("toxic_words", "n_toxic", "n_texts", (50.0, 20.0, 10.0, 5.0, 3.0, 2.0, 1.0, 0.0)),
    Rule("long_words", "word_chars", "n_words", (40.0, 30.0, 25.0, 20.0, 17.0, 15.0, 13.0, 12.0)),
)
MAX_FALSE_REJECTION = 0.01
ERROR_PROBABILITY = 0.05


def _word_hashes(texts: tx.Texts) -> tuple[np.ndarray, tx.Words]:
    words = texts.words(tx.LOWER[texts.data], tx.SPACE)
    return words.hashes(), words


def _metrics(texts: tx.Texts, typical: np.ndarray) -> list[np.ndarray]:
    data = texts.data
    words = texts.words(data, tx.SPACE)
    n = len(words)
    count = lambda member: tx.per_text(member, texts.offsets)
    in_word = ~tx.SPACE[data]
    first_byte = (data & 0xC0) != 0x80
    doc = words.doc()

    # Lines with a word, hashed whole; repeats within one text.
    lines_at, lines_end = texts.runs(data != 10)
    has_word = (np.searchsorted(words.starts, lines_end) - np.searchsorted(words.starts, lines_at)) > 0
    lines_at, lines_end = lines_at[has_word], lines_end[has_word]
    line_doc = np.searchsorted(texts.offsets, lines_at, "right") - 1
    bytes_hash = tx.Rolling(tx.BYTE_VALUE[data])
    line = tx.mix(bytes_hash.spans(lines_at, lines_end) + (lines_end - lines_at).astype(np.uint64))
    line = tx.mix(line + line_doc.astype(np.uint64))
    order = np.argsort(line, kind="stable")
    again = np.zeros(len(line), bool)
    again[order[1:]] = line[order[1:]] == line[order[:-1]]
    n_lines = np.bincount(line_doc, minlength=len(texts))
    n_dup = np.bincount(line_doc[again], minlength=len(texts))

    # Words inside windows that occur twice or more in the same text.
    starts = words.windows(REPEAT_WINDOW)
    spans = bytes_hash.spans(words.starts, words.ends)
    hashes = tx.mix(spans + (words.ends - words.starts).astype(np.uint64))
    window = tx.Rolling(hashes).spans(starts, starts + REPEAT_WINDOW)
    window = tx.mix(window + doc[starts].astype(np.uint64))
    order = np.argsort(window, kind="stable")
    same = window[order[1:]] == window[order[:-1]]
    twice = np.zeros(len(window), bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    repeat = tx.per_text(tx.covered(n, starts[twice], REPEAT_WINDOW), words.first)

    upper = (data >= 65) & (data <= 90)
    letter = upper | ((data >= 97) & (data <= 122))
    return [words.counts, count(in_word & first_byte), count(SYMBOLS[data]), n_dup, n_lines, repeat,
            count(upper), count(letter), count(data == 33), tx.per_text(np.isin(_word_hashes(texts)[0], typical), words.first),
            np.ones(len(texts), np.int64)]


def _teaches(id_col) -> F.Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % TEACH_EVERY == 0


def _agreed(labels: DataFrame, column: str) -> DataFrame:
    """``doc_id`` and ``column`` of the documents whose labels agree."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull()).groupBy("doc_id")
    return known.agg(F.min(column).alias(column), F.max(column).alias("__hi")).where(F.col(column) == F.col("__hi")).drop("__hi")


def typical_words(docs: DataFrame, labels: DataFrame, text_col: str = "text") -> np.ndarray:
    """Hashes of the words that occur in significantly more of the toxic than of
    the other documents among those that teach (at most ``LEARN`` of either)."""
    if "toxic" not in labels.columns:
        return np.zeros(0, np.uint64)
    known = _agreed(labels, "toxic").where(_teaches("doc_id")).withColumn("__r", F.xxhash64("doc_id"))
    sample = materialize(known.where("toxic = 1").orderBy("__r", "doc_id").limit(LEARN).unionByName(
        known.where("toxic = 0").orderBy("__r", "doc_id").limit(LEARN)).select("doc_id", "toxic"), "quality-teach")

    def words(batches):
        for batch in batches:
            toxic = batch.column(0).to_numpy(zero_copy_only=False)
            for texts in tx.chunks(batch.column(1)):
                hashes, own = _word_hashes(texts)
                pair = np.unique(np.stack([hashes, own.doc().astype(np.uint64)], 1), axis=0)
                bad = toxic[texts.first + pair[:, 1].astype(np.int64)].astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(pair[:, 0].view(np.int64)), pa.array(bad), pa.array(1 - bad)], names=["word", "bad", "fine"])

    # At most 2 * LEARN ids: the sample is broadcast, the texts stay where they are.
    taught = docs.select("doc_id", F.col(text_col).alias("__t"))
    taught = materialize(taught.join(F.broadcast(sample), "doc_id").select("toxic", "__t"), "quality-taught")
    n = {r["toxic"]: r["count"] for r in taught.groupBy("toxic").count().collect()}
    if not n.get(1) or not n.get(0):
        return np.zeros(0, np.uint64)
    counts = taught.mapInArrow(words, "word long, bad long, fine long").groupBy("word").agg(F.sum("bad").alias("a"), F.sum("fine").alias("b"))
    a, b = F.col("a"), F.col("b")
    share = (a + b) / (n[0] + n[1])
    part = lambda k, expected: F.when(k > 0, k * F.log(k / expected)).otherwise(0.0)
    ratio = 2 * (part(a, n[1] * share) + part(n[1] - a, n[1] * (1 - share)) + part(b, n[0] * share) + part(n[0] - b, n[0] * (1 - share)))
    found = counts.where(a * n[0] > 3 * b * n[1]).withColumn("g", ratio).where(F.col("g") >= TYPICAL).orderBy(F.desc("g"), "word").limit(MOST_TYPICAL)
    return np.sort(np.array([r["word"] for r in found.select("word").collect()], np.int64).view(np.uint64))


def metrics(docs: DataFrame, keep: list[str], text_col: str = "text", typical: np.ndarray | None = None) -> DataFrame:
    """``keep`` columns of every row plus the base metrics of its whole text and
    the number of its words in ``typical``."""
    typical = np.zeros(0, np.uint64) if typical is None else typical
    schema = docs.select(*keep).schema
    for name in METRICS:
        schema = schema.add(name, "long")

    def scan(batches):
        for batch in batches:
            parts = [_metrics(t, typical) for t in tx.chunks(batch.column(len(keep)))]
            if parts:
                found = [pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*parts)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], *found], names=schema.names)

    return docs.select(*keep, F.col(text_col).alias("__text")).mapInArrow(scan, schema)


def base_failed() -> F.Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def binomial_cdf(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Binomial(n, p), summed exactly in logs."""
    if k >= n:
        return 1.0
    i = np.arange(k + 1)
    steps = np.log(n - i[:-1]) - np.log(i[1:]) + math.log(p) - math.log1p(-p)
    logs = n * math.log1p(-p) + np.concatenate([[0.0], np.cumsum(steps)])
    top = logs.max()
    return float(min(1.0, math.exp(top) * np.exp(logs - top).sum()))


def calibrate(scored: DataFrame, labels: DataFrame, stratum: str, rules=PRODUCTION_RULES,
              max_false_rejection: float = MAX_FALSE_REJECTION,
              error_probability: float = ERROR_PROBABILITY) -> DataFrame:
    """``stratum, rule, cutoff, n_good, n_rejected, p_value`` for every certified
    pair of stratum and rule.  ``scored`` has ``doc_id``, the stratum, the text's
    hash ``__h`` and the metrics; every labelled document of the holdout counts,
    each id and each text once.  The aggregate has one row per
    stratum; strata that have too few good documents to certify anything at all
    are left out before the rows reach the driver, which also bounds them."""
    spark = scored.sparkSession
    good = _agreed(labels, "quality").where("quality = 1").select("doc_id")
    if "toxic" in labels.columns:
        good = good.join(_agreed(labels, "toxic").where("toxic = 0").select("doc_id"), "doc_id", "left_semi").where(~_teaches("doc_id"))
    judged = scored.where(~base_failed()).join(good, "doc_id", "left_semi")
    # One trial per document, then per text: equal texts have equal metrics.
    row = F.struct("__h", F.col(stratum).alias("__s"), *METRICS)
    judged = judged.groupBy("doc_id").agg(F.min(row).alias("__row")).select("__row.*")
    judged = judged.groupBy(F.col("__s").alias(stratum), "__h").agg(*[F.max(m).alias(m) for m in METRICS])
    counts = [F.sum(r.exceeds(F.lit(c)).cast("long")).alias(f"r{i}_{j}")
              for i, r in enumerate(rules) for j, c in enumerate(r.cutoffs)]
    # With no rejection at all, n good documents certify only if (1 - rate)^n is small enough.
    least = math.ceil(math.log(error_probability / len(rules)) / math.log1p(-max_false_rejection))
    table = judged.groupBy(F.col(stratum).alias("stratum")).agg(F.count(F.lit(1)).alias("n"), *counts)
    rows = table.where(F.col("n") >= least).collect()
    limit = error_probability / max(1, len(rows) * len(rules))
    out = []
    for row in rows:
        for i, rule in enumerate(rules):
            best = None
            for j, cutoff in enumerate(rule.cutoffs):
                k = row[f"r{i}_{j}"] or 0
                p = binomial_cdf(k, row["n"], max_false_rejection)
                if p > limit:
                    break
                best = (row["stratum"], rule.name, float(cutoff), row["n"], k, p)
            if best:
                out.append(best)
    return spark.createDataFrame(out, "stratum string, rule string, cutoff double, n_good long, n_rejected long, p_value double")


def verdict(scored: DataFrame, cutoffs: DataFrame, stratum: str, rules=PRODUCTION_RULES) -> DataFrame:
    """Add ``base_failed`` and ``kept``.  ``cutoffs`` has one row per certified
    stratum and rule; it becomes one row per stratum, which is broadcast: its
    rows were collected when they were fitted, so their number is known."""
    wide = cutoffs.groupBy(F.coalesce("stratum", F.lit("")).alias("__s"), F.col("stratum").isNull().alias("__null")).agg(
        *[F.max(F.when(F.col("rule") == r.name, F.col("cutoff"))).alias(f"__cut{i}") for i, r in enumerate(rules)])
    x = (scored.withColumn("__s", F.coalesce(F.col(stratum).cast("string"), F.lit("")))
         .withColumn("__null", F.col(stratum).isNull()).join(F.broadcast(wide), ["__s", "__null"], "left"))
    rejected = F.lit(False)
    for i, r in enumerate(rules):
        rejected = rejected | r.exceeds(F.col(f"__cut{i}"))
    return (x.withColumn("base_failed", base_failed()).withColumn("kept", ~(F.col("base_failed") | rejected))
            .drop("__s", "__null", *[f"__cut{i}" for i in range(len(rules))]))


def quality_rules(docs: DataFrame, labels: DataFrame, stratum: str = "lang", rules=PRODUCTION_RULES,
                  max_false_rejection: float = MAX_FALSE_REJECTION,
                  error_probability: float = ERROR_PROBABILITY) -> DataFrame:
    """``doc_id``, metrics, ``base_failed`` and ``kept`` of every row of ``docs``.
    The texts are read once; their metrics are written to the shared folder and
    serve both the fit and the verdict."""
    typical = typical_words(docs, labels)
    scored = materialize(_scored(docs, ["doc_id"], stratum, typical), "quality-metrics")
    cutoffs = calibrate(scored, labels, "__stratum", rules, max_false_rejection, error_probability)
    return verdict(scored, cutoffs, "__stratum", rules).drop("__stratum", "__h")


def keep_good(docs: DataFrame, labels: DataFrame, stratum: str = "lang", rules=PRODUCTION_RULES,
              max_false_rejection: float = MAX_FALSE_REJECTION,
              error_probability: float = ERROR_PROBABILITY) -> DataFrame:
    """The rows of ``docs``, all columns, that the rules keep.  The texts are
    read twice (fit, verdict) rather than copied or shuffled."""
    typical = typical_words(docs, labels)
    scored = materialize(_scored(docs, ["doc_id"], stratum, typical), "quality-metrics")
    cutoffs = calibrate(scored, labels, "__stratum", rules, max_false_rejection, error_probability)
    own = {c: f"__own{i}" for i, c in enumerate(docs.columns)}
    again = _scored(docs.select("*", *[F.col(f"`{c}`").alias(o) for c, o in own.items()]), list(own.values()), stratum, typical)
    kept = verdict(again, cutoffs, "__stratum", rules).where("kept")
    return kept.select(*[F.col(o).alias(c) for c, o in own.items()])


def _scored(docs: DataFrame, keep: list[str], stratum: str, typical: np.ndarray | None = None) -> DataFrame:
    marked = docs.withColumn("__stratum", F.col(stratum).cast("string")).withColumn("__h", F.xxhash64("text"))
    return metrics(marked, [*keep, "__stratum", "__h"], typical=typical)
