"""Language identification with string kernels.

Blended-spectrum presence kernel: two texts are as alike as the number of
byte n-grams (1 to ``MAX_GRAM``) that occur in both, over the root of the
product of their numbers.  A bounded sample of labelled texts is the training
set and, of those, a few per language are Nystroem landmarks; one-versus-rest
kernel ridge regression is fitted in the landmarks' feature space.  Only
n-grams of landmarks can be shared with a landmark, so a text's presence
vector covers exactly those, and texts are scored by batched matrix products:
presence vectors times the landmarks', times the regression weights.

The number of sampled rows is a parameter (``per_language``): a hash of the id
and text chooses them, about as many of each language, or all of a rarer one,
up to ``SAMPLE_BYTES`` bytes together.  The ``MAX_LANGUAGES`` most frequent tags
are learned (equal counts by tag); rows of the others are scored like all.
Every text is scored whole.

Defined cases: a null text and one without any letter give ``und`` with score
0; so does every text if nothing can be learned; tags beyond the learned ones
are never predicted; null ids are never learned
from and are not held out; repeated rows get equal results; an empty table
gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from . import text as tx

MAX_GRAM = 3
PER_LANGUAGE = 400
LANDMARKS = 32
RIDGE = 1e-3
MAX_LANGUAGES = 200
#: Bytes of the sample, shared alike by the languages.
SAMPLE_BYTES = 128 << 20
#: Cells of a presence matrix; a run of texts has as many rows as fit.
CELLS = 1 << 24
UNKNOWN = "und"

#: ASCII other than letters reads as a space.
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[:0x80] = 0x20
_PLAIN[0x61:0x7B] = np.arange(0x61, 0x7B)


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _grams(data: np.ndarray, n: int) -> np.ndarray:
    """Code of the n-gram at every byte that has ``n - 1`` followers."""
    code = data[:max(0, len(data) - n + 1)].astype(np.int32)
    for i in range(1, n):
        code = (code << 8) | data[i:len(data) - n + 1 + i]
    return code


class Model:
    """Landmarks and weights; ``scores`` of whole texts."""

    def __init__(self, languages: list[str], vocabulary: list[np.ndarray]):
        self.languages, self.vocabulary = languages, vocabulary
        self.size = sum(map(len, vocabulary))
        self.landmarks: np.ndarray | None = None   # presence, columns scaled by the landmark's norm
        self.weights: np.ndarray | None = None     # (landmarks, languages)
        self._tables = None

    def __getstate__(self):
        return {**self.__dict__, "_tables": None}

    def tables(self) -> list[np.ndarray]:
        """Column of each n-gram code (``size`` where it is no landmark's)."""
        if self._tables is None:
            self._tables, at = [], 0
            for n, codes in enumerate(self.vocabulary, 1):
                table = np.full(1 << (8 * n), self.size, np.int32)
                table[codes] = np.arange(at, at + len(codes))
                self._tables.append(table)
                at += len(codes)
        return self._tables

    def presence(self, texts: tx.Texts) -> np.ndarray:
        """(texts, vocabulary) 0/1 matrix."""
        data = _PLAIN[texts.data]
        flags = np.zeros((len(texts), self.size + 1), np.uint8)
        row = np.repeat(np.arange(len(texts), dtype=np.int64) * (self.size + 1), np.diff(texts.offsets))
        left = np.repeat(texts.offsets[1:], np.diff(texts.offsets)) - np.arange(len(data))  # bytes to the text's end
        for n, table in enumerate(self.tables(), 1):
            column = table[_grams(data, n)]
            inside = left[:len(column)] >= n
            flags.ravel()[(row[:len(column)] + column)[inside]] = 1
        return flags[:, :self.size]

    def kernel(self, texts: tx.Texts) -> np.ndarray:
        x = self.presence(texts).astype(np.float32)
        norm = np.sqrt(np.maximum(x.sum(axis=1), 1.0))
        return (x @ self.landmarks.T) / norm[:, None]

    def scores(self, texts: tx.Texts) -> np.ndarray:
        rows = max(1, CELLS // (self.size + 1))
        return np.concatenate([self.kernel(texts.part(at, at + rows)) @ self.weights for at in range(0, len(texts), rows)])


def _as_texts(strings: list[str]) -> tx.Texts:
    return next(tx.chunks(pa.array(strings, pa.string()), 1 << 62))


def fit(languages: list[str], rows: list[tuple[str, str]], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Model from (lower-cased text, language) rows; the first ``landmarks`` rows
    of each language are landmarks."""
    index = {name: i for i, name in enumerate(languages)}
    seen = np.zeros(len(languages), int)
    chosen = []
    for i, (_, name) in enumerate(rows):
        if seen[index[name]] < landmarks:
            chosen.append(i)
        seen[index[name]] += 1
    marks = _as_texts([rows[i][0] for i in chosen])
    data = _PLAIN[marks.data]
    left = np.repeat(marks.offsets[1:], np.diff(marks.offsets)) - np.arange(len(data))
    vocabulary = []
    for n in range(1, MAX_GRAM + 1):
        codes = _grams(data, n)
        vocabulary.append(np.unique(codes[left[:len(codes)] >= n]))
    model = Model(languages, vocabulary)
    z = model.presence(marks).astype(np.float32)
    model.landmarks = z / np.sqrt(np.maximum(z.sum(axis=1), 1.0))[:, None]

    train = [(t, index[name]) for t, name in rows]
    kernel = np.concatenate([model.kernel(part) for part in tx.chunks(pa.array([t for t, _ in train], pa.string()))]).astype(np.float64)
    among = (model.landmarks @ model.landmarks.T).astype(np.float64)
    value, vector = np.linalg.eigh(among)
    good = value > 1e-6 * value.max()
    root = vector[:, good] / np.sqrt(value[good])          # K_mm^(-1/2)
    features = kernel @ root
    label = np.array([c for _, c in train])
    count = np.bincount(label, minlength=len(languages))
    weight = 1.0 / count[label]                            # every language weighs the same
    goal = np.where(label[:, None] == np.arange(len(languages))[None, :], 1.0, -1.0)
    gram = features.T @ (features * weight[:, None]) + ridge * np.eye(features.shape[1])
    model.weights = (root @ np.linalg.solve(gram, features.T @ (goal * weight[:, None]))).astype(np.float32)
    return model


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_language: int = PER_LANGUAGE, landmarks: int = LANDMARKS, max_languages: int = MAX_LANGUAGES,
          sample_bytes: int = SAMPLE_BYTES) -> Model | None:
    """Fit on a sample of the labelled rows that are not held out.  At most about
    ``per_language`` rows of each learned language and ``sample_bytes`` bytes of
    text reach the driver."""
    usable = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"), F.col(lang_col).cast("string").alias("l")).where(
        F.col("id").isNotNull() & F.col("t").isNotNull() & F.col("l").isNotNull() & ~held_out("id"))
    counts = usable.groupBy("l").agg(F.count(F.lit(1)).alias("n"))
    counts = sorted(counts.orderBy(F.desc("n"), "l").limit(max_languages).collect(), key=lambda r: r["l"])
    if not counts:
        return None
    # One flat CASE, so that hundreds of tags do not nest.
    share, sizes = F.when(F.lit(False), 0.0), F.octet_length("t")
    for r in counts:
        share = share.when(F.col("l") == r["l"], min(1.0, per_language / r["n"]))
    share = share.otherwise(0.0)
    bits = 1 << 30
    rank = F.pmod(F.xxhash64("id", "t"), F.lit(bits))
    chosen = materialize(usable.withColumn("r", rank).where(F.col("r") < share * bits).select("r", "id", F.lower("t").alias("t"), "l"), "language-sample")
    # Of each language the first rows (by rank) within its share of the bytes; a row beyond all by itself goes too.
    order = Window.partitionBy("l").orderBy("r", "id", "t")
    within = chosen.withColumn("b", F.sum(sizes).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    sample = within.where(F.col("b") <= sample_bytes // len(counts)).select("r", "id", "t", "l").collect()
    rows = [(r["t"], r["l"]) for r in sorted(sample, key=lambda r: (r["r"], r["id"], r["t"]))]
    learned = {name for _, name in rows}
    return fit([r["l"] for r in counts if r["l"] in learned], rows, landmarks) if rows else None


def predict(docs: DataFrame, model: Model | None, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns of every row plus ``lang_pred`` and ``score`` (0 to 1)."""
    letters = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    schema = docs.select(*keep).schema.add("lang_pred", "string").add("score", "double")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # landmarks and weights: bounded by the sample
    n = len(keep)

    def scan(batches):
        model = shared.value
        for batch in batches:
            has_letter = batch.column(n + 1).to_numpy(zero_copy_only=False)
            best, top = np.zeros(len(has_letter), np.int64), np.zeros(len(has_letter))
            if model is not None:
                for texts in tx.chunks(batch.column(n)):
                    score = model.scores(texts)
                    own = slice(texts.first, texts.first + len(texts))
                    best[own] = score.argmax(axis=1)
                    top[own] = np.clip((score.max(axis=1) + 1) / 2, 0, 1)
            names = np.array([*(model.languages if model else []), UNKNOWN], object)
            best[~has_letter | (model is None)] = len(names) - 1
            top[~has_letter | (model is None)] = 0.0
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(names[best], pa.string()), pa.array(top)],
                                             names=schema.names)

    return docs.select(*keep, F.lower(text_col).alias("__text"), letters.alias("__letters")).mapInArrow(scan, schema)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             per_language: int = PER_LANGUAGE, landmarks: int = LANDMARKS) -> DataFrame:
    """``id_col, held_out, lang_pred, score`` of every row."""
    model = learn(docs, id_col, text_col, lang_col, per_language, landmarks)
    slim = docs.select(F.col(id_col), F.col(text_col), held_out(id_col).alias("held_out"))
    return predict(slim, model, [id_col, "held_out"], text_col)
