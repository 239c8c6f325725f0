"""Evaluation tables as DataFrames (#17, #29-#34).

Everything starts from the confusion counts ``groupBy(label, prediction)``:
partial aggregation leaves at most K*K rows per task, so the shuffle is tiny
however many predictions there are, and every metric is one pass over the
predictions instead of three count jobs per class.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.rules import decode_label
from .lookup import join_lookup


def class_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows per class (#29)."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))


def confusion_long(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``label, prediction, count`` (#32)."""
    return pred.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("count"))


def confusion_wide(pred: DataFrame, labels: list[str], label: str = "label",
                   prediction: str = "prediction") -> DataFrame:
    """Rows = true class name, one bigint column per predicted class name
    (every known class and 'N/A', 0 when never predicted) (#33).  Unknown codes
    decode to 'N/A', so a row's columns add up to its class's rows."""
    named = confusion_long(pred, label, prediction).select(
        decode_label(F.col(label), labels).alias("label"),
        decode_label(F.col(prediction), labels).alias("__pred"), "count")
    names = list(dict.fromkeys([*labels, K.MISSING_LABEL_NAME]))
    wide = named.groupBy("label").pivot("__pred", names).agg(F.sum("count"))
    return wide.select("label", *[F.coalesce(F.col(f"`{n}`"), F.lit(0)).cast("bigint").alias(n)
                                  for n in names])


def _class_counts(pred: DataFrame, label: str, prediction: str) -> DataFrame:
    """tp, fp, fn per class code, from the K*K confusion counts."""
    cm = confusion_long(pred, label, prediction)
    hit = F.col(label) == F.col(prediction)
    n = F.col("count")
    zero = F.lit(0).cast("bigint")
    contrib = cm.select(F.explode(F.array(
        F.struct(F.col(label).alias("code"), F.when(hit, n).otherwise(zero).alias("tp"),
                 zero.alias("fp"), F.when(hit, zero).otherwise(n).alias("fn")),
        F.struct(F.col(prediction).alias("code"), zero.alias("tp"),
                 F.when(hit, zero).otherwise(n).alias("fp"), zero.alias("fn")))).alias("c"))
    return contrib.groupBy(F.col("c.code").alias("code")).agg(
        F.sum("c.tp").alias("tp"), F.sum("c.fp").alias("fp"), F.sum("c.fn").alias("fn"))


def _prf(tp, fp, fn):
    precision = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(0.0))
    recall = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(F.lit(0.0))
    f1 = F.when(precision + recall > 0,
                2 * precision * recall / (precision + recall)).otherwise(F.lit(0.0))
    return precision, recall, f1


def per_class_metrics(pred: DataFrame, labels: list[str], label: str = "label",
                      prediction: str = "prediction") -> DataFrame:
    """``class, precision, recall, f1`` for every known class, 0 where the
    denominator is 0, also for classes absent from ``pred`` (#31)."""
    spark = pred.sparkSession
    known = spark.createDataFrame([(float(i), name) for i, name in enumerate(labels)],
                                  "code double, class string")
    # Only codes of the fitted label list, so at most one row per label is broadcast.
    counts = _class_counts(pred, label, prediction).where(F.col("code").isin([float(i) for i in range(len(labels))]))
    j = join_lookup(known, counts, ["code"], ["tp", "fp", "fn"], lookup_rows=len(labels))
    tp, fp, fn = (F.coalesce(F.col(c), F.lit(0)).cast("double") for c in ("tp", "fp", "fn"))
    p, r, f = _prf(tp, fp, fn)
    return j.select("class", p.alias("precision"), r.alias("recall"), f.alias("f1"))


def accuracy_f1(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: ``accuracy`` and support-weighted ``f1_weighted``, the values
    of ``MulticlassClassificationEvaluator`` for ``accuracy`` and ``f1`` (#34)."""
    counts = _class_counts(pred, label, prediction)
    tp, fp, fn = (F.col(c).cast("double") for c in ("tp", "fp", "fn"))
    _, _, f1 = _prf(tp, fp, fn)
    support = tp + fn
    return counts.agg(
        (F.sum(tp) / F.sum(support)).alias("accuracy"),
        (F.sum(f1 * support) / F.sum(support)).alias("f1_weighted"))
