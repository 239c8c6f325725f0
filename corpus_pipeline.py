"""A corpus from raw documents to mixed shards, stage by stage.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that its
predecessor kept; its result is written as Parquet and read again as the next
stage's ``docs``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparkfeat.llm import decontaminate, mixing, quality, sharding, simhash
from sparkfeat.llm.queries import _law_columns
from sparkfeat.session import materialize, ready

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the certified thresholds reject go."""
    ready(spark)
    return quality.keep_good(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays (4-word shingles, 4 bits)."""
    ready(spark)
    return simhash.keep_one(docs.select(*COLUMNS), shingle=4, max_bits=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    ready(spark)
    return decontaminate.keep_clean(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its copies say."""
    ready(spark)
    return mixing.repeat_rows(mixing.mix(docs.select(*COLUMNS)), COLUMNS)


def resharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row, copies included, in shards of nearly equal bytes."""
    ready(spark)
    return _law_columns(sharding.reshard(docs.select(*COLUMNS)))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_rules),
    ("simhash", simhash_near_dedup),
    ("decontaminate", decontamination),
    ("mixing", mixing_to_targets),
    ("sharding", resharding),
]

#: SimHash fingerprints, fitted thresholds and Newton steps have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the
    shared folder and read again."""
    ready(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
