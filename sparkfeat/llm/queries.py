"""Registered queries of the operators, over whole tables, with production
parameters.  Each derives its columns from its operator's result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import alignment, archive, decontaminate, language, mixing, oracles, pitman_yor, quality, relative_lz, resampling, sharding, simhash, suffix, templates


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = templates.drop_recurring(_table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op2_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix.remove_repeats(_table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(_table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), ["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", "n_items", decontaminate.items_digest(F.col("items")).alias("items_sha256"),
                        decontaminate.contaminated().alias("contaminated"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
                        F.col("mix_target").alias("target"), (F.col("mix_size") * F.col("mix_copies")).alias("taken"),
                        F.col("mix_copies").alias("copies"))


def _law_columns(placed: DataFrame) -> DataFrame:
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "old_shard")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _law_columns(sharding.reshard(_table(spark, sf_dir, "documents")))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive every page, read the archive back and derive the columns from the
    reconstructed records."""
    pages = _table(spark, sf_dir, "pages")
    stored = archive.write_archive(pages, scratch_path(spark, "warc"))
    return archive.parse_records(archive.read_records(spark, stored))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.components(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_relative_lz(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = relative_lz.parse(_table(spark, sf_dir, "documents"))
    return parsed.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resampling.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op12_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = pitman_yor.score_corpus(_table(spark, sf_dir, "documents"))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned, _ = alignment.align(_table(spark, sf_dir, "documents"))
    return aligned.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps")


QUERIES = {f.__name__: f for f in (op1_templates, op2_suffix, op3_language, op4_decontaminate, op5_mixing, op6_sharding, op7_warc, op8_quality, op9_simhash, op10_relative_lz,
                                op11_resampling, op12_pitman_yor, op13_alignment)}
ORACLES: dict[str, str] = dict(oracles.ORACLES)
