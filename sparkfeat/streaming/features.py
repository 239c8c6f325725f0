"""The feature job on newly arriving incident files (Structured Streaming).

Whole-table statistics (bin edges, value counts, grid-cell counts) are fitted
once on a reference table with :func:`fit_feature_stats`; the stream then
applies them per micro-batch.  The per-row work is stateless: codegen'd
expressions plus stream-static broadcast joins against the small, materialised
lookup tables, so no state store grows with the stream.  Progress lives in the
checkpoint location (shared storage), so a restarted query resumes where it
stopped and the file sink commits each batch exactly once.  The fitted
statistics are kept on shared storage as well (``save_feature_stats`` /
``load_feature_stats``), so a restarted driver applies the same ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..plans.features import DateFormat, FeatureStats, apply_feature_stats
from ..session import scratch_path


def read_incident_stream(spark: SparkSession, source_dir: str, schema: StructType,
                         fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame over files landing in ``source_dir``."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(source_dir)


def stream_features(spark: SparkSession, source_dir: str, schema: StructType, stats: FeatureStats,
                    sink_dir: str, checkpoint_location: str | None = None, fmt: str = "parquet",
                    available_now: bool = True, date_format: DateFormat = None,
                    date_unit: str | None = None, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the streaming feature job writing parquet to ``sink_dir``.

    ``available_now`` processes every file present and stops (incremental
    batch); otherwise the query keeps running with the default trigger.
    ``max_files_per_trigger`` splits a backlog into batches."""
    stream = read_incident_stream(spark, source_dir, schema, fmt, max_files_per_trigger)
    out = apply_feature_stats(stream, stats, date_format, date_unit=date_unit)
    writer = (out.writeStream.format("parquet")
              .option("path", sink_dir)
              .option("checkpointLocation", checkpoint_location or scratch_path(spark, "stream-ckpt"))
              .outputMode("append"))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
