"""Feature-engineering job (#54): raw incidents -> 35-column feature table.

Plan at scale (no shuffle of the large table):
  1. one GROUPING SETS job: per-value counts of STATE / COUNTY / cause /
     agency plus min/max of latitude and longitude; materialised (small);
  2. the grid-cell counts over the fitted bins (at most 21 x 21 rows by
     construction), materialised;
  3. the output query: scan -> codegen'd expressions -> broadcast joins of the
     four count tables (size checked) and of the cell counts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import dateformat as DF
from ..functions import rules as R
from ..functions import temporal as TM
from ..operators.binning import apply_bins, equal_width_edges
from ..operators.clean import drop_null_target, fill_constant, select_available
from ..operators.frequency import attach_counts
from ..operators.lookup import MAX_BROADCAST_ROWS, join_lookup
from ..operators.profile import Profile, counts_from_table, profile
from ..session import materialize
from ..sources.incidents import scan_incidents

BIN_OUTPUTS = {"LATITUDE": "lat_bin", "LONGITUDE": "lon_bin"}
# Proven bound on grid cells: 20 bins per axis plus the null bin.
MAX_CELLS = (K.N_BINS + 1) ** 2


#: Formats of text dates: one, several tried in order, or by column as
#: :func:`~sparkfeat.functions.dateformat.infer_formats` finds them.
DateFormat = str | list[str] | dict[str, list[str]] | None
DATE_COLUMNS = ["DISCOVERY_DATE", "CONT_DATE"]
INFER = "infer"


def resolve_date_format(raw: DataFrame, date_format: DateFormat, order: str = K.ID_COLUMN) -> DateFormat:
    """``'infer'`` becomes the formats that the first date of each column shows,
    among the rows of the not-null scan; anything else stays."""
    if date_format != INFER and date_format != [INFER]:
        return date_format
    return DF.infer_formats(scan_incidents(raw), DATE_COLUMNS, order)


def _date_column(df: DataFrame, column: str, date_format: DateFormat, date_unit: str | None):
    dtype = df.schema[column].dataType
    if isinstance(date_format, dict):
        if column in date_format:
            return DF.formatted_timestamp(F.col(column), date_format[column])
        date_format = None
    return TM.lenient_timestamp(F.col(column), dtype, date_format, date_unit)


def temporal_features(df: DataFrame, date_format: DateFormat = None,
                      date_unit: str | None = None) -> DataFrame:
    """Month, weekday, season, duration, decade, flags and hour (#18-#25).
    ``date_format`` parses text dates, ``date_unit`` numeric ones ('julian', ...)."""
    date_format = resolve_date_format(df, date_format)
    df = df.withColumns({c: _date_column(df, c, date_format, date_unit) for c in DATE_COLUMNS})
    month = F.col("discovery_month")
    df = df.withColumns({
        "discovery_month": TM.month_of(F.col("DISCOVERY_DATE")),
        "discovery_year": F.col("FIRE_YEAR"),
        "discovery_day_of_week": TM.day_of_week(F.col("DISCOVERY_DATE")),
        "discovery_day_of_year": F.col("DISCOVERY_DOY"),
        "fire_duration_days": F.coalesce(
            TM.duration_days(F.col("DISCOVERY_DATE"), F.col("CONT_DATE")), F.lit(0).cast("bigint")),
        "decade": TM.decade_of(F.col("FIRE_YEAR")),
        "DISCOVERY_TIME": TM.lenient_number(F.col("DISCOVERY_TIME"), df.schema["DISCOVERY_TIME"].dataType,
                                            K.DEFAULT_DISCOVERY_TIME),
    })
    return df.withColumns({
        "season": R.lookup(month, K.SEASON_BY_MONTH),
        "fire_season": R.range_flag(month, *K.FIRE_SEASON_MONTHS),
        "is_weekend": R.threshold_flag(F.col("discovery_day_of_week"), K.WEEKEND_FIRST_DAY),
        "discovery_hour": TM.hour_of_hhmm(F.col("DISCOVERY_TIME")),
    })


def spatial_features(df: DataFrame, edges: dict) -> DataFrame:
    """Bins (with fitted edges) and region rules (#12, #26)."""
    df = apply_bins(df, edges, BIN_OUTPUTS)
    return df.withColumn("geographic_region", R.region_of(F.col("LATITUDE"), F.col("LONGITUDE")))


def categorical_fill(df: DataFrame) -> DataFrame:
    return fill_constant(df, {c: K.UNKNOWN for c in K.FILL_UNKNOWN_COLUMNS})


def cause_and_risk_flags(df: DataFrame) -> DataFrame:
    month = F.col("discovery_month")
    return df.withColumns({
        "human_caused": R.membership_flag(F.col("STAT_CAUSE_DESCR"), K.HUMAN_CAUSES),
        "high_risk_month": R.membership_flag(month, K.HIGH_RISK_MONTHS),
        "drought_season": R.membership_flag(month, K.DROUGHT_MONTHS),
    })


@dataclass
class FeatureStats:
    """Whole-table statistics of the feature job, fitted once and applied to
    any table with the incident columns (the same table, a test part, or a
    stream of new files).  Lookup tables live in the shared checkpoint folder."""
    edges: dict
    profile: Profile
    cells: DataFrame
    cell_rows: int

    @property
    def frequencies(self) -> dict:
        return {c: o for c, o in K.FREQUENCY_COLUMNS.items() if c in self.profile.counts}


def _prepared(raw: DataFrame, date_format: DateFormat, date_unit: str | None = None) -> DataFrame:
    base = scan_incidents(raw)
    pre = temporal_features(base, date_format, date_unit).withColumn(
        "geographic_region", R.region_of(F.col("LATITUDE"), F.col("LONGITUDE")))
    return categorical_fill(pre)


def fit_feature_stats(raw: DataFrame, date_format: DateFormat = None,
                      date_unit: str | None = None) -> FeatureStats:
    """Two passes over ``raw``: one GROUPING SETS aggregate (value counts and
    coordinate ranges), then the grid-cell counts over the fitted bins (at most
    21 x 21 rows).  Both results are small and materialised."""
    pre = _prepared(raw, date_format, date_unit)
    freq = {c: o for c, o in K.FREQUENCY_COLUMNS.items() if c in pre.columns}
    prof = profile(pre, list(freq), list(BIN_OUTPUTS))
    edges = {c: equal_width_edges(*prof.minmax[c], K.N_BINS) for c in BIN_OUTPUTS}
    bins = list(BIN_OUTPUTS.values())
    cells = materialize(apply_bins(pre.select(*BIN_OUTPUTS), edges, BIN_OUTPUTS)
                        .groupBy(*bins).agg(F.count(F.lit(1)).alias("location_fire_density")), "cells")
    return FeatureStats(edges, prof, cells, MAX_CELLS)


def apply_feature_stats(raw: DataFrame, stats: FeatureStats, date_format: DateFormat = None,
                        max_broadcast_rows: int = MAX_BROADCAST_ROWS,
                        date_unit: str | None = None) -> DataFrame:
    """Feature table of ``raw`` with fitted statistics: a single map-side pass
    of codegen'd expressions and broadcast lookups; works on batch and
    streaming DataFrames alike.  Values never seen in the fitted table get a
    null frequency and density 0."""
    binned = apply_bins(_prepared(raw, date_format, date_unit), stats.edges, BIN_OUTPUTS)
    df = cause_and_risk_flags(attach_counts(binned, stats.profile, stats.frequencies, max_broadcast_rows))
    df = join_lookup(df, stats.cells, list(BIN_OUTPUTS.values()), ["location_fire_density"],
                     lookup_rows=stats.cell_rows)
    df = df.withColumn("location_fire_density",
                       F.coalesce(F.col("location_fire_density"), F.lit(0).cast("bigint")))
    return drop_null_target(select_available(df))


def save_feature_stats(stats: FeatureStats, path: str) -> str:
    """Write fitted statistics under ``path`` (shared storage): the profile
    table and the cell counts as parquet, edges and counts as one JSON line.
    A restarted streaming job reloads them with :func:`load_feature_stats`."""
    import json

    p = stats.profile
    spark = stats.cells.sparkSession
    p.table.write.mode("overwrite").parquet(f"{path}/profile")
    stats.cells.write.mode("overwrite").parquet(f"{path}/cells")
    meta = {"edges": stats.edges, "total_rows": p.total_rows, "minmax": p.minmax,
            "count_rows": p.count_rows, "key_bytes": p.key_bytes, "gids": p.gids,
            "cell_rows": stats.cell_rows}
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1) \
        .write.mode("overwrite").text(f"{path}/meta")
    return path


def load_feature_stats(spark, path: str) -> FeatureStats:
    import json

    meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
    table = spark.read.parquet(f"{path}/profile")
    prof = Profile(total_rows=meta["total_rows"], minmax={k: tuple(v) for k, v in meta["minmax"].items()},
                   count_rows=meta["count_rows"], key_bytes=meta["key_bytes"], table=table,
                   gids=meta["gids"])
    prof.counts = counts_from_table(table, prof.gids)
    return FeatureStats(meta["edges"], prof, spark.read.parquet(f"{path}/cells"), meta["cell_rows"])


def engineer_features(raw: DataFrame, date_format: DateFormat = None,
                      max_broadcast_rows: int = MAX_BROADCAST_ROWS,
                      date_unit: str | None = None) -> DataFrame:
    """Raw incident rows -> feature table in declared column order, every
    whole-table statistic computed over ``raw`` itself (as the source job).
    Numeric date columns (e.g. Julian day numbers) need ``date_unit``; text ones
    take ``date_format``, where ``'infer'`` finds the format in the data."""
    date_format = resolve_date_format(raw, date_format)
    stats = fit_feature_stats(raw, date_format, date_unit)
    return apply_feature_stats(raw, stats, date_format, max_broadcast_rows, date_unit)


def features_fit_on_train(raw: DataFrame, key: str = K.ID_COLUMN, fraction: float = K.TRAIN_FRACTION,
                          date_format: DateFormat = None, date_unit: str | None = None) -> DataFrame:
    """Feature table whose whole-table statistics (bins, value counts, cell
    counts) come from the training part only (key-hash split, the same one the
    experiments use), applied to every row: no test row shapes a feature."""
    from ..operators.split import train_flag

    date_format = resolve_date_format(raw, date_format)
    stats = fit_feature_stats(raw.where(train_flag(raw, key, fraction)), date_format, date_unit)
    return apply_feature_stats(raw, stats, date_format, date_unit=date_unit)
