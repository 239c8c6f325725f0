"""Row filters, projections and null fills (#5-#9)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..sources.incidents import not_null


def filter_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keep rows where every listed column is not null (#5)."""
    return df.where(not_null(columns))


def drop_null_target(df: DataFrame, target: str = K.TARGET) -> DataFrame:
    """Drop rows whose target is null (#6)."""
    return df.where(F.col(target).isNotNull())


def select_available(df: DataFrame, declared: list[str] | None = None) -> DataFrame:
    """Project the declared columns that exist, in declared order (#7)."""
    declared = K.FINAL_FEATURES if declared is None else declared
    return df.select(*[c for c in declared if c in df.columns])


def available_features(df: DataFrame, cats: list[str] | None = None,
                       nums: list[str] | None = None) -> tuple[list[str], list[str]]:
    """Categorical and numeric model inputs present in ``df`` (#8)."""
    cats = K.CATEGORICAL_FEATURES if cats is None else cats
    nums = K.NUMERIC_FEATURES if nums is None else nums
    return [c for c in cats if c in df.columns], [c for c in nums if c in df.columns]


def fill_constant(df: DataFrame, values: dict) -> DataFrame:
    """Replace null (and NaN in float columns) with a constant per column (#9).
    Columns that are absent are skipped, as the source job does."""
    out = {}
    for c, v in values.items():
        if c not in df.columns:
            continue
        col = F.col(c)
        if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
            col = F.when(F.isnan(col), F.lit(None)).otherwise(col)
        out[c] = F.coalesce(col, F.lit(v))
    return df.withColumns(out) if out else df


def numeric_as_double(df: DataFrame, nums: list[str]) -> DataFrame:
    """Cast numeric model inputs to double; text that is not a number becomes
    null (``try_cast``), so e.g. ``FIPS_CODE`` text '063' becomes 63.0.  The
    mean imputer truncates means on integer columns, hence double."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in nums})


def non_empty_columns(df: DataFrame, cols: list[str]) -> list[str]:
    """Columns with at least one value that is neither null nor NaN (one
    aggregate, reading only ``cols``).  The mean imputer cannot fill a column
    without any value, so such columns are left out of the model input."""
    if not cols:
        return []
    def present(c):
        v = F.col(c)
        if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
            v = F.when(~F.isnan(v), v)
        return F.count(v).alias(c)
    row = df.agg(*[present(c) for c in cols]).collect()[0]
    return [c for c in cols if row[c] > 0]
