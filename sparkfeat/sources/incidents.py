"""Incident table scan (#1, #5) and dataset shape (#4)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K


def not_null(columns: list[str]) -> Column:
    """Conjunction of ``IS NOT NULL`` tests (NaN is kept, as SQL does)."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def coerce_numeric(df: DataFrame, types: dict | None = None) -> DataFrame:
    """Numeric incident columns that arrive as text (CSV without a schema) are
    cast by name (``try_cast``: bad text -> null); typed columns are left as
    they are.  Dates stay text for the lenient date parse."""
    types = K.RAW_NUMERIC_TYPES if types is None else types
    fix = {c: F.col(c).try_cast(t) for c, t in types.items()
           if c in df.columns and isinstance(df.schema[c].dataType, T.StringType)}
    return df.withColumns(fix) if fix else df


def scan_incidents(df: DataFrame, columns: list[str] | None = None,
                   required: list[str] | None = None) -> DataFrame:
    """Project the declared incident columns that exist and keep rows whose
    required columns are all present.  On a file source Catalyst pushes the
    predicates into the reader (``PushedFilters: IsNotNull``) and prunes the
    projection (``ReadSchema``)."""
    columns = K.RAW_COLUMNS if columns is None else columns
    required = K.NOT_NULL_COLUMNS if required is None else required
    present = [c for c in columns if c in df.columns]
    df = coerce_numeric(df.select(*present))
    return df.where(not_null([c for c in required if c in present]))


def read_incidents(spark: SparkSession, path: str, fmt: str = "parquet",
                   options: dict | None = None, schema=None,
                   columns: list[str] | None = None,
                   required: list[str] | None = None) -> DataFrame:
    """Read an incident table from any Spark source and apply :func:`scan_incidents`."""
    reader = spark.read.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return scan_incidents(reader.load(path), columns, required)


def dataset_shape(df: DataFrame) -> DataFrame:
    """One row: ``n_rows`` (bigint) and ``n_columns`` (int)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(df.columns)).cast("int").alias("n_columns"))
