"""Frequency encoding (#28) and grid-cell density (#27).

Both attach "rows sharing my value" to every row.  A window
``count(*) OVER (PARTITION BY key)`` would put every row of a hot key into one
task; instead the counts are aggregated (partial aggregation first) and joined
back with the size-checked lookup join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lookup import MAX_BROADCAST_BYTES, MAX_BROADCAST_ROWS, ROW_OVERHEAD_BYTES, join_lookup
from .profile import Profile, profile


def attach_counts(df: DataFrame, prof: Profile, outputs: dict[str, str],
                  max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Join the per-value counts of a :class:`Profile` onto ``df``.  All lookups
    share one byte budget for what they broadcast."""
    budget = MAX_BROADCAST_BYTES
    for c, out in outputs.items():
        lk = prof.counts[c].withColumnRenamed("n", out)
        size = prof.count_rows[c] * (prof.key_bytes.get(c, 0) + ROW_OVERHEAD_BYTES)
        df = join_lookup(df, lk, [c], [out], lookup_rows=prof.count_rows[c],
                         row_counts=out, total_rows=prof.total_rows,
                         key_bytes=prof.key_bytes.get(c, 0),
                         max_broadcast_rows=max_broadcast_rows, max_broadcast_bytes=budget)
        if prof.count_rows[c] <= max_broadcast_rows and size <= budget:
            budget -= size
    return df


def frequency_encode(df: DataFrame, outputs: dict[str, str],
                     max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``outputs`` maps column -> new column holding the number of rows with the
    same value (null values get null, as pandas ``map(value_counts())``)."""
    return attach_counts(df, profile(df, list(outputs)), outputs, max_broadcast_rows)


def cell_density(df: DataFrame, keys: list[str], out: str, max_cells: int,
                 source: DataFrame | None = None) -> DataFrame:
    """Rows per combination of ``keys`` attached to each row; rows whose cell
    has a null key get 0.  ``max_cells`` is a proven bound on the number of
    distinct cells (for two 20-bin ids: 21 * 21 with the null bin); it lets the
    small count table be broadcast without a separate counting job.  ``source``
    (default ``df``) is the table whose rows are counted; pass an upstream
    form of ``df`` so the count sub-job skips later joins."""
    cells = (df if source is None else source).groupBy(*keys).agg(F.count(F.lit(1)).alias(out))
    joined = join_lookup(df, cells, keys, [out], lookup_rows=max_cells)
    return joined.withColumn(out, F.coalesce(F.col(out), F.lit(0).cast("bigint")))
