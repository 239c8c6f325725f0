"""One scan that yields every whole-table statistic the feature job needs.

Per-value row counts for several columns and the min / max of others come out
of a single ``GROUPING SETS`` aggregate: each row is expanded once per set,
partial aggregation collapses hot values map-side, and only one small table
is shuffled.  The result is materialised in the shared checkpoint folder so
its size can be checked before anything is broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize


@dataclass
class Profile:
    total_rows: int
    minmax: dict[str, tuple] = field(default_factory=dict)
    counts: dict[str, DataFrame] = field(default_factory=dict)   # col -> (col, n)
    count_rows: dict[str, int] = field(default_factory=dict)     # distinct keys per col
    key_bytes: dict[str, int] = field(default_factory=dict)      # longest key (as text) per col
    table: DataFrame | None = None                               # materialised GROUPING SETS result
    gids: dict[str, int] = field(default_factory=dict)           # grouping id of each column's set


def counts_from_table(table: DataFrame, gids: dict[str, int]) -> dict[str, DataFrame]:
    """Per-column ``(col, n)`` lookups from the materialised profile table."""
    return {c: table.where(F.col("__gid") == g).select(c, F.col("__n").alias("n")) for c, g in gids.items()}


def _finite(df: DataFrame, c: str):
    """pandas min/max skip NaN; Spark orders NaN above every number."""
    if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(F.col(c)), F.col(c))
    return F.col(c)


def profile(df: DataFrame, count_cols: list[str] = (), minmax_cols: list[str] = ()) -> Profile:
    count_cols, minmax_cols = list(count_cols), list(minmax_cols)
    mm = []
    for c in minmax_cols:
        mm += [F.min(_finite(df, c)).alias(f"__min_{c}"), F.max(_finite(df, c)).alias(f"__max_{c}")]
    if not count_cols:
        row = df.agg(F.count(F.lit(1)).alias("__n"), *mm).collect()[0]
        return Profile(total_rows=row["__n"],
                       minmax={c: (row[f"__min_{c}"], row[f"__max_{c}"]) for c in minmax_cols})

    n = len(count_cols)
    sets = [[c] for c in count_cols] + [[]]
    agg = (df.groupingSets(sets, *count_cols)
             .agg(F.count(F.lit(1)).alias("__n"), F.grouping_id().alias("__gid"), *mm))
    table = materialize(agg, "profile")

    all_bits = (1 << n) - 1
    gid = {c: all_bits - (1 << (n - 1 - i)) for i, c in enumerate(count_cols)}
    widest = F.greatest(*[F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in count_cols]) \
        if len(count_cols) > 1 else F.coalesce(F.octet_length(F.col(count_cols[0]).cast("string")), F.lit(0))
    summary = {r["__gid"]: r for r in table.groupBy("__gid").agg(
        F.count(F.lit(1)).alias("keys"), F.max(widest).alias("key_bytes"),
        *[F.min(f"__min_{c}").alias(f"__min_{c}") for c in minmax_cols],
        *[F.max(f"__max_{c}").alias(f"__max_{c}") for c in minmax_cols],
        F.sum("__n").alias("rows")).collect()}
    whole = summary.get(all_bits)  # absent when the input has no rows
    prof = Profile(total_rows=whole["rows"] if whole else 0,
                   minmax={c: (whole[f"__min_{c}"], whole[f"__max_{c}"]) if whole else (None, None)
                           for c in minmax_cols},
                   table=table, gids=gid)
    prof.counts = counts_from_table(table, gid)
    for c in count_cols:
        prof.count_rows[c] = summary[gid[c]]["keys"] if gid[c] in summary else 0
        prof.key_bytes[c] = (summary[gid[c]]["key_bytes"] or 0) if gid[c] in summary else 0
    return prof
