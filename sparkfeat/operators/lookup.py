"""Attach a one-row-per-key lookup table to a large table (left equi join).

Broadcast is used only when the lookup's size is known to be bounded, in rows
and in estimated bytes: either a bound proven by construction (bin grids,
fitted label lists) or a count measured on the lookup.  Beyond the bound the
join is a shuffle join that stays safe under skew: keys that hold many rows of
the large table ("hot", counted on that table) are few by construction and are
broadcast, and their rows are not shuffled at all.  A stream, which cannot be
counted first, salts the keys that were hot in the fitted table instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

# Lookups are broadcast only under both bounds: rows, and estimated bytes
# (rows x (widest key + fixed per-row overhead for values and hashing)).
# Larger lookups take the salted shuffle path.
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 256 * 1024 * 1024
ROW_OVERHEAD_BYTES = 64
# Hot and null-key rows match nothing on the cold side, so their salt range
# costs no replication: a wide range spreads them over every shuffle partition.
SALT_BUCKETS = 1 << 16
HOT_KEYS = 1000


def _restore(df_cols: list[str], joined: DataFrame, values: list[str]) -> DataFrame:
    return joined.select(*df_cols, *values)


def _join_measured(df: DataFrame, lk: DataFrame, keys: list[str], values: list[str], key_bytes: int,
                   max_broadcast_rows: int, max_broadcast_bytes: int) -> DataFrame:
    """Shuffle join that moves neither hot nor null-key rows.

    Keys are counted on ``df`` itself (not on the table the lookup was fitted
    on).  Keys of at least 1 / ``HOT_KEYS`` of the rows are hot: at most
    ``HOT_KEYS`` of them, fewer under a smaller budget or wide keys, so their lookup rows are broadcast and
    their rows stay where they are, as do rows with a null key, which match
    nothing.  ``df`` is read several times, so it is written first."""
    df_cols = df.columns
    df = materialize(df, "lookup-left")
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    hot_keys = max(1, min(HOT_KEYS, max_broadcast_rows, max_broadcast_bytes // (key_bytes + ROW_OVERHEAD_BYTES)))
    counts = df.where(~null_key).groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    total = df.count()
    hot = materialize(counts.where(F.col("__n") * hot_keys >= total).select(*keys), "hot-keys")
    own = [F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]
    hot_right = lk.join(F.broadcast(hot), keys, "left_semi")
    cold = df.where(~null_key).join(F.broadcast(hot), keys, "left_anti")
    found = cold.withColumn("__jk", F.struct(*own)).join(lk.select(F.struct(*own).alias("__jk"), *values), "__jk", "left")
    stay = df.where(~null_key).join(F.broadcast(hot), keys, "left_semi").join(F.broadcast(hot_right), keys, "left")
    empty = df.where(null_key).select(*df_cols, *[F.lit(None).cast(lk.schema[v].dataType).alias(v) for v in values])
    return (_restore(df_cols, found, values).unionByName(_restore(df_cols, stay, values)).unionByName(empty))


def join_lookup(df: DataFrame, lookup: DataFrame, keys: list[str], values: list[str], *,
                lookup_rows: int | None = None, row_counts: str | None = None,
                total_rows: int | None = None, key_bytes: int = 0,
                max_broadcast_rows: int = MAX_BROADCAST_ROWS,
                max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
                salt_buckets: int = SALT_BUCKETS) -> DataFrame:
    """Left join ``lookup`` (unique on ``keys``) onto ``df``; keep ``df``'s
    column order and append ``values``.

    ``lookup_rows`` is the (measured or proven) number of lookup rows; when it
    is None the lookup is measured (rows, and the sum of ``row_counts``) in one
    small aggregate, so pass a small or materialised lookup.
    ``row_counts`` names a lookup column holding each key's row count in
    ``df`` (needed for the skew-safe path, together with ``total_rows``).
    ``key_bytes`` is the widest key in bytes (0 for fixed-width keys).
    """
    lk = lookup.select(*keys, *values)
    n = lookup_rows
    if n is None:
        if row_counts is not None and total_rows is None:
            m = lookup.agg(F.count(F.lit(1)).alias("n"), F.sum(row_counts).alias("t")).first()
            n, total_rows = m["n"], m["t"] or 0
        else:
            n = lookup.count()
    if n <= max_broadcast_rows and n * (key_bytes + ROW_OVERHEAD_BYTES) <= max_broadcast_bytes:
        return _restore(df.columns, df.join(F.broadcast(lk), keys, "left"), values)
    if df.isStreaming and (row_counts is None or total_rows is None):
        return _restore(df.columns, df.join(lk, keys, "left"), values)

    if not df.isStreaming:
        return _join_measured(df, lk, keys, values, key_bytes, max_broadcast_rows, max_broadcast_bytes)

    # A stream cannot be counted first; its hot keys are taken from the fitted
    # counts.  Hot keys: at most total_rows / threshold <= cap of them, where the cap
    # keeps the broadcast of hot keys under both bounds.
    cap = max(1, min(max_broadcast_rows, max_broadcast_bytes // (key_bytes + ROW_OVERHEAD_BYTES)))
    threshold = max(1, -(-total_rows // cap))
    weight = F.col(row_counts)
    hot = lookup.where(weight >= threshold).select(
        *keys, *[F.col(v).alias(f"__hot_{v}") for v in values], F.lit(True).alias("__hot"))

    def join_key(salt):
        # One struct key (keys..., salt): the optimizer cannot fold the cold
        # side's constant salt out of it, so the shuffle hashes key and salt.
        return F.struct(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
                        salt.cast("int").alias("__salt")).alias("__jk")

    cold_keys = F.lit(True)
    for k in keys:
        cold_keys = cold_keys & F.col(k).isNotNull()
    cold = lookup.where((weight < threshold) & cold_keys).select(
        join_key(F.lit(0)), *[F.col(v).alias(f"__cold_{v}") for v in values])

    x = df.join(F.broadcast(hot), keys, "left")
    any_null_key = F.lit(False)
    for k in keys:
        any_null_key = any_null_key | F.col(k).isNull()
    # Hot rows and null-key rows never match a cold key; a deterministic salt
    # (hash of the row) spreads them over ``salt_buckets`` shuffle keys.
    salt = F.when(F.coalesce(F.col("__hot"), F.lit(False)) | any_null_key,
                  F.lit(1) + F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]),
                                    F.lit(salt_buckets))).otherwise(F.lit(0))
    y = x.withColumn("__jk", join_key(salt)).join(cold, "__jk", "left")
    return y.select(*df.columns,
                    *[F.coalesce(F.col(f"__hot_{v}"), F.col(f"__cold_{v}")).alias(v) for v in values])
