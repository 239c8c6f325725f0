"""Train / test split (#37).

``hash_split`` assigns a row by a hash of its key: the same row lands in the
same part whatever the partitioning, and a recomputed partition (lost
executor) reproduces exactly the same split.  ``random_split`` is Spark's
``randomSplit`` for parity; its membership depends on partition layout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K

HASH_BUCKETS = 10_000


def hash_bucket(key: Column) -> Column:
    """0..9999 from the first 32 bits of ``md5(key)``."""
    h = F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint")
    return F.pmod(h, F.lit(HASH_BUCKETS))


def is_train(key: Column, fraction: float = K.TRAIN_FRACTION) -> Column:
    """Null for a null key; use :func:`train_flag` where keys can be null."""
    return hash_bucket(key) < F.lit(int(round(fraction * HASH_BUCKETS)))


def train_flag(df: DataFrame, key: str, fraction: float = K.TRAIN_FRACTION) -> Column:
    """Never null: a row without a key is assigned by a hash of its other
    columns, so such rows spread over both parts and none is lost."""
    rest = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(HASH_BUCKETS))
    bucket = F.coalesce(hash_bucket(F.col(key)), rest)
    return bucket < F.lit(int(round(fraction * HASH_BUCKETS)))


def hash_split(df: DataFrame, key: str, fraction: float = K.TRAIN_FRACTION) -> tuple[DataFrame, DataFrame]:
    flag = train_flag(df, key, fraction)
    return df.where(flag), df.where(~flag)


def random_split(df: DataFrame, fraction: float = K.TRAIN_FRACTION, seed: int = K.SEED):
    train, test = df.randomSplit([fraction, 1.0 - fraction], seed=seed)
    return train, test
