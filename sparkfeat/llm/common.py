"""Helpers shared by the operators: joins and running sums that hold under
hot keys, and connected components, all as DataFrame operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

#: A key is hot if it holds more than this share of the rows; so at most
#: ``1 / HOT_SHARE`` keys are hot, whatever the data.
HOT_SHARE = 1 / 500


def text_hash(text) -> F.Column:
    """64-bit hash of the text (null and '' differ)."""
    return F.xxhash64(text)


def join_hot(left: DataFrame, right: DataFrame, keys: list[str], counted: DataFrame | None = None) -> DataFrame:
    """Left join of ``right`` (unique, non-null ``keys``) that never gathers a
    hot key: the rows of keys that hold over ``HOT_SHARE`` of ``left`` (at most
    ``1 / HOT_SHARE`` keys by construction) meet a broadcast of just those keys'
    right rows and stay where they are; the others meet in a shuffle join.
    ``left`` is read three times: pass a table that has been written, or, where
    ``left`` is wide, a slim written table ``counted`` of the same keys."""
    counted = left if counted is None else counted
    total = counted.count()
    hot = materialize(counted.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
                      .where(F.col("__n") > max(1.0, total * HOT_SHARE)).select(*keys), "hot-keys")
    if not hot.head(1):
        return left.join(right, keys, "left")
    hot_right = right.join(F.broadcast(hot), keys, "left_semi")
    few = left.join(F.broadcast(hot), keys, "left_semi").join(F.broadcast(hot_right), keys, "left")
    rest = left.join(F.broadcast(hot), keys, "left_anti").join(right, keys, "left")
    return few.unionByName(rest)


def running_sum(df: DataFrame, group: list[str], order: list, value, out: str = "before",
                buckets: int = 1024, per_group: DataFrame | None = None) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows of the same ``group``
    that come before this one, in the order of (bucket, ``order``).

    Rows are dealt to ``buckets`` buckets by a hash of ``order``, so a group of
    any size is summed in that many pieces; only the pieces' totals are summed
    in sequence.  Equal rows may change places.  ``group`` columns must not be
    null.  ``per_group`` (unique on ``group``) is attached on the way."""
    dealt = df.withColumn("__b", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    keys = [*group, "__b"]
    totals = dealt.groupBy(*keys).agg(F.sum(value).alias("__s"))
    if per_group is not None:
        totals = totals.join(per_group, group)
    earlier = Window.partitionBy(*group).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("__off", F.coalesce(F.sum("__s").over(earlier), F.lit(0))).drop("__s")
    within = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (dealt.join(totals, keys)
            .withColumn(out, F.col("__off") + F.coalesce(F.sum(value).over(within), F.lit(0)))
            .drop("__off", "__b"))


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, root`` (the smallest node of its component) for every node of
    ``edges`` (``u, v`` of an ordered type, without nulls).

    Alternating star contraction: each round hangs the larger neighbours of
    every node, then its smaller ones, under its smallest neighbour.  Each
    round's edges are written to the shared folder, so a lost executor costs
    at most one round."""
    pair = lambda d: d.where("u > v").distinct()
    now = materialize(pair(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))), "cc")
    seen = None
    for _ in range(max_rounds):
        mark = now.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))).first()
        if seen is not None and tuple(mark) == seen:
            break
        seen = tuple(mark)
        # The centre of a large star is one node of very many edges: hot nodes are joined apart.
        both = materialize(now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v"))), "cc-both")
        least = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "cc-least")
        large = pair(join_hot(both.where("v > u"), least, ["u"], counted=both).select(F.col("v").alias("u"), F.col("m").alias("v")))
        large = materialize(large, "cc")
        least = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "cc-least")
        joined = materialize(join_hot(large, least, ["u"]), "cc-joined")
        now = materialize(pair(joined.select("u", F.col("m").alias("v")).unionByName(
            joined.select(F.col("v").alias("u"), F.col("m").alias("v")))), "cc")
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def global_rank(df: DataFrame, order: list, out: str) -> DataFrame:
    """Add ``out``: 1, 2, 3 ... over all rows in ``order`` (which should be total:
    equal rows meet in one range).  Rows are range-partitioned and sorted, the
    sorted copy is written, and the places inside a partition are moved by the
    sizes of the partitions before it (one number per partition)."""
    at = F.monotonically_increasing_id()
    placed = materialize(df.orderBy(*order).withColumn("__at", at), "ranked")
    piece = F.shiftright("__at", 33)
    sizes = sorted((r["p"], r["n"]) for r in placed.groupBy(piece.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
    before, rows = 0, []
    for p, n in sizes:
        rows.append((p, before))
        before += n
    offsets = df.sparkSession.createDataFrame(rows, "__p long, __before long")
    return (placed.withColumn("__p", piece).join(F.broadcast(offsets), "__p", "left")
            .withColumn(out, F.col("__before") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("__at", "__p", "__before"))
