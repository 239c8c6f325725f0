"""Category index of any cardinality (#39): the index is a written table, not a
label list on the driver.

Defined cases: values are ordered by rows (most first), ties by the UTF-8
bytes of their text (numbers too, as in ``StringIndexer``); null and unseen
values get the extra last index; a column without any value has an empty table,
and every row gets index 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import discard, materialize
from .lookup import MAX_BROADCAST_ROWS, join_lookup

_LOW_BITS = 33  # monotonically_increasing_id: the partition, then the row within it


def category_table(df: DataFrame, col: str) -> DataFrame:
    """``col, count, index`` of every value of ``col``.

    Counting is partially aggregated before its shuffle.  The counts are range
    partitioned and sorted, so a value's index is its place in its partition plus
    the rows of the partitions before; only the partitions' sizes meet in one
    task, one row each."""
    value = F.col(f"`{col}`")
    counts = materialize(df.where(value.isNotNull()).groupBy(value.alias("value"))
                         .agg(F.count(F.lit(1)).alias("count")), "category-counts")
    order = [F.col("count").desc(), F.col("value").cast("string")]
    placed = materialize(counts.repartitionByRange(*order).sortWithinPartitions(*order)
                         .withColumn("id", F.monotonically_increasing_id()), "category-order")
    discard(counts)
    part = F.shiftright("id", _LOW_BITS).alias("part")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy(part).agg(F.count(F.lit(1)).alias("rows"))
               .select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset")))
    place = F.col("id").bitwiseAND(F.lit((1 << _LOW_BITS) - 1))
    table = materialize(placed.withColumn("part", part).join(F.broadcast(offsets), "part")  # one row per partition
                        .select(F.col("value").alias(col), "count", (F.col("offset") + place).alias("index")),
                        "category-index")
    discard(placed)
    return table


def index_category(df: DataFrame, table: DataFrame, col: str, out: str | None = None,
                   max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``df`` with ``out`` (default ``<col>_idx``, double).  A table of more than
    ``max_broadcast_rows`` values, or too many bytes, is joined by a shuffle that
    leaves hot values' rows in place."""
    out = out or f"{col}_idx"
    size = table.agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length(F.col(f"`{col}`").cast("string"))).alias("b")).first()
    found = join_lookup(df, table.withColumnRenamed("index", out), [col], [out], lookup_rows=size["n"],
                        key_bytes=size["b"] or 0, max_broadcast_rows=max_broadcast_rows)
    return found.withColumn(out, F.coalesce(F.col(out), F.lit(size["n"])).cast("double"))
