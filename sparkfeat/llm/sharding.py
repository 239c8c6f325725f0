"""Resharding by minimum-cost flow.

Rows lie in old shards; new capacities say how many bytes each shard should
hold.  Blocks (rows of equal text) are moved so that the fewest bytes change
their shard: a flow from the old shards' sizes to the new shards' room, where
staying costs nothing and a moved byte costs ``cost[old][new]`` (1 unless
given), is solved on shard totals, and blocks are cut off each old shard's
sequence to follow it.  Only files of shards that lose or gain a block need
rewriting.

Blocks above 1 / ``LARGE`` of a shard's capacity (so at most ``LARGE`` per
shard by construction) are placed one by one before the flow; a block above a
whole capacity is split by row id.  The others follow the flow, so each cut
misplaces less than 1 / ``LARGE`` of a shard.

Defined cases: a null text has no bytes and equals only other nulls; every row
counts one byte more; null ids are a value like any other; repeated rows are
rows of their own and share a block (and a piece, if the block is split); an
empty table gives an empty result; extra columns are kept out of the way.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import join_hot, running_sum

SHARDS = 16
LARGE = 200


def min_cost_flow(supply: list[int], room: list[int], cost) -> list[list[int]]:
    """Bytes sent from each old to each new shard: successive shortest paths on
    the bipartite graph of shards (a few hundred arcs).  The sum of ``room``
    must cover that of ``supply``."""
    n, m = len(supply), len(room)
    flow = [[0] * m for _ in range(n)]
    left, free = list(supply), list(room)
    while any(left):
        # Shortest residual distance from any old shard with bytes left (Bellman-Ford).
        far = [0 if left[i] else float("inf") for i in range(n)] + [float("inf")] * m
        via: list[int | None] = [None] * (n + m)
        changed = True
        while changed:
            changed = False
            for i in range(n):
                for j in range(m):
                    c = cost(i, j)
                    if far[i] + c < far[n + j]:
                        far[n + j], via[n + j], changed = far[i] + c, i, True
                    if flow[i][j] and far[n + j] - c < far[i]:
                        far[i], via[i], changed = far[n + j] - c, n + j, True
        end = min((j for j in range(m) if free[j]), key=lambda j: (far[n + j], j))
        path, at = [], n + end
        while via[at] is not None:
            path.append((via[at], at))
            at = via[at]
        push = min([left[at], free[end]] + [flow[b][a - n] for a, b in path if a >= n])
        for a, b in path:
            if a < n:
                flow[a][b - n] += push
            else:
                flow[b][a - n] -= push
        left[at] -= push
        free[end] -= push
    return flow


def place_large(blocks: list[tuple], capacity: list[int]) -> tuple[dict, list[int]]:
    """Shard of each large block ``(bytes, old, key)`` and the room left: the
    largest first, each at home if it fits there, else where most room is."""
    room, at = list(capacity), {}
    away = []
    for size, old, key in sorted(blocks, key=lambda b: (-b[0], str(b[2]))):
        if size <= room[old]:
            room[old] -= size
            at[key] = old
        else:
            away.append((size, old, key))
    heap = [(-r, s) for s, r in enumerate(room)]
    heapq.heapify(heap)
    for size, _, key in away:
        r, s = heapq.heappop(heap)
        at[key] = s
        room[s] -= size
        heapq.heappush(heap, (r + size, s))
    return at, [max(0, r) for r in room]


def reshard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS,
            old_shard: str | None = None, capacity: list[int] | None = None, cost=None, keep: list[str] | None = None) -> DataFrame:
    """``id_col, size, text_crc32, old_shard, shard, slot`` (and ``keep``) of
    every row.  Without an ``old_shard`` column the old layout is the text's
    hash modulo ``shards``; without capacities they are equal.  ``slot`` counts
    from 0 within a shard, without gaps."""
    text = F.col(text_col)
    hashed = F.xxhash64(text)
    old = F.pmod(F.col(old_shard), F.lit(shards)) if old_shard else F.pmod(hashed, F.lit(shards))
    kept = [f"__own{i}" for i in range(len(keep or []))]
    rows = materialize(docs.select(
        *[F.col(c).alias(k) for c, k in zip(keep or [], kept)],
        F.col(id_col).alias("__id"), (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("__size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("__crc"), hashed.alias("__text"),
        old.cast("int").alias("__old")), "shard-rows")
    same = ["__text", "__crc", "__size", "__old"]
    total = int(rows.agg(F.sum("__size")).first()[0] or 0)
    limits = list(capacity) if capacity else [total // shards + (s < total % shards) for s in range(shards)]
    if sum(limits) < total:
        raise ValueError("the capacities do not hold all bytes")
    whole = max(1, total // shards)

    blocks = materialize(rows.groupBy(*same).agg((F.count(F.lit(1)) * F.col("__size")).alias("__bytes")), "shard-blocks")
    huge = blocks.where(F.col("__bytes") > whole)  # at most ``shards`` blocks
    pieces = F.ceil(F.lit(4) * F.col("__bytes") / F.lit(whole)).cast("int").alias("__pieces")
    huge = materialize(huge.select(*same, pieces), "shard-huge")
    if huge.head(1):
        rows = materialize(rows.join(F.broadcast(huge), same, "left").withColumn(
            "__piece", F.when(F.col("__pieces").isNull(), 0).otherwise(
                F.pmod(F.xxhash64(F.lit("piece"), "__id"), F.col("__pieces"))).cast("int")).drop("__pieces"), "shard-rows")
        blocks = rows.groupBy(*same, "__piece").agg((F.count(F.lit(1)) * F.col("__size")).alias("__bytes"))
    else:
        rows, blocks = rows.withColumn("__piece", F.lit(0)), blocks.withColumn("__piece", F.lit(0))
    block = [*same, "__piece"]
    blocks = materialize(blocks.withColumn("__large", F.col("__bytes") * LARGE > whole), "shard-blocks")

    large = [(r["__bytes"], r["__old"], (r["__text"], r["__crc"], r["__size"], r["__old"], r["__piece"]))
             for r in blocks.where("__large").collect()]  # at most LARGE * shards
    at, room = place_large(large, limits)
    supply = [0] * shards
    for r in blocks.where("not __large").groupBy("__old").agg(F.sum("__bytes").alias("b")).collect():
        supply[r["__old"]] = int(r["b"])
    flow = min_cost_flow(supply, room, cost or (lambda i, j: int(i != j)))

    small = running_sum(blocks.where("not __large"), ["__old"], ["__text", "__crc", "__size", "__piece"], F.col("__bytes"), "__before")
    middle = F.col("__before") + F.col("__bytes") / 2
    shard = F.lit(None).cast("int")
    for i in reversed(range(shards)):
        ends, own = 0, F.lit(i)
        cuts = []
        for j in sorted((j for j in range(shards) if flow[i][j]), key=lambda j: (j != i, j)):
            ends += flow[i][j]
            cuts.append((ends, j))
        if cuts:
            own = F.lit(cuts[-1][1])
            for end, j in reversed(cuts[:-1]):
                own = F.when(middle < end, j).otherwise(own)
        shard = F.when(F.col("__old") == i, own).otherwise(shard)
    plan = small.select(*block, shard.cast("int").alias("__shard"))
    if at:
        spark = docs.sparkSession
        plan = plan.unionByName(spark.createDataFrame(
            [(*key, s) for key, s in at.items()], "__text long, __crc long, __size long, __old int, __piece int, __shard int"))
    plan = materialize(plan, "shard-plan")
    found = materialize(join_hot(rows, plan, block), "shard-found")
    slotted = running_sum(found, ["__shard"], ["__id", "__text", "__old"], F.lit(1), "__slot")
    return slotted.select(
        F.col("__id").alias(id_col), F.col("__size").alias("size"), F.col("__crc").alias("text_crc32"),
        F.col("__old").alias("old_shard"), F.col("__shard").alias("shard"), F.col("__slot").cast("long").alias("slot"),
        *[F.col(k).alias(c) for c, k in zip(keep or [], kept)])


def rewrite_affected(rows: DataFrame, out_dir: str) -> list[int]:
    """Write the rows of every shard that lost or gained a row to
    ``out_dir/shard=<n>`` and return these shards; the files of all others can
    stay as they are.  ``rows`` has ``old_shard`` and ``shard``."""
    moved = rows.where("old_shard <> shard")
    touched = sorted(r[0] for r in moved.select(F.explode(F.array("old_shard", "shard"))).distinct().collect())
    rows.where(F.col("shard").isin(touched)).write.partitionBy("shard").mode("overwrite").parquet(out_dir)
    return touched
