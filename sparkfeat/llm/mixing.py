"""Mixing sources to target weights by entropy balancing.

Every document gets a rate in (0, cap) that tilts the base rate 1
exponentially in its size, ``rate = cap * e^(k x) / (cap - 1 + e^(k x))`` with
``x`` its size over the source's mean size; this is the solution of the
entropy-balancing problem with bounded rates, and ``k`` is the dual variable
of its source's token constraint.  The dual is convex and separates by source;
Newton steps solve it for all sources at once, each step one distributed
aggregate over the (source, size) histogram, not over the documents.  Rates
are then rounded into whole copies: along the sizes of a source the running
sum of expected copies is rounded (its token error is below the largest size),
and the rest is settled on one group of each power of two, largest first.

All DataFrame expressions; sums that decide a rounding are exact decimals, so
reruns agree whatever the order of rows.

Defined cases: null texts have size 0 and are taken 0 times (nothing to
count); the null source is a source of its own and comes last; a source of
size 0 has target 0; without any words all targets are 0; repeated rows are
rows of their own, and which of several equal rows gets the extra copy cannot
be told; an empty table gives an empty result; extra columns are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import running_sum

CAP = 3
WEIGHTS = (1, 2, 3)
TOLERANCE = 1e-9
MAX_STEPS = 60
ROWS_PER_PIECE = 5_000
_WORD = r"[^\x20\x09-\x0D]+"


def size_of(text) -> F.Column:
    """Number of words (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def source_key(source) -> F.Column:
    """Non-null key of a source: null and any text stay apart and sort right
    (by code point, null last)."""
    return F.when(F.col(source).isNull(), F.lit("~")).otherwise(F.concat(F.lit("="), F.col(source)))


def targets(sizes: DataFrame, cap: int = CAP, weights=WEIGHTS) -> DataFrame:
    """``key, source_size, target`` from ``key, source_size`` (one row per
    source).  The level at which weighted shares meet the caps is found on
    running sums in the order of cap over weight, which equals resharing the
    excess until no source is above its cap.  One row per source is sorted in
    one task: sources, not documents."""
    one = Window.orderBy("key")
    cycle = F.array(*[F.lit(w) for w in weights])
    x = sizes.withColumn("w", F.element_at(cycle, F.pmod(F.row_number().over(one) - 1, F.lit(len(weights))) + 1).cast("double"))
    x = materialize(x.withColumn("cap", (cap * F.col("source_size")).cast("double")), "mix-sources")
    order = Window.orderBy((F.col("cap") / F.col("w")), "key")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    total = x.agg(F.sum("source_size").cast("double").alias("total"))
    level = (x.crossJoin(F.broadcast(total))  # one row
             .withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(after))
             .where(F.col("level") <= F.col("cap") / F.col("w")).agg(F.max("level").alias("level")))
    return (x.crossJoin(F.broadcast(level))  # one row
            .select("key", "source_size", F.least(F.col("cap"), F.coalesce(F.col("level"), F.lit(0.0)) * F.col("w")).alias("target")))


def _rate(k, x, cap: int) -> F.Column:
    """Stable for any ``k * x``."""
    return F.lit(float(cap)) / (1.0 + (cap - 1.0) * F.exp(F.least(-k * x, F.lit(700.0))))


def solve(histogram: DataFrame, goal: DataFrame, cap: int = CAP, tolerance: float = TOLERANCE,
          max_steps: int = MAX_STEPS) -> DataFrame:
    """``key, k`` (null where the target is the cap: every rate is ``cap``) from
    ``key, size, n`` (sizes above 0) and ``key, source_size, target``.

    Safeguarded Newton on the logarithm of each source's constraint: a step
    that leaves the bracket known so far is replaced by its middle, or by a
    doubling while one end is open.  Only the largest relative error reaches
    the driver."""
    mean = histogram.groupBy("key").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"))
    state = materialize(goal.where((F.col("target") > 0) & (F.col("target") < cap * F.col("source_size"))).join(mean, "key")
                        .select("key", "target", "mean", F.lit(0.0).alias("k"), F.lit(None).cast("double").alias("lo"),
                                F.lit(None).cast("double").alias("hi"), F.lit(1.0).alias("gap")), "mix-state")
    x = F.col("size") / F.col("mean")
    for _ in range(max_steps):
        rate = _rate(F.col("k"), x, cap)
        tokens = F.col("n") * F.col("size") * rate
        sums = (histogram.join(state.select("key", "mean", "k"), "key").groupBy("key").agg(
            F.sum(tokens.cast("decimal(30,6)")).cast("double").alias("s"),
            F.sum((tokens * x * (1 - rate / cap)).cast("decimal(30,6)")).cast("double").alias("j")))
        k, lo, hi = F.col("k"), F.col("lo2"), F.col("hi2")
        newton = k - F.log(F.col("s") / F.col("target")) * F.col("s") / F.col("j")
        middle = (F.when(lo.isNull(), F.least(2 * k, F.lit(-1.0))).when(hi.isNull(), F.greatest(2 * k, F.lit(1.0)))
                  .otherwise((lo + hi) / 2))
        inside = (F.col("j") > 0) & (F.col("s") > 0) & (lo.isNull() | (newton > lo)) & (hi.isNull() | (newton < hi)) & (
            F.abs(newton - k) <= 4 + F.abs(k))
        new = (state.join(sums, "key")
               .withColumn("lo2", F.when(F.col("s") < F.col("target"), k).otherwise(F.col("lo")))
               .withColumn("hi2", F.when(F.col("s") >= F.col("target"), k).otherwise(F.col("hi")))
               .withColumn("gap2", F.abs(F.col("s") / F.col("target") - 1))
               .withColumn("k2", F.when(F.col("gap2") <= tolerance, k).otherwise(F.when(inside, newton).otherwise(middle)))
               .select("key", "target", "mean", F.col("k2").alias("k"), lo.alias("lo"), hi.alias("hi"), F.col("gap2").alias("gap")))
        state = materialize(new, "mix-state")
        worst = state.agg(F.max("gap")).first()[0]
        if worst is None or worst <= tolerance:
            break
    return goal.join(state.select("key", "k", "mean"), "key", "left")


def copies_by_group(histogram: DataFrame, solved: DataFrame, cap: int = CAP) -> DataFrame:
    """``key, size, n, total``: whole copies handed out to the ``n`` documents of
    one source and size.  A source has at most as many groups as sizes."""
    full = F.col("target") >= cap * F.col("source_size")
    rate = F.when(full, F.lit(float(cap))).when(F.col("k").isNull(), F.lit(0.0)).otherwise(
        _rate(F.col("k"), F.col("size") / F.col("mean"), cap))
    by_size = Window.partitionBy("key").orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, 0)
    g = (histogram.join(solved, "key").withColumn("expected", (F.col("n") * rate).cast("decimal(30,6)"))
         .withColumn("run", F.sum("expected").over(by_size))
         .withColumn("total", F.least(F.floor(F.col("run") + F.lit("0.5").cast("decimal(2,1)"))
                                      - F.floor(F.col("run") - F.col("expected") + F.lit("0.5").cast("decimal(2,1)")),
                                      cap * F.col("n")).cast("long"))
         .select("key", "size", "n", "total", "target"))
    g = materialize(g, "mix-groups")
    rest = g.groupBy("key").agg(F.max("target").alias("target"), F.sum(F.col("size") * F.col("total")).alias("got"))
    per_power = Window.partitionBy("key", F.floor(F.log2("size"))).orderBy(F.desc("n"), "size")
    chosen = (g.withColumn("r", F.row_number().over(per_power)).where("r = 1").groupBy("key")
              .agg(F.reverse(F.array_sort(F.collect_list(F.struct("size", "n", "total")))).alias("g")))  # at most 63 each

    def settle(state, group):
        step = F.greatest(-group["total"], F.least(cap * group["n"] - group["total"],
                                                   F.round(state["rest"] / group["size"]).cast("long")))
        return F.struct((state["rest"] - step * group["size"]).alias("rest"),
                        F.concat(state["steps"], F.array(F.struct(group["size"].alias("size"), step.alias("step")))).alias("steps"))

    empty = F.array().cast("array<struct<size:long,step:long>>")
    steps = (chosen.join(rest, "key").select("key", F.aggregate(
        "g", F.struct((F.col("target") - F.col("got")).cast("double").alias("rest"), empty.alias("steps")), settle).alias("s"))
        .select("key", F.explode("s.steps").alias("t")).select("key", "t.size", "t.step"))
    return (g.join(steps, ["key", "size"], "left")
            .select("key", "size", "n", (F.col("total") + F.coalesce("step", F.lit(0))).alias("total")))


def mix(docs: DataFrame, source_col: str = "source", text_col: str = "text", id_col: str = "doc_id", cap: int = CAP,
        weights=WEIGHTS) -> DataFrame:
    """``docs``, all columns, plus ``mix_size``, ``mix_source_size``,
    ``mix_target`` and ``mix_copies``."""
    own = docs.columns
    rows = docs.select("*", size_of(F.col(text_col)).alias("mix_size"), source_key(source_col).alias("__key"),
                       F.xxhash64(id_col, text_col).alias("__h"))
    histogram = materialize(rows.groupBy(F.col("__key").alias("key"), F.col("mix_size").alias("size"))
                            .agg(F.count(F.lit(1)).alias("n")), "mix-sizes")
    sizes = histogram.groupBy("key").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    goal = materialize(targets(sizes, cap, weights), "mix-targets")
    words = histogram.where("size > 0")
    groups = copies_by_group(words, solve(words, goal, cap), cap)
    per_group = (histogram.join(groups.drop("n"), ["key", "size"], "left").join(goal, "key")
                 .select(F.col("key").alias("__key"), F.col("size").alias("mix_size"), F.col("n").alias("__n"),
                         F.coalesce("total", F.lit(0)).alias("__total"), F.col("source_size").alias("mix_source_size"),
                         F.col("target").alias("mix_target")))
    per_group = materialize(per_group, "mix-copies")
    # A group of one source and size can hold most rows: enough pieces that each is a few thousand texts.
    n_rows = histogram.agg(F.sum("n")).first()[0] or 0
    pieces = max(256, int(n_rows) // ROWS_PER_PIECE)
    ranked = running_sum(rows, ["__key", "mix_size"], [F.col("__h"), F.col(id_col)], F.lit(1), "__rank", pieces, per_group)
    extra = (F.col("__rank") < F.pmod("__total", "__n")).cast("long")
    copies = F.floor(F.col("__total") / F.col("__n")) + extra
    return ranked.select(*own, "mix_size", "mix_source_size", "mix_target", copies.cast("long").alias("mix_copies"))


def repeat_rows(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """Each row as often as its copies say."""
    return (mixed.where("mix_copies > 0").withColumn("__i", F.explode(F.sequence(F.lit(1), F.col("mix_copies").cast("int"))))
            .select(*columns))
