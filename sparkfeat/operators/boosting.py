"""Gradient-boosted trees fitted on packed bins (#50).

``BoostedTrees`` is ``GBTClassifier`` with another way through the rows.  The
library keeps each row as objects, several hundred bytes, and reads all of them
once a level of each tree; where they outgrow the memory they are read back from
disk and deserialised every time.  Here split candidates come from the library,
then every row is written once as its bins: neighbouring features share a 16-bit
code, and blocks of rows are columns of codes.  A level of a tree is one pass of
array counts over the blocks, and a task returns only sums by node and bin.

Targets are fixed-point numbers, so that sums are exact whatever the order and
number of partitions: equal splits stay equal and the first feature and lowest
threshold win.  Splits, leaf means, stopping rules and pruning are the library's,
and so is the returned model.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, materialize, ready, setting

#: Values of a packed code: the sums of 16 nodes by code stay in a core's cache.
CODE_VALUES = 1024
#: Most rows of a block; sums of a block are whole numbers that a double holds.
BLOCK_ROWS = 1 << 16
#: Bytes of vectors in one Arrow batch, and of codes in one block.
BATCH_BYTES = 1 << 23
#: Deeper trees go to the library: sums are kept for all nodes of a level.
MAX_DEPTH = 8
#: Tasks of a pass over the blocks, for each core.
TASKS_PER_CORE = 3
#: Blocks of up to this many bytes are summed by the driver: a pass takes less than a job's start.
HELD_BYTES = 1 << 25
#: Least bytes of blocks for a task.
TASK_BYTES = 1 << 22
_BLOCK = "codes binary, label binary, margin binary"
_EPSILON = 2.0 ** -52


@dataclass
class Layout:
    """Split candidates of every feature, and where its bins are found."""
    thresholds: list[np.ndarray | None]  # None: a category, whose values are its bins
    bins: list[int]
    packs: list[list[tuple[int, int]]] = field(init=False)  # (feature, stride) of each code

    def __post_init__(self):
        self.packs, size = [], CODE_VALUES
        for f, n in enumerate(self.bins):
            if size * n > CODE_VALUES:
                self.packs.append([])
                size = 1
            self.packs[-1].append((f, size))
            size *= n
        self.place = {f: (p, stride) for p, pack in enumerate(self.packs) for f, stride in pack}
        self.widths = [int(np.prod([self.bins[f] for f, _ in pack])) for pack in self.packs]
        self.starts = np.concatenate([[0], np.cumsum(self.bins)])

    def encode(self, x: np.ndarray) -> np.ndarray:
        """Codes (pack x row) of a row x feature matrix."""
        x = np.ascontiguousarray(x.T)
        out = np.zeros((len(self.packs), x.shape[1]), dtype=np.uint16)
        for p, pack in enumerate(self.packs):
            for f, stride in pack:
                cuts, v = self.thresholds[f], x[f]
                if cuts is None:
                    b = v.astype(np.int64)
                    if len(b) and (b.min() < 0 or b.max() >= self.bins[f]):
                        raise ValueError(f"feature {f} has a category outside 0..{self.bins[f] - 1}")
                else:
                    b = v > cuts[0] if len(cuts) == 1 else np.searchsorted(cuts, v) if len(cuts) else 0
                out[p] += np.asarray(b, dtype=np.uint16) * np.uint16(stride)
        return out

    def by_bin(self, p: int, sums: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Sums by code (... x code) of pack ``p`` as sums by bin of each feature."""
        pack = self.packs[p]
        cube = sums.reshape(*sums.shape[:-1], *[self.bins[f] for f, _ in reversed(pack)])
        lead = sums.ndim - 1
        for i, (f, _) in enumerate(reversed(pack)):
            yield f, cube.sum(axis=tuple(lead + j for j in range(len(pack)) if j != i))


@dataclass
class Tree:
    """Nodes by heap number (root 1, children 2 i and 2 i + 1): how rows walk."""
    size: int
    pack: np.ndarray = field(init=False)
    step: np.ndarray = field(init=False)   # 2 i, or i at a leaf
    right: np.ndarray = field(init=False)  # by code: 1 to the right child

    def __post_init__(self):
        self.pack = np.zeros(self.size, dtype=np.intp)
        self.step = np.arange(self.size)
        self.right = np.zeros((self.size, CODE_VALUES), dtype=np.int8)

    def split(self, layout: Layout, node: int, feature: int, goes_right: np.ndarray) -> None:
        p, stride = layout.place[feature]
        codes = np.arange(layout.widths[p])
        self.pack[node], self.step[node] = p, 2 * node
        self.right[node, :len(codes)] = goes_right[codes // stride % layout.bins[feature]]

    def walk(self, codes: np.ndarray, depth: int) -> np.ndarray:
        rows = np.arange(codes.shape[1])
        node = np.ones(codes.shape[1], dtype=np.intp)
        for _ in range(depth):
            node = self.step[node] + self.right[node, codes[self.pack[node], rows]]
        return node


def _target(label: np.ndarray, margin: np.ndarray | None) -> np.ndarray:
    """Labels -1 and 1, then the negative gradient of the log loss."""
    y = 2.0 * label - 1.0
    return y if margin is None else 4.0 * y / (1.0 + np.exp(2.0 * y * margin))


def _read(row: dict, packs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    codes = np.frombuffer(row["codes"], dtype=np.uint16).reshape(packs, -1)
    return codes, np.frombuffer(row["label"], dtype=np.int8), np.frombuffer(row["margin"]) if row["margin"] else None


def _block(codes: np.ndarray, label: np.ndarray, margin: bytes) -> dict:
    return {"codes": codes.tobytes(), "label": label.tobytes(), "margin": margin}


def _encoder(layout: Layout, block_rows: int):
    """Arrow batches of vectors and labels to blocks."""
    def cut(held):
        codes, label = (np.concatenate(v, axis=-1) for v in zip(*held))
        for i in range(0, len(label), block_rows):
            yield _arrow(_block(np.ascontiguousarray(codes[:, i:i + block_rows]), label[i:i + block_rows], b""))

    def run(batches):
        held, n = [], 0
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            held.append((layout.encode(x), batch.column(1).to_numpy(zero_copy_only=False).astype(np.int8)))
            n += batch.num_rows
            if n >= block_rows:
                yield from cut(held)
                held, n = [], 0
        if n:
            yield from cut(held)
    return run


def _summer(layout: Layout, tree: Tree, nodes: list[int], depth: int, scale: int, scale2: int):
    """Rows, targets and squared targets by node and bin, over some blocks."""
    def run(blocks):
        slot = np.full(tree.size, len(nodes), dtype=np.intp)  # the last slot: rows in leaves
        slot[nodes] = np.arange(len(nodes))
        total = [np.zeros((3, len(nodes), w), dtype=np.int64) for w in layout.widths]
        for row in blocks:
            codes, label, margin = _read(row, len(layout.packs))
            t = _target(label, margin)
            weights = None, np.rint(np.ldexp(t, scale)), np.rint(np.ldexp(t * t, scale2))
            place = slot[tree.walk(codes, depth)]
            for p, w in enumerate(layout.widths):
                at = place * w + codes[p]
                for k, weight in enumerate(weights):
                    sums = np.bincount(at, weight, minlength=(len(nodes) + 1) * w)[:len(nodes) * w]
                    total[p][k] += sums.reshape(len(nodes), w).astype(np.int64)
        out = np.empty((3, len(nodes), layout.starts[-1]), dtype=np.int64)
        for p, sums in enumerate(total):
            for f, by_bin in layout.by_bin(p, sums):
                out[:, :, layout.starts[f]:layout.starts[f + 1]] = by_bin
        yield {"sums": out.tobytes()}
    return run


def _scorer(layout: Layout, tree: Tree, depth: int, leaf: np.ndarray, weight: float):
    """Blocks with the margin after one more tree."""
    def run(blocks):
        for row in blocks:
            codes, label, margin = _read(row, len(layout.packs))
            more = weight * leaf[tree.walk(codes, depth)]
            yield _block(codes, label, (more if margin is None else margin + more).tobytes())
    return run


def _arrow(row: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({name: pa.array([v], pa.binary()) for name, v in row.items()})


def _in_arrow(task):
    """``task`` on blocks that arrive one at a time from Arrow batches."""
    def run(batches):
        yield from map(_arrow, task(batch.slice(i, 1).to_pylist()[0] for batch in batches for i in range(batch.num_rows)))
    return run


class _Held:
    """Blocks of a small table, in the driver: at most ``HELD_BYTES``."""

    def __init__(self, blocks: DataFrame):
        self.rows = [r.asDict() for r in blocks.collect()]

    def sums(self, task) -> list[dict]:
        return list(task(self.rows))

    def scored(self, task) -> None:
        self.rows = list(task(self.rows))

    def close(self) -> None:
        self.rows = []


class _Written:
    """Blocks as a table in the checkpoint folder, written anew for each tree."""

    def __init__(self, blocks: DataFrame):
        self.table = materialize(blocks, "boosting")

    @contextmanager
    def _few_tasks(self):
        """A few tasks a core, so that what tasks send to the driver does not grow with the table."""
        spark = self.table.sparkSession
        size = int(str(self.table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        most = max(TASK_BYTES, size // (TASKS_PER_CORE * spark.sparkContext.defaultParallelism))
        with setting(spark, "spark.sql.files.maxPartitionBytes", str(most)), setting(spark, "spark.sql.files.openCostInBytes", "1024"):
            yield

    def sums(self, task) -> list:
        with self._few_tasks():
            return self.table.mapInArrow(_in_arrow(task), "sums binary").collect()

    def scored(self, task) -> None:
        with self._few_tasks():
            old, self.table = self.table, materialize(self.table.mapInArrow(_in_arrow(task), _BLOCK), "boosting")
        discard(old)

    def close(self) -> None:
        discard(self.table)


@dataclass
class Stats:
    """Rows, mean, and the sums that a node of the model keeps."""
    rows: int
    total: float
    squares: float
    split: tuple | None = None  # (feature, threshold, left categories)
    gain: float = 0.0
    valid: bool = True

    @property
    def mean(self) -> float:
        return self.total / self.rows

    @property
    def impurity(self) -> float:
        return max(0.0, (self.squares - self.total * self.total / self.rows) / self.rows)


class _Search:
    """Best split of every node of a level from its sums by bin."""

    def __init__(self, layout: Layout, scale: int, scale2: int, min_rows: int, min_gain: float):
        self.layout, self.scale, self.scale2 = layout, scale, scale2
        self.min_rows, self.min_gain = min_rows, min_gain

    def stats(self, sums) -> Stats:
        return Stats(int(sums[0]), float(np.ldexp(float(sums[1]), -self.scale)), float(np.ldexp(float(sums[2]), -self.scale2)))

    def best(self, sums: np.ndarray) -> list[tuple]:
        """Of each node (sums by statistic, node and bin): gain or None, feature,
        position, order of bins, left sums, all sums."""
        layout, count = self.layout, sums.shape[1]
        whole = sums[:, :, layout.starts[0]:layout.starts[1]].sum(axis=2)
        found = [(None, 0, 0, None, None)] * count
        top = np.full(count, -np.inf)
        with np.errstate(all="ignore"):
            for f, cuts in enumerate(layout.thresholds):
                own = sums[:, :, layout.starts[f]:layout.starts[f + 1]]
                order = np.broadcast_to(np.arange(own.shape[2]), own.shape[1:])
                if own.shape[2] < 2:
                    continue
                if cuts is None:  # categories by their mean target, those without rows last
                    order = np.argsort(np.where(own[0] > 0, own[1] / own[0], np.inf), axis=1, kind="stable")
                    own = np.take_along_axis(own, order[None], axis=2)
                left = np.cumsum(own, axis=2)[:, :, :-1]
                n, m = left[0], whole[0][:, None] - left[0]
                apart = np.abs(left[1] / n - (whole[1][:, None] - left[1]) / m)
                # Below one unit the targets' own rounding shows.
                gain = np.where(apart < 1.0, 0.0, np.ldexp(apart, -self.scale)) ** 2 * (n / (n + m)) * (m / (n + m))
                gain = np.where((n >= self.min_rows) & (m >= self.min_rows) & (gain >= self.min_gain), gain, -np.inf)
                at = np.argmax(gain, axis=1)
                for i in np.flatnonzero(gain[np.arange(count), at] > top):
                    top[i] = gain[i, at[i]]
                    found[i] = float(top[i]), f, int(at[i]), order[i], left[:, i, at[i]]
        return [(*one, whole[:, i]) for i, one in enumerate(found)]


def _grow(layout: Layout, search: _Search, passes, max_depth: int) -> tuple[Tree, dict[int, Stats]]:
    """One tree, level by level; ``passes(tree, nodes, depth)`` gives the sums of ``nodes``."""
    tree, known, level = Tree(2 ** (max_depth + 1)), {}, [1]
    for depth in range(max(max_depth, 1)):
        if not level:
            break
        sums, after = passes(tree, level, depth), []
        for node, (gain, f, at, order, left, whole) in zip(level, search.best(sums)):
            stats = known.setdefault(node, search.stats(whole))
            stats.valid = gain is not None
            if gain is None or gain <= 0 or depth == max_depth:
                continue
            goes_right = np.zeros(layout.bins[f], dtype=np.int8)
            goes_right[order[at + 1:]] = 1
            cuts = layout.thresholds[f]
            stats.gain = gain
            stats.split = (f, float(cuts[at]), None) if cuts is not None else (f, None, [float(c) for c in order[:at + 1]])
            tree.split(layout, node, f, goes_right)
            for child, part in ((2 * node, left), (2 * node + 1, whole - left)):
                known[child] = search.stats(part)
                if depth + 1 < max_depth and known[child].impurity >= _EPSILON:
                    after.append(child)
        level = after
    return tree, known


def _module(package, name: str):
    """A Scala object."""
    return getattr(getattr(package, f"{name}$"), "MODULE$")


def _run_once(df: DataFrame) -> DataFrame:
    """``df`` on one execution of its plan: what it shuffles serves several jobs."""
    jdf, spark = df._jdf, df.sparkSession
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(jdf.queryExecution().toRdd(), jdf.schema(), False), spark)


class BoostedTrees(GBTClassifier):
    """``GBTClassifier`` fitted on packed bins.  Sampled rows or features, weights,
    a validation column, very deep trees and more bins than a code has values are
    left to the library's fit."""

    def _packed(self) -> bool:
        return (self.getSubsamplingRate() == 1.0 and self.getFeatureSubsetStrategy() == "all"
                and self.getMinWeightFractionPerNode() == 0.0 and self.getMaxBins() <= CODE_VALUES
                and self.getMaxDepth() <= MAX_DEPTH and not any(
                    self.isDefined(p) and self.getOrDefault(p) for p in (self.weightCol, self.validationIndicatorCol)))

    def _fit_java(self, dataset):
        if not self._packed():
            return super()._fit_java(dataset)
        spark = dataset.sparkSession
        ready(spark)
        self._transfer_params_to_java()
        self._java_obj.transformSchema(dataset._jdf.schema())
        rows = _run_once(dataset.select(self.getFeaturesCol(), self.getLabelCol()))
        layout, count = self._layout(rows)
        bits = (count - 1).bit_length()
        # Targets are below 4: sums of a block stay under 2^53, of all rows under 2^62.
        scale, scale2 = min(34, 59 - bits), min(32, 57 - bits)
        search = _Search(layout, scale, scale2, self.getMinInstancesPerNode(), self.getMinInfoGain())
        x = vector_to_array(F.col(self.getFeaturesCol()))
        batch = max(1, BATCH_BYTES // (8 * len(layout.bins)))
        block = max(1, min(BLOCK_ROWS, BATCH_BYTES // (2 * len(layout.packs))))
        kept = _Held if count * (2 * len(layout.packs) + 9) <= HELD_BYTES else _Written
        with setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(min(batch, block))):
            blocks = kept(rows.select(x.alias("x"), F.col(self.getLabelCol()).cast("double").alias("label"))
                          .mapInArrow(_encoder(layout, block), _BLOCK))
        trees = []

        def passes(tree, nodes, depth):
            found = blocks.sums(_summer(layout, tree, nodes, depth, scale, scale2))
            return sum(np.frombuffer(r["sums"], dtype=np.int64) for r in found).reshape(3, len(nodes), -1)

        try:
            for m in range(self.getMaxIter()):
                tree, known = _grow(layout, search, passes, self.getMaxDepth())
                trees.append(known)
                if m + 1 < self.getMaxIter():
                    leaf = np.zeros(tree.size)
                    leaf[list(known)] = [s.mean for s in known.values()]
                    blocks.scored(_scorer(layout, tree, self.getMaxDepth(), leaf, self.getStepSize() if m else 1.0))
        finally:
            blocks.close()
        return self._model(spark, layout, trees)

    def _layout(self, rows: DataFrame) -> tuple[Layout, int]:
        """The library's split candidates, and the number of rows; the library's checks of both columns."""
        jvm, java = rows.sparkSession._jvm, self._java_obj
        ml, tree = jvm.org.apache.spark.ml, jvm.org.apache.spark.mllib.tree
        instances = _module(ml.util, "DatasetUtils").extractInstances(java, rows._jdf, jvm.scala.Some(2))
        kinds = ml.util.MetadataUtils.getCategoricalFeatures(rows._jdf.schema().apply(self.getFeaturesCol()))
        strategy = java.getOldBoostingStrategy(kinds, tree.configuration.Algo.Classification()).treeStrategy().copy()
        strategy.setAlgo(tree.configuration.Algo.Regression())
        strategy.setImpurity(_module(tree.impurity, "Variance"))
        about = ml.tree.impl.DecisionTreeMetadata.buildMetadata(instances, strategy, 1, "all")
        splits = _module(ml.tree.impl, "RandomForest").findSplits(instances, about, self.getSeed())
        thresholds = [np.array([s.threshold() for s in splits[f]]) if about.isContinuous(f) else None
                      for f in range(about.numFeatures())]
        bins = list(about.numBins())
        return Layout(thresholds, [bins[f] if t is None else len(t) + 1 for f, t in enumerate(thresholds)]), about.numExamples()

    def _model(self, spark, layout: Layout, trees: list[dict[int, Stats]]):
        """The library's model of the fitted trees."""
        jvm, java = spark._jvm, self._java_obj
        ml, gateway = jvm.org.apache.spark.ml, spark.sparkContext._gateway
        leaf, inner, cut, category = (getattr(ml.tree, c) for c in ("LeafNode", "InternalNode", "ContinuousSplit", "CategoricalSplit"))
        kept_sums, double = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator, jvm.double

        def doubles(values):
            out = gateway.new_array(double, len(values))
            for i, v in enumerate(values):
                out[i] = float(v)
            return out

        def node(known, i):
            s = known[i]
            kept = kept_sums(doubles([s.rows, s.total, s.squares]), s.rows)
            if s.split is None:
                return leaf(s.mean, s.impurity if s.valid else -1.0, kept), s.mean
            (left, a), (right, b) = node(known, 2 * i), node(known, 2 * i + 1)
            if a is not None and a == b:
                return leaf(a, s.impurity, kept), a
            f, threshold, categories = s.split
            split = (cut(f, threshold) if categories is None
                     else category(f, doubles(categories), layout.bins[f]))
            return inner(s.mean, s.impurity, s.gain, left, right, split, kept), None

        no_more = getattr(java, "copyValues$default$2")()
        fitted = gateway.new_array(ml.regression.DecisionTreeRegressionModel, len(trees))
        for k, known in enumerate(trees):
            one = ml.regression.DecisionTreeRegressionModel(f"dtr_{uuid.uuid4().hex[:12]}", node(known, 1)[0], len(layout.bins))
            fitted[k] = java.copyValues(one, no_more)
        weights = doubles([self.getStepSize() if k else 1.0 for k in range(len(trees))])
        model = ml.classification.GBTClassificationModel(self.uid, fitted, weights, len(layout.bins), 2)
        return java.copyValues(model.setParent(java), no_more)
