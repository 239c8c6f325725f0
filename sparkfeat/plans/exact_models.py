"""Trained models with an exact SQL check (#36, #46-#53).

Where a model has a closed form, SQL gives the same result without training:

* logistic regression on the one-hot of one column is saturated, so its
  probabilities are the (weighted) class shares of each category;
* a tree of depth 2 over columns of fewer than 32 values is an exhaustive search
  over midpoints (gain ties: earlier column, smaller threshold);
* boosting with stumps is one such search a round, on the rows' residuals.

All queries train on the key-hash training part.  Trees are scored, described and
ranked from their node table (``operators.forest``), not from the model object.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import temporal as TM
from ..operators import forest as FR
from ..operators import metrics as M
from ..operators import models as MD
from ..operators import stages as S
from ..operators.clean import numeric_as_double
from ..operators.split import hash_split
from ..operators.weights import attach_class_weights
from ..session import materialize
from .catalog import _round, base, query
from .oracles import BASE, HOUR, TRAIN, oracle

#: Columns of the tree checks; each has fewer than 32 values and no null.
TREE_COLUMNS = ["OWNER_CODE", "STAT_CAUSE_CODE", "discovery_hour", "FIRE_YEAR"]
CATEGORY = "SOURCE_SYSTEM_TYPE"
# FIXED VALUES: the size classes.
CLASSES = ["A", "B", "C", "D", "E", "F", "G"]


def _labelled(df):
    """``df`` with an alphabetic label, and the class names in label order."""
    model = S.label_indexer(order="alphabetAsc").fit(df)
    return model.transform(df), list(model.labels)


def _parts(spark, sf_dir, columns, stages=()):
    """(training part, other part, class names): label and feature vector, written once."""
    df = base(spark, sf_dir)
    hour = TM.hour_of_hhmm(TM.lenient_number(F.col("DISCOVERY_TIME"), df.schema["DISCOVERY_TIME"].dataType,
                                             K.DEFAULT_DISCOVERY_TIME))
    df, labels = _labelled(df.withColumn("discovery_hour", hour))
    df = numeric_as_double(df, TREE_COLUMNS)
    for stage in stages:
        df = stage.fit(df).transform(df)
    df = S.assembler(columns, "features").transform(df)
    train, test = hash_split(materialize(df.select("FOD_ID", K.TARGET, "label", "features"), "exact-input"), "FOD_ID")
    return train, test, labels


# ---------------------------------------------------------------- saturated logistic regression
def _saturated(spark, sf_dir, weighted):
    """Rows outside the training part: prediction and class probabilities of a
    logistic regression on the one-hot of ``CATEGORY``, fitted to convergence."""
    stages = [S.category_indexer([CATEGORY]), S.one_hot([CATEGORY])]
    train, test, labels = _parts(spark, sf_dir, [f"{CATEGORY}_enc"], stages)
    if weighted:
        train = attach_class_weights(train, max_classes=len(labels) + 1)
    est = MD.classifier("LogisticRegression", weight="weight" if weighted else None, maxIter=500, tol=1e-13)
    _, pred = MD.fit_score(est, train, test)
    p = vector_to_array("probability")
    return pred.select("FOD_ID", F.col("prediction").cast("int").alias("prediction"),
                       *[(_round(p[labels.index(c)], 4) if c in labels else F.lit(0.0)).alias(f"p_{c}")
                         for c in CLASSES])


@query
def q_model_logistic_saturated(spark, sf_dir):
    """Logistic regression on one categorical column; ``p_<class>`` to 4 places."""
    return _saturated(spark, sf_dir, False)


@query
def q_model_weighted_saturated(spark, sf_dir):
    """The same with balanced class weights."""
    return _saturated(spark, sf_dir, True)


# ---------------------------------------------------------------- depth-2 tree with balanced weights
def _tree(spark, sf_dir, name):
    """(node table, rows outside the training part, class names) of a depth-2
    tree with balanced weights; ``name`` RandomForest: one tree, every row once, all columns."""
    train, test, labels = _parts(spark, sf_dir, TREE_COLUMNS)
    train = attach_class_weights(train, max_classes=len(labels) + 1)
    one = {"numTrees": 1, "bootstrap": False, "featureSubsetStrategy": "all"} if name == "RandomForest" else {}
    model = MD.classifier(name, weight="weight", maxDepth=2, **one).fit(train)
    return FR.forest_nodes(model), test, labels


def _tree_scored(spark, sf_dir, name="DecisionTree"):
    nodes, test, labels = _tree(spark, sf_dir, name)
    return FR.score_forest(test, nodes), labels


def _scored_rows(pred):
    return pred.select("FOD_ID", *[F.col(c).cast("int").alias(c) for c in ("label", "prediction")])


@query
def q_model_tree_depth2(spark, sf_dir):
    """Scored rows of the tree."""
    return _scored_rows(_tree_scored(spark, sf_dir)[0])


@query
def q_model_forest_one_tree(spark, sf_dir):
    """Scored rows of the forest of one tree; equal to the tree's."""
    return _scored_rows(_tree_scored(spark, sf_dir, "RandomForest")[0])


@query
def q_forest_nodes(spark, sf_dir):
    """Node table of the forest of one tree.  ``prediction`` is set for leaves only:
    at the root balanced weights make all classes tie up to rounding."""
    nodes, _, _ = _tree(spark, sf_dir, "RandomForest")
    return nodes.select("tree", "node", "left", "right", "feature", "threshold", _round(F.col("impurity")).alias("impurity"),
                        _round(F.col("gain")).alias("gain"), "rows",
                        F.when(F.col("left") < 0, F.col("prediction").cast("int")).alias("prediction"))


@query
def q_tree_importances(spark, sf_dir):
    """Importances from the node table."""
    nodes, _, _ = _tree(spark, sf_dir, "DecisionTree")
    out = FR.node_importances(nodes, TREE_COLUMNS)
    return out.select("feature", _round(F.col("importance")).alias("importance"))


@query
def q_tree_confusion(spark, sf_dir):
    """Confusion matrix of the tree's scored rows."""
    return M.confusion_wide(*_tree_scored(spark, sf_dir))


@query
def q_tree_per_class(spark, sf_dir):
    """Precision, recall and F1 of the tree's scored rows."""
    out = M.per_class_metrics(*_tree_scored(spark, sf_dir))
    return out.select("class", *[_round(F.col(c)).alias(c) for c in ("precision", "recall", "f1")])


@query
def q_tree_accuracy(spark, sf_dir):
    """Accuracy and weighted F1 of the tree's scored rows."""
    out = M.accuracy_f1(_tree_scored(spark, sf_dir)[0])
    return out.select(*[_round(F.col(c)).alias(c) for c in ("accuracy", "f1_weighted")])


# ---------------------------------------------------------------- boosting
@query
def q_model_gbt_round(spark, sf_dir):
    """Margin and prediction after two boosting rounds of stumps on the binary target."""
    train, test, _ = _parts(spark, sf_dir, TREE_COLUMNS)
    est = MD.classifier("GBT", label="binary_label", maxIter=2, maxDepth=1)
    pred = FR.score_boosted(test, FR.forest_nodes(est.fit(MD.with_binary_label(train))))
    return pred.select("FOD_ID", _round(F.col("margin")).alias("margin"), F.col("prediction").cast("int").alias("prediction"))


# ---------------------------------------------------------------- the same in SQL
_ROWS = f"""{BASE}, cls AS (SELECT FIRE_SIZE_CLASS AS name, CAST(row_number() OVER (ORDER BY FIRE_SIZE_CLASS) - 1 AS INTEGER) AS y
  FROM base GROUP BY 1),
rows_all AS (SELECT FOD_ID, y, name, {CATEGORY} AS cat, {TRAIN} AS is_train,
    [OWNER_CODE, STAT_CAUSE_CODE, CAST({HOUR} AS DOUBLE), CAST(FIRE_YEAR AS DOUBLE)] AS x
  FROM base JOIN cls ON FIRE_SIZE_CLASS = name),
train AS (SELECT * FROM rows_all WHERE is_train),
test AS (SELECT * FROM rows_all WHERE NOT is_train),
wt AS (SELECT y, (SELECT count(*) FROM train)::DOUBLE / ((SELECT count(DISTINCT y) FROM train) * count(*)) AS w
  FROM train GROUP BY y)"""


def _saturated_sql(weight: str) -> str:
    shares = ", ".join(f"round(coalesce(max(share) FILTER (WHERE name = '{c}'), 0), 4) AS \"p_{c}\"" for c in CLASSES)
    return f"""{_ROWS},
cell AS (SELECT cat, y, name, sum({weight}) AS s FROM train JOIN wt USING (y) GROUP BY ALL),
part AS (SELECT *, s / sum(s) OVER (PARTITION BY cat) AS share,
  row_number() OVER (PARTITION BY cat ORDER BY s DESC, y) AS place FROM cell),
model AS (SELECT cat, CAST(max(y) FILTER (WHERE place = 1) AS INTEGER) AS prediction, {shares} FROM part GROUP BY cat)
SELECT FOD_ID, model.* EXCLUDE (cat) FROM test JOIN model USING (cat)"""


oracle("model_logistic_saturated", _saturated_sql("1.0::DOUBLE"))
oracle("model_weighted_saturated", _saturated_sql("w"))

# Candidate splits: midpoints between neighbouring values of the training part.
_MIDPOINTS = f"""sp AS (SELECT f, (v + nxt) / 2 AS thr FROM (
    SELECT f, v, lead(v) OVER (PARTITION BY f ORDER BY v) AS nxt
    FROM (SELECT DISTINCT unnest(range({len(TREE_COLUMNS)})) AS f, unnest(x) AS v FROM train)) WHERE nxt IS NOT NULL)"""


def _gini_level(level: int, rows: str) -> str:
    """CTEs of one tree level over ``rows`` (pos, y, w, x): class sums of every
    node and its best split; ``pos`` numbers nodes 1, 2 i, 2 i + 1."""
    return f"""
sums{level} AS (SELECT pos, y, sum(w) AS w, count(*) AS n FROM {rows} GROUP BY ALL),
stat{level} AS (SELECT pos, sum(w) AS w, CAST(sum(n) AS BIGINT) AS n, 1 - sum(w * w) / (sum(w) * sum(w)) AS gini,
  arg_min(y, (-w, y)) AS pred FROM sums{level} GROUP BY pos),
hist{level} AS (SELECT pos, f, v, y, sum(w) AS w, count(*) AS n
  FROM (SELECT pos, y, w, unnest(range({len(TREE_COLUMNS)})) AS f, unnest(x) AS v FROM {rows}) GROUP BY ALL),
left{level} AS (SELECT pos, h.f, thr, y, sum(w) AS w, sum(n) AS n FROM hist{level} h JOIN sp ON h.f = sp.f AND v <= thr GROUP BY ALL),
both{level} AS (SELECT s.pos, sp.f, sp.thr, s.w, coalesce(l.w, 0) AS lw, s.n, coalesce(l.n, 0) AS ln
  FROM sums{level} s CROSS JOIN sp LEFT JOIN left{level} l ON l.pos = s.pos AND l.f = sp.f AND l.thr = sp.thr AND l.y = s.y),
side{level} AS (SELECT pos, f, thr, sum(w) AS w, sum(lw) AS l, sum(w - lw) AS r, sum(ln) AS ln, sum(n - ln) AS rn,
  sum(w * w) AS qw, sum(lw * lw) AS ql, sum((w - lw) * (w - lw)) AS qr FROM both{level} GROUP BY ALL),
gain{level} AS (SELECT *, (1 - qw / (w * w)) - l / w * (1 - ql / (l * l)) - r / w * (1 - qr / (r * r)) AS gain
  FROM side{level} WHERE ln > 0 AND rn > 0),
best{level} AS (SELECT pos, f, thr, gain FROM gain{level} WHERE gain > 0
  QUALIFY row_number() OVER (PARTITION BY pos ORDER BY round(gain, 12) DESC, f, thr) = 1)"""


# Two leaves of one parent that predict the same become one leaf.
_TREE = f"""{_ROWS}, {_MIDPOINTS},
r0 AS (SELECT 1 AS pos, y, w, x FROM train JOIN wt USING (y)),{_gini_level(0, 'r0')},
r1 AS (SELECT CASE WHEN x[f + 1] <= thr THEN 2 ELSE 3 END AS pos, y, w, x FROM r0 JOIN best0 USING (pos)),{_gini_level(1, 'r1')},
r2 AS (SELECT pos * 2 + CASE WHEN x[f + 1] <= thr THEN 0 ELSE 1 END AS pos, y, w FROM r1 JOIN best1 USING (pos)),
sums2 AS (SELECT pos, y, sum(w) AS w, count(*) AS n FROM r2 GROUP BY ALL),
stat2 AS (SELECT pos, sum(w) AS w, CAST(sum(n) AS BIGINT) AS n, 1 - sum(w * w) / (sum(w) * sum(w)) AS gini,
  arg_min(y, (-w, y)) AS pred FROM sums2 GROUP BY pos),
cut1 AS (SELECT b.* FROM best1 b JOIN stat2 l ON l.pos = 2 * b.pos JOIN stat2 r ON r.pos = 2 * b.pos + 1 WHERE l.pred <> r.pred),
cut0 AS (SELECT b.* FROM best0 b JOIN stat1 l ON l.pos = 2 JOIN stat1 r ON r.pos = 3
  WHERE l.pred <> r.pred OR EXISTS (SELECT 1 FROM cut1)),
cut AS (SELECT * FROM cut0 UNION ALL SELECT * FROM cut1),
node AS (SELECT s.*, cut.f, cut.thr, cut.gain FROM (SELECT * FROM stat0 UNION ALL
    SELECT * FROM stat1 WHERE EXISTS (SELECT 1 FROM cut0)
    UNION ALL SELECT * FROM stat2 WHERE pos // 2 IN (SELECT pos FROM cut1)) s LEFT JOIN cut USING (pos)),
one AS (SELECT FOD_ID, y, x, coalesce((SELECT CASE WHEN x[f + 1] <= thr THEN 2 ELSE 3 END FROM cut0), 1) AS pos FROM test),
two AS (SELECT FOD_ID, y, CASE WHEN c.pos IS NULL THEN one.pos WHEN x[f + 1] <= thr THEN 2 * one.pos ELSE 2 * one.pos + 1 END AS pos
  FROM one LEFT JOIN cut1 c ON c.pos = one.pos),
scored AS (SELECT FOD_ID, CAST(y AS INTEGER) AS label, CAST(pred AS INTEGER) AS prediction FROM two JOIN node USING (pos))"""

oracle("model_tree_depth2", f"{_TREE} SELECT * FROM scored")
oracle("model_forest_one_tree", f"{_TREE} SELECT * FROM scored")
# Left subtree first: order the positions 1, 2, 4, 5, 3, 6, 7.
oracle("forest_nodes", f"""{_TREE},
numbered AS (SELECT *, row_number() OVER (ORDER BY CASE pos WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 4 THEN 3 WHEN 5 THEN 4
  WHEN 3 THEN 5 ELSE pos END) - 1 AS node FROM node)
SELECT 0 AS tree, CAST(a.node AS INTEGER) AS node, CAST(coalesce(l.node, -1) AS INTEGER) AS "left",
  CAST(coalesce(r.node, -1) AS INTEGER) AS "right", CAST(a.f AS INTEGER) AS feature, a.thr AS threshold,
  round(a.gini, 6) AS impurity, round(a.gain, 6) AS gain, a.n AS "rows",
  CASE WHEN a.f IS NULL THEN CAST(a.pred AS INTEGER) END AS prediction
FROM numbered a LEFT JOIN numbered l ON l.pos = 2 * a.pos LEFT JOIN numbered r ON r.pos = 2 * a.pos + 1""")
oracle("tree_importances", f"""{_TREE}
SELECT {repr(TREE_COLUMNS)}[f + 1] AS feature, round(sum(gain * w) / sum(sum(gain * w)) OVER (), 6) AS importance
FROM node WHERE f IS NOT NULL GROUP BY f""")

_BY_CLASS = f"""{_TREE},
counts AS (SELECT name AS class, cls.y, CAST(count(*) FILTER (WHERE label = cls.y AND prediction = cls.y) AS DOUBLE) AS tp,
    CAST(count(*) FILTER (WHERE label <> cls.y AND prediction = cls.y) AS DOUBLE) AS fp,
    CAST(count(*) FILTER (WHERE label = cls.y AND prediction <> cls.y) AS DOUBLE) AS fn
  FROM cls CROSS JOIN scored GROUP BY ALL),
pr AS (SELECT *, CASE WHEN tp > 0 THEN tp / (tp + fp) ELSE 0 END AS precision, CASE WHEN tp > 0 THEN tp / (tp + fn) ELSE 0 END AS recall
  FROM counts),
prf AS (SELECT *, CASE WHEN tp > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM pr)"""
oracle("tree_per_class", f"""{_BY_CLASS}
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM prf""")
oracle("tree_accuracy", f"""{_BY_CLASS}
SELECT round(sum(tp) / sum(tp + fn), 6) AS accuracy, round(sum(f1 * (tp + fn)) / sum(tp + fn), 6) AS f1_weighted FROM prf""")
_PREDICTED = ", ".join(f"count(*) FILTER (WHERE p.name = '{c}') AS \"{c}\"" for c in CLASSES)
oracle("tree_confusion", f"""{_TREE}
SELECT t.name AS label, {_PREDICTED}, CAST(0 AS BIGINT) AS "{K.MISSING_LABEL_NAME}"
FROM scored JOIN cls t ON t.y = label JOIN cls p ON p.y = prediction GROUP BY 1""")


def _stump(level: int, rows: str) -> str:
    """CTEs of one regression stump over ``rows`` (t, x): the split that leaves
    least variance (most sum^2 / count), and the mean of each side."""
    return f"""
hist{level} AS (SELECT f, v, sum(t) AS s, count(*) AS n
  FROM (SELECT t, unnest(range({len(TREE_COLUMNS)})) AS f, unnest(x) AS v FROM {rows}) GROUP BY ALL),
side{level} AS (SELECT h.f, thr, sum(s) FILTER (WHERE v <= thr) AS ls, sum(n) FILTER (WHERE v <= thr) AS ln,
  sum(s) FILTER (WHERE v > thr) AS rs, sum(n) FILTER (WHERE v > thr) AS rn FROM hist{level} h JOIN sp ON h.f = sp.f GROUP BY ALL),
stump{level} AS (SELECT f, thr, ls / ln AS lm, rs / rn AS rm FROM side{level}
  ORDER BY round(ls * ls / ln + rs * rs / rn, 9) DESC, f, thr LIMIT 1)"""


# Rounds after the first fit the negative gradient of the log loss, at step size 0.1.
oracle("model_gbt_round", f"""{_ROWS}, {_MIDPOINTS},
g0 AS (SELECT CASE WHEN name >= 'C' THEN 1e0 ELSE -1e0 END AS t, x FROM train),{_stump(0, 'g0')},
g1 AS (SELECT 4 * t / (1 + exp(2 * t * CASE WHEN x[f + 1] <= thr THEN lm ELSE rm END)) AS t, x FROM g0, stump0),{_stump(1, 'g1')},
m AS (SELECT FOD_ID, CASE WHEN x[a.f + 1] <= a.thr THEN a.lm ELSE a.rm END
    + 0.1e0 * CASE WHEN x[b.f + 1] <= b.thr THEN b.lm ELSE b.rm END AS margin FROM test, stump0 a, stump1 b)
SELECT FOD_ID, round(margin, 6) AS margin, CAST(margin > 0 AS INTEGER) AS prediction FROM m""")
