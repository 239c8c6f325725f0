"""ML feature stages and pipeline shapes (#38-#45).

The stages are ``pyspark.ml`` estimators; every fit is a distributed
aggregate (means, value counts, column summaries, the d x d covariance for
PCA).  Categorical columns are indexed and encoded with the multi-column
forms of ``StringIndexer`` / ``OneHotEncoder``: one value-count job for all of
them instead of one per column.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (PCA, Imputer, OneHotEncoder, SQLTransformer, StandardScaler,
                                StringIndexer, VectorAssembler)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K


def imputer(nums: list[str], strategy: str = "mean") -> Imputer:
    """``<c>_imputed`` = c with null and NaN replaced by the column mean (#38).
    Inputs must be double (see ``clean.numeric_as_double``)."""
    return Imputer(inputCols=nums, outputCols=[f"{c}_imputed" for c in nums], strategy=strategy)


def category_indexer(cats: list[str], handle_invalid: str = "keep") -> StringIndexer:
    """``<c>_idx``: frequency-descending, ties alphabetical; null and unseen
    values get the extra last index with ``keep`` (#39)."""
    return StringIndexer(inputCols=cats, outputCols=[f"{c}_idx" for c in cats],
                         handleInvalid=handle_invalid)


def label_indexer(target: str = K.TARGET, order: str = "frequencyDesc",
                  out: str = "label") -> StringIndexer:
    """Target -> double label; ``order`` is ``frequencyDesc`` or ``alphabetAsc`` (#40)."""
    return StringIndexer(inputCol=target, outputCol=out, stringOrderType=order)


def one_hot(cats: list[str]) -> OneHotEncoder:
    """``<c>_enc`` from ``<c>_idx``; the dropped last slot is the null/unseen
    bucket, so such rows become the all-zero vector (#41)."""
    return OneHotEncoder(inputCols=[f"{c}_idx" for c in cats], outputCols=[f"{c}_enc" for c in cats])


def assembler(inputs: list[str], out: str = "raw_features", handle_invalid: str = "error") -> VectorAssembler:
    """Vector of the inputs in order (#42)."""
    return VectorAssembler(inputCols=inputs, outputCol=out, handleInvalid=handle_invalid)


def scaler(inp: str = "raw_features", out: str = "features") -> StandardScaler:
    """Divide by the sample standard deviation, no centring (#43)."""
    return StandardScaler(inputCol=inp, outputCol=out, withStd=True, withMean=False)


def copy_column(inp: str = "raw_features", out: str = "features") -> SQLTransformer:
    """``SELECT *, inp AS out FROM __THIS__`` (#16)."""
    return SQLTransformer(statement=f"SELECT *, {inp} AS {out} FROM __THIS__")


def feature_stages(cats: list[str], nums: list[str], *, scaling: bool = True,
                   target: str = K.TARGET, label_order: str = "frequencyDesc",
                   handle_invalid: str = "error", scaled_col: str = "features",
                   raw_col: str = "raw_features") -> Pipeline:
    """One builder for the three pipeline shapes (#45):

    * class weighting: ``label_order='alphabetAsc', handle_invalid='keep'``;
    * scaling on / off: defaults, ``scaling=False`` copies raw -> features;
    * PCA base: ``scaled_col='scaled_features'``.
    """
    stages = [imputer(nums), category_indexer(cats), one_hot(cats),
              label_indexer(target, label_order),
              assembler([f"{c}_imputed" for c in nums] + [f"{c}_enc" for c in cats], raw_col,
                        handle_invalid)]
    stages.append(scaler(raw_col, scaled_col) if scaling else copy_column(raw_col, scaled_col))
    return Pipeline(stages=stages)


def fitted_labels(model: PipelineModel, out: str = "label") -> list[str]:
    """Class names of the label indexer, in index order."""
    for st in model.stages:
        if hasattr(st, "getOutputCol") and st.hasParam("outputCol") and st.isSet("outputCol") \
                and st.getOutputCol() == out and hasattr(st, "labels"):
            return list(st.labels)
    raise ValueError(f"no label indexer writing {out!r}")


def pca_fit(df: DataFrame, k: int, inp: str = "scaled_features", out: str = "features"):
    """Fit PCA with ``k`` components (#44).  The projection is not centred."""
    return PCA(k=k, inputCol=inp, outputCol=out).fit(df)


def vector_long(df: DataFrame, key: str, vec: str, nonzero: bool = True) -> DataFrame:
    """``key, slot, value`` rows of a vector column (long form, for checks)."""
    out = df.select(key, F.posexplode(vector_to_array(vec)).alias("slot", "value"))
    out = out.withColumn("slot", F.col("slot").cast("int"))
    return out.where(F.col("value") != 0) if nonzero else out
