"""Equal-width binning, right-closed, pandas ``cut(x, bins=n, labels=False)`` (#26).

Edges come from one min/max aggregate; the bin id is a CASE chain over the
literal edges (codegen), so no Python runs per row.  Spark's ``Bucketizer``
and ``width_bucket`` are left-closed and are not used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from .profile import profile


def equal_width_edges(lo: float, hi: float, n_bins: int = K.N_BINS) -> list[float] | None:
    """The ``n_bins + 1`` edges pandas uses; None when the column is all null."""
    if lo is None or hi is None:
        return None
    lo, hi = float(lo), float(hi)
    if lo == hi:
        lo -= K.BIN_RANGE_ADJUST * abs(lo) if lo != 0 else K.BIN_RANGE_ADJUST
        hi += K.BIN_RANGE_ADJUST * abs(hi) if hi != 0 else K.BIN_RANGE_ADJUST
        step = (hi - lo) / n_bins
        edges = [i * step + lo for i in range(n_bins + 1)]
        edges[-1] = hi
        return edges
    step = (hi - lo) / n_bins
    edges = [i * step + lo for i in range(n_bins + 1)]
    edges[-1] = hi
    edges[0] -= (hi - lo) * K.BIN_RANGE_ADJUST
    return edges


def bin_expr(c: Column, edges: list[float] | None) -> Column:
    """Bin id ``k`` for ``edges[k] < c <= edges[k+1]``; outside, null or NaN -> null."""
    if edges is None:
        return F.lit(None).cast("int")
    # One flat CASE: at or below the first edge -> null, then the first edge
    # at or above c names the bin; above the last edge, null or NaN -> null.
    out = F.when(c <= F.lit(edges[0]), F.lit(None).cast("int"))
    for k in range(len(edges) - 1):
        out = out.when(c <= F.lit(edges[k + 1]), F.lit(k))
    return out


def fit_equal_width(df: DataFrame, cols: list[str], n_bins: int = K.N_BINS) -> dict[str, list]:
    """Edges per column from a single min/max job."""
    prof = profile(df, minmax_cols=cols)
    return {c: equal_width_edges(*prof.minmax[c], n_bins) for c in cols}


def apply_bins(df: DataFrame, edges: dict[str, list], outputs: dict[str, str]) -> DataFrame:
    return df.withColumns({outputs[c]: bin_expr(F.col(c), e) for c, e in edges.items()})


def equal_width_bins(df: DataFrame, outputs: dict[str, str], n_bins: int = K.N_BINS) -> DataFrame:
    """Fit on ``df`` and bin it: ``outputs`` maps input column -> bin column."""
    return apply_bins(df, fit_equal_width(df, list(outputs), n_bins), outputs)
