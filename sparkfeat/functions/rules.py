"""Flag, lookup and rule expressions (#10-#15).

Comparisons on null give null in SQL but False in pandas; every flag here
folds null to 0 so it matches the source job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K


def membership_flag(c: Column, values) -> Column:
    """1 if ``c`` is one of ``values``, else 0 (null -> 0)."""
    return F.coalesce(c.isin(list(values)).cast("int"), F.lit(0))


def range_flag(c: Column, lo, hi) -> Column:
    """1 if ``lo <= c <= hi``, else 0 (null -> 0)."""
    return F.coalesce(c.between(lo, hi).cast("int"), F.lit(0))


def threshold_flag(c: Column, lo) -> Column:
    """1 if ``c >= lo``, else 0 (null -> 0)."""
    return F.coalesce((c >= F.lit(lo)).cast("int"), F.lit(0))


def case(branches, default=None) -> Column:
    """One flat ``CASE WHEN c1 THEN v1 WHEN c2 THEN v2 ... ELSE default END``
    (a single expression, not a nest of CASEs), first match wins."""
    branches = list(branches)
    if not branches:
        return F.lit(default)
    out = F.when(*branches[0])
    for cond, value in branches[1:]:
        out = out.when(cond, value)
    return out if default is None else out.otherwise(F.lit(default))


def lookup(c: Column, mapping: dict, default=None) -> Column:
    """Dictionary lookup as one CASE; unmatched (and null) -> ``default``."""
    return case(((c == F.lit(k), F.lit(v)) for k, v in mapping.items()), default)


def region_of(lat: Column, lon: Column, rules=None, default: str | None = None) -> Column:
    """First matching (name, min latitude, max longitude) rule; else ``default``."""
    rules = K.REGION_RULES if rules is None else rules
    default = K.REGION_DEFAULT if default is None else default
    branches = []
    for name, min_lat, max_lon in rules:
        cond = F.lit(True)
        if min_lat is not None:
            # NaN is above every number in Spark; no comparison with it should hold.
            cond = cond & (lat >= F.lit(min_lat)) & ~F.isnan(lat.cast("double"))
        if max_lon is not None:
            cond = cond & (lon <= F.lit(max_lon))
        branches.append((cond, F.lit(name)))
    return case(branches, default)


def decode_label(code: Column, labels: list[str], default: str = K.MISSING_LABEL_NAME) -> Column:
    """Index -> name for a fitted label list; unknown codes -> ``default``."""
    return lookup(code, {float(i): name for i, name in enumerate(labels)}, default)


def binary_target(c: Column, positives=None) -> Column:
    """1.0 if ``c`` is a positive class, else 0.0 (null -> 0.0)."""
    positives = K.LARGE_FIRE_CLASSES if positives is None else positives
    return F.when(c.isin(list(positives)), F.lit(1.0)).otherwise(F.lit(0.0))
