"""Date, time and number parsing expressions (#18-#25).

All are built-in Catalyst expressions, so they stay inside whole-stage codegen.
Semantics follow pandas: bad input becomes null, day of week counts Monday as
0, durations are floored whole days and ``//`` / ``%`` floor toward -inf.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K

_MICROS_PER_DAY = 86_400_000_000.0
# A plain decimal or scientific number, surrounded by optional blanks.  Spark's
# cast would also take suffixes such as '1d' or words such as 'Infinity'.
_NUMBER = r"^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)\s*$"
_FRACTION_DIGITS = r"^\s*[+-]?\d*\.(\d*)"
_EXPONENT = r"[eE]([+-]?\d+)\s*$"
# pandas refuses a written exponent above this, after subtracting the digits
# that follow the decimal point ('0E309' fails, '0.1E309' parses).
_MAX_DECIMAL_EXPONENT = 308


# Microseconds per numeric unit, and the offset of the Julian day count.
_UNIT_MICROS = {"D": 86_400_000_000, "s": 1_000_000, "ms": 1_000, "us": 1}
_JULIAN_UNIX_EPOCH = 2440587.5


def _from_number(c: Column, unit: str) -> Column:
    """``timestamp_ntz`` from a number of ``unit`` since 1970-01-01
    (``'julian'``: a Julian day number), without any time zone."""
    if unit == "julian":
        days, per = c.cast("double") - F.lit(_JULIAN_UNIX_EPOCH), _UNIT_MICROS["D"]
    elif unit in _UNIT_MICROS:
        days, per = c.cast("double"), _UNIT_MICROS[unit]
    else:
        raise ValueError(f"unknown unit {unit!r}")
    micros = F.round(days * F.lit(float(per))).cast("bigint")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", micros, epoch)


def lenient_timestamp(c: Column, dtype: T.DataType, fmt: str | list[str] | tuple[str, ...] | None = None,
                      unit: str | None = None) -> Column:
    """Timestamp from ``c``; unparsable text becomes null (``errors='coerce'``).

    Timestamps pass through, dates widen to ``timestamp_ntz``.  Text is parsed
    without a time zone (``timestamp_ntz``) so day arithmetic never crosses a
    daylight-saving shift; ``fmt`` may list formats, of which the first that
    fits a value reads it.  Numbers need an explicit ``unit`` ('julian', 'D',
    's', 'ms', 'us'); without one they are refused, since reading them as
    nanoseconds would put every row in January 1970.
    """
    if isinstance(dtype, T.NumericType):
        if unit is None:
            raise TypeError(f"cannot parse a timestamp from {dtype.simpleString()} without a unit")
        return _from_number(c, unit)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return c
    if isinstance(dtype, T.DateType):
        return c.cast("timestamp_ntz")
    if isinstance(dtype, T.StringType):
        if unit is not None:
            return _from_number(c.try_cast("double"), unit)
        if fmt is None:
            return c.try_cast("timestamp_ntz")
        # try_to_timestamp validates (null for bad text); the value itself is
        # parsed without a zone, so wall-clock times never shift with DST.
        return F.coalesce(*[F.when(F.try_to_timestamp(c, F.lit(f)).isNotNull(), F.to_timestamp_ntz(c, F.lit(f)))
                            for f in ([fmt] if isinstance(fmt, str) else fmt)])
    raise TypeError(f"cannot parse a timestamp from {dtype.simpleString()} without a unit")


def month_of(ts: Column) -> Column:
    return F.month(ts)


def day_of_week(ts: Column) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(ts)


def decade_of(year: Column) -> Column:
    """``year // 10 * 10`` with floor division."""
    return (F.floor(year / F.lit(10)) * 10).cast("bigint")


def duration_days(start: Column, end: Column) -> Column:
    """Whole days from ``start`` to ``end``, floored (-6 h gives -1); null
    when either side is null."""
    micros = F.timestamp_diff("MICROSECOND", start, end)
    return F.floor(micros / F.lit(_MICROS_PER_DAY))


def lenient_number(c: Column, dtype: T.DataType, default: float | None = None) -> Column:
    """Number from ``c``; text that is not a plain number becomes ``default``
    (``pd.to_numeric(errors='coerce').fillna(default)``)."""
    if isinstance(dtype, T.NumericType):
        v = c.cast("double")
        v = F.when(F.isnan(v), F.lit(None)).otherwise(v)
    else:
        text = c.cast("string")
        v = F.regexp_extract(text, _NUMBER, 1).try_cast("double")
        exponent = F.coalesce(F.regexp_extract(text, _EXPONENT, 1).try_cast("double"), F.lit(0.0))
        fraction = F.length(F.regexp_extract(text, _FRACTION_DIGITS, 1))
        # Like pandas: an out-of-range written exponent or an overflow is no number.
        ok = (exponent - fraction <= F.lit(_MAX_DECIMAL_EXPONENT)) & ~F.isnan(v) & \
            (F.abs(v) != F.lit(float("inf")))
        v = F.when(ok, v)
    return v if default is None else F.coalesce(v, F.lit(float(default)))


def hour_of_hhmm(t: Column) -> Column:
    """``(t // 100) % 24`` with Python's non-negative modulo: 2460 -> 0, -5 -> 23."""
    return F.pmod(F.floor(t / F.lit(100.0)), F.lit(K.HOURS_PER_DAY)).cast("int")
