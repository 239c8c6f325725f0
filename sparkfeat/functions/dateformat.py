"""Date formats found in the data (#18): which format reads a column of text.

The first text of a column decides the format, month before day unless that
is no date, and every other value must fit it.  Formats are Spark datetime
patterns, so a found one can be passed on wherever a format is taken.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .temporal import lenient_timestamp

# FIXED VALUES: English month names, and texts that mean "no date".
MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August",
          "September", "October", "November", "December"]
NO_DATE = ["", "NaT", "nat", "NAT", "nan", "NaN", "NAN"]

_TWO_ORDERS = ["yyyy{0}M{0}d", "M{0}d{0}yyyy", "d{0}M{0}yyyy"]
_NAMED = ["{0} d yyyy", "{0} d, yyyy", "d {0} yyyy", "d-{0}-yyyy", "yyyy-{0}-d", "yyyy {0} d"]
#: Layouts of the day, tried in this order: year first, month first, day first
#: for each separator, month names (whole before short), then bare digits.
DATE_LAYOUTS = [order.format(sep) for order in _TWO_ORDERS for sep in "-/. "] + \
    [order.format(name) for name in ("MMMM", "MMM") for order in _NAMED] + ["yyyyMMdd", "yyyy-M", "yyyy"]
#: Layouts of the time that may follow the day.
TIME_LAYOUTS = ["", " H:mm", " H:mm:ss", " H:mm:ss.SSSSSS", "'T'H:mm", "'T'H:mm:ss", "'T'H:mm:ss.SSSSSS",
                " h:mm a", " h:mm:ss a"]
# Day and time of a text whose format is its own ('T' parts them in ISO form only).
_DAY_TIME = r"^(.+?)(?:(?: |(?<=^\d{4}-\d{1,2}-\d{1,2})T)(\d{1,2}:\d\d.*))?\z"
_CLOCK_24 = r"^(?:[01]?\d|2[0-3]):[0-5]\d(?::[0-5]\d(?:\.\d{1,6})?)?\z"
_CLOCK_12 = r"(?i)^(0?[1-9]|1[0-2])(:[0-5]\d(?::[0-5]\d)?) ([ap]m)\z"

_FIELDS = {
    "yyyy": ("y", r"(?!0000)\d{4}"),
    "MMMM": ("name", "|".join(MONTHS)),
    "MMM": ("abbr", "|".join(m[:3] for m in MONTHS)),
    "MM": ("m", r"0[1-9]|1[0-2]"),
    "M": ("m", r"0?[1-9]|1[0-2]"),
    "dd": ("d", r"0[1-9]|[12]\d|3[01]"),
    "d": ("d", r"0?[1-9]|[12]\d|3[01]"),
    "H": ("h", r"[01]?\d|2[0-3]"),
    "h": ("h", r"0?[1-9]|1[0-2]"),
    "mm": ("mi", r"[0-5]\d"),
    "ss": ("s", r"[0-5]\d"),
    "SSSSSS": ("f", r"\d{1,6}"),
    "a": ("ap", "[AaPp][Mm]"),
}
_TOKEN = re.compile(r"'T'|y+|M+|d+|H+|h+|m+|s+|S+|a|[\[\]]|.")


def shape(fmt: str, named: bool = False) -> str:
    """Regular expression of the texts that ``fmt`` reads, digits counted (a
    Spark pattern alone would take ``'0001/2/2003'``).  ``named`` names the
    fields for Python."""
    out = []
    for token in _TOKEN.findall(fmt):
        if token in _FIELDS:
            name, body = _FIELDS[token]
            out.append(f"(?P<{name}>{body})" if named else f"(?:{body})")
        elif token in "[]":
            out.append("(?:" if token == "[" else ")?")
        else:
            out.append(re.escape(token.strip("'")))
    return "^" + "".join(out) + (r"\Z" if named else r"\z")


def _is_date(fields: dict) -> bool:
    month = fields.get("m") or 1
    if fields.get("name"):
        month = MONTHS.index(fields["name"]) + 1
    elif fields.get("abbr"):
        month = [m[:3] for m in MONTHS].index(fields["abbr"]) + 1
    try:
        dt.date(int(fields["y"]), int(month), int(fields.get("d") or 1))
    except ValueError:
        return False
    return True


def format_of(text: str) -> str | None:
    """The first format that reads ``text`` as a day of the calendar; None if
    none does.  ``'01/02/2003'`` is the 2nd of January, ``'13/02/2003'`` the
    13th of February.  Two-digit years, weekday names and zone offsets are not
    read; month names are capitalised."""
    text = text.strip(" ")
    for day in DATE_LAYOUTS:
        for time in TIME_LAYOUTS:
            if time and (day == "yyyy" or time.startswith("'T'") and day != "yyyy-M-d"):
                continue
            found = re.match(shape(day + time, named=True), text, re.ASCII)
            if found and _is_date(found.groupdict()):
                return day + time
    return None


def infer_formats(df: DataFrame, columns: Sequence[str], order: str) -> dict[str, list[str]]:
    """Formats for text ``columns`` of ``df``, from one aggregate: each column's
    first text by ``order`` (nulls and :data:`NO_DATE` passed over) decides.

    A column whose first text fits no format, or that has no text, gets an empty
    list: each value is read by :func:`any_timestamp` then.  Rows with a null ``order`` come first, ties
    are broken by the smaller text.  Columns of another type are left out.
    """
    if df.isStreaming:
        raise ValueError("formats cannot be inferred from a stream: infer them from a table and pass them")
    texts = [c for c in columns if isinstance(df.schema[c].dataType, T.StringType)]
    if not texts:
        return {}

    def first(c):
        value = F.trim(F.col(f"`{c}`"))
        # Only the head travels: no format is as long.
        entry = F.struct(F.col(f"`{order}`").alias("o"), F.left(value, F.lit(64)).alias("t"))
        return F.min(F.when(~value.isin(NO_DATE), entry))["t"]

    row = df.agg(*[first(c).alias(f"t{i}") for i, c in enumerate(texts)]).first()
    found = {c: row[i] and format_of(row[i]) for i, c in enumerate(texts)}
    return {c: [f] if f else [] for c, f in found.items()}


def formatted_timestamp(c: Column, formats: Sequence[str]) -> Column:
    """Timestamp (without zone) from text ``c`` by the first of ``formats`` whose
    :func:`shape` it has; other texts and impossible days give null.  Outer
    blanks are ignored, month names may be in any case.  Without formats each
    text is read by the layouts it fits."""
    if not formats:
        return any_timestamp(c)
    text = F.trim(c)
    return F.coalesce(*[F.when(text.rlike("(?i)" + shape(f)), lenient_timestamp(text, T.StringType(), f))
                        for f in formats])


def any_timestamp(c: Column) -> Column:
    """Timestamp (without zone) from text ``c``, each value by the first of
    :data:`DATE_LAYOUTS` that fits its day and a 24 or 12 hour clock after it;
    null where none fits."""
    text = F.trim(c)
    day, time = (F.regexp_extract(text, _DAY_TIME, i) for i in (1, 2))
    date = F.coalesce(*[F.when(day.rlike("(?i)" + shape(f)), F.try_to_date(day, f)) for f in DATE_LAYOUTS])
    hour = F.regexp_extract(time, _CLOCK_12, 1).try_cast("int") % 12 + \
        F.when(F.lower(F.regexp_extract(time, _CLOCK_12, 3)) == "pm", 12).otherwise(0)
    clock = F.when(time == "", "0:00").when(time.rlike(_CLOCK_24), time) \
        .when(time.rlike(_CLOCK_12), F.concat(hour.cast("string"), F.regexp_extract(time, _CLOCK_12, 2)))
    return F.concat(date.cast("string"), F.lit(" "), clock).try_cast("timestamp_ntz")


def parse_inferred(df: DataFrame, columns: Sequence[str], order: str) -> DataFrame:
    """``df`` with its text ``columns`` replaced by timestamps, each read by the
    format that :func:`infer_formats` finds; other columns stay."""
    formats = infer_formats(df, columns, order)
    return df.withColumns({c: formatted_timestamp(F.col(f"`{c}`"), f) for c, f in formats.items()}) if formats else df
