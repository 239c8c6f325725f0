"""Headered CSV sink (#3) and source with schema inference (#2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Write a headered CSV folder (one part file per task, no index column)."""
    df.write.mode(mode).option("header", True).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema=None, infer_schema: bool = True) -> DataFrame:
    """Read a headered CSV folder.  With ``schema`` no inference pass is made;
    without it Spark samples the files once to infer column types (text such
    as ``'063'`` becomes an int)."""
    reader = spark.read.option("header", True)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", infer_schema).csv(path)


#: What stands for null while reading; an empty unquoted field means it in the file.
_NULL = "\ue000null\ue001"

#: One set of options for both sides: quotes are doubled, blanks are kept,
#: records may span lines.
_QUOTED = {"header": True, "quote": '"', "escape": '"', "lineSep": "\n", "encoding": "UTF-8",
           "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_csv_quoted(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Write a headered CSV folder that :func:`read_csv_quoted` reads back value
    for value (RFC 4180): every text is quoted, so line breaks, quotes, commas
    and outer blanks survive and an empty text (``""``) differs from null (an
    empty field).  A table without rows has no header either."""
    texts = [c for c, kind in df.dtypes if kind == "string"]
    # Spark's writer quotes by need, which misses lone carriage returns and cannot tell '' from null under quoteAll.
    quoted = {c: F.concat(F.lit('"'), F.replace(F.col(f"`{c}`"), F.lit('"'), F.lit('""')), F.lit('"')) for c in texts}
    plain = df.select(*[(quoted[c] if c in quoted else F.col(f"`{c}`").cast("string")).alias(c) for c in df.columns])
    head = ",".join('"' + c.replace('"', '""') + '"' for c in df.columns)
    line = F.concat_ws(",", *[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in df.columns])
    # One file per task; the task's first row brings the header.
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    plain.select(F.when(first, F.concat(F.lit(head + "\n"), line)).otherwise(line).alias("value")).write.mode(mode).option("lineSep", "\n").text(path)
    return path


def read_csv_quoted(spark: SparkSession, path: str, schema) -> DataFrame:
    """Read what :func:`write_csv_quoted` wrote, or any RFC 4180 file, into
    ``schema``.  Records may span lines, so a file is read by one task: parallel
    work comes from the number of files."""
    return spark.read.options(**_QUOTED, multiLine=True, nullValue=_NULL, emptyValue="", mode="FAILFAST").schema(schema).csv(path)
