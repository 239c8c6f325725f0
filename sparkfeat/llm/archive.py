"""Content-addressed web archive.

Two Parquet stores: ``payloads`` holds the bytes of every distinct payload
once, under its SHA-256 address, bucketed by the address so that joining it
needs no shuffle of the bytes; ``headers`` holds the exact header block of
every WARC record and the address of its payload.  A record is rebuilt by
joining the two: header block, then payload, then the closing line breaks.

Records with equal payloads of at least ``MIN_REVISIT`` bytes are stored as
one response (the largest page id) and revisits that refer to it; a revisit's
header block ends with the HTTP header, which states the full payload's
length.  Digests are verified: two payloads of equal SHA-1 must have equal
SHA-256, and every payload is digested again when it is read back.

Defined cases: a null html is an empty payload; a null url is written as
``-``; line breaks in urls are percent-encoded; null page ids are written as
``null``, are smaller than any id and read back as null; rows that repeat the
largest id are all responses; an empty table gives an empty archive.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import join_hot

MIN_REVISIT = 1000
_END = "\r\n\r\n"


def _record_id(page_id) -> F.Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(">"))


def _header(page_id, url, kind, refers_to, digest, length) -> F.Column:
    """Exact header block of a record, up to the first payload byte."""
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    length.cast("string"), F.lit(_END))
    block = F.octet_length(http) + F.when(kind == "response", length).otherwise(F.lit(0))
    uri = F.replace(F.replace(F.coalesce(url, F.lit("-")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), kind, F.lit("\r\nWARC-Record-ID: "), _record_id(page_id),
        F.lit("\r\nWARC-Date: 1970-01-01T00:00:00Z\r\nWARC-Target-URI: "), uri,
        F.lit("\r\nWARC-Payload-Digest: sha1:"), digest,
        F.when(kind == "revisit", F.concat(
            F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: "),
            _record_id(refers_to))).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), block.cast("string"), F.lit(_END), http)


def _payload(html) -> F.Column:
    return F.coalesce(F.encode(html, "UTF-8"), F.lit(b""))


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                  min_revisit: int = MIN_REVISIT) -> dict[str, str]:
    """Write the archive of ``pages`` below ``path``; returns where its stores
    are.  The payload bytes are shuffled once, equal ones combined before."""
    spark = pages.sparkSession
    page = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        _payload(F.col(html_col)).alias("payload"))
    slim = materialize(page.select("page_id", "url", F.sha2("payload", 256).alias("address"), F.sha1("payload").alias("digest"),
                                   F.octet_length("payload").cast("long").alias("length")), "warc-index")
    kept = slim.groupBy("address").agg(F.max("page_id").alias("first_id"), F.min("digest").alias("lo"), F.max("digest").alias("hi"),
                                       F.min("length").alias("n"), F.max("length").alias("m"))
    kept = materialize(kept.select("address", "first_id", F.when((F.col("lo") != F.col("hi")) | (F.col("n") != F.col("m")), F.raise_error(
        F.lit("unequal digests under one address"))).otherwise(F.lit(True)).alias("same")), "warc-kept")
    clash = slim.groupBy("digest").agg(F.min("address").alias("a"), F.max("address").alias("b")).where("a <> b")
    if clash.head(1):
        raise ValueError("two payloads share a SHA-1 digest")

    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"warc_payloads_{uuid.uuid4().hex}"
    (page.groupBy(F.sha2("payload", 256).alias("address")).agg(F.max("payload").alias("payload")).repartition(buckets, "address")
     .write.bucketBy(buckets, "address").sortBy("address").option("compression", "zstd")
     .option("path", f"{path}/payloads").saveAsTable(table))

    joined = join_hot(slim, kept, ["address"])
    revisit = (F.col("length") >= min_revisit) & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    kind = F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))
    joined = joined.withColumn("kind", kind)
    (joined.select("address", "kind", _header(F.col("page_id"), F.col("url"), F.col("kind"), F.col("first_id"), F.col("digest"),
                                              F.col("length")).cast("binary").alias("header"))
     .write.option("compression", "zstd").parquet(f"{path}/headers"))
    return {"headers": f"{path}/headers", "payloads": table}


def read_records(spark: SparkSession, stored: dict[str, str]) -> DataFrame:
    """``record``: the exact bytes of every record.  Only responses need their
    payload; a payload that many responses share is shorter than
    ``MIN_REVISIT`` bytes, so the hot ones fit a broadcast."""
    headers = spark.read.parquet(stored["headers"])
    payloads = spark.table(stored["payloads"]).select("address", F.when(
        F.sha2("payload", 256) == F.col("address"), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("damaged payload "), F.col("address")))).alias("payload"))
    answers = join_hot(headers.where("kind = 'response'"), payloads, ["address"])
    tail = F.lit(_END.encode())
    return (answers.select(F.concat("header", "payload", tail).alias("record"))
            .unionByName(headers.where("kind = 'revisit'").select(F.concat("header", tail).alias("record"))))


def parse_records(records: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to, url`` as
    the records' bytes say.  A response's payload is measured and digested; its
    header must agree."""
    text = F.decode("record", "UTF-8")
    head = F.substring_index(text, _END, 1)
    field = lambda name: F.regexp_extract(F.col("head"), rf"\r\n{name}: ([^\r\n]*)", 1)
    number = lambda c: F.regexp_extract(c, r"<urn:page:(-?\d+)>", 1)
    ident = lambda c: F.when(number(c) != "", number(c).cast("long"))
    x = records.select(text.alias("text"), head.alias("head"))
    x = x.withColumn("rest", F.expr("substring(text, length(head) + 5)"))
    x = x.withColumn("http", F.substring_index("rest", _END, 1))
    x = x.withColumn("body", F.expr("substring(rest, length(http) + 5, length(rest) - length(http) - 8)").cast("binary"))
    x = x.select(ident(field("WARC-Record-ID")).alias("page_id"), field("WARC-Type").alias("record_type"),
                 field("WARC-Payload-Digest").alias("stated"), ident(field("WARC-Refers-To")).alias("refers_to"),
                 field("WARC-Target-URI").alias("url"), "body",
                 F.regexp_extract("http", r"\r\nContent-Length: (\d+)", 1).cast("long").alias("stated_length"))
    answer = F.col("record_type") == "response"
    digest = F.when(answer, F.sha1("body")).otherwise(F.expr("substring(stated, 6)"))
    length = F.when(answer, F.octet_length("body").cast("long")).otherwise(F.col("stated_length"))
    agree = (F.concat(F.lit("sha1:"), digest) == F.col("stated")) & (length == F.col("stated_length"))
    return x.select("page_id", F.when(agree, length).otherwise(F.raise_error(F.lit("a record does not match its header")).cast("long"))
                    .alias("payload_bytes"), digest.alias("payload_digest"), "record_type", "refers_to", "url")
