import hashlib

import pytest
from pyspark.sql import functions as F

from sparkfeat.llm import archive, queries
from sparkfeat.session import scratch_path

from ..conftest import SF_SMALL

LONG = "<p>ü" * 400


def _want(rows):
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        same = [j for j, _, h in rows if (h or "").encode() == data and j is not None]
        first = max(same, default=None)
        revisit = len(data) >= 1000 and i != first
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


ROWS = [(1, "http://a/1", LONG), (5, "http://a/5", LONG), (3, None, LONG), (2, "http://b\r\nX: y", "x" * 999), (4, "u", "x" * 999),
        (6, "u", None), (7, "u", ""), (8, "u", "a\r\n\r\nb\r\n\r\n"), (None, "n", LONG), (None, "n", "short"), (9, "u", "y" * 1000),
        (9, "u", "y" * 1000), (10, "é", "WARC/1.1\r\nWARC-Type: revisit\r\n" + "z" * 70000), (11, "u", "\r\n\r\n")]


def test_round_trip_of_odd_rows(spark):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string").withColumn("address", F.lit("x")).repartition(3)
    stored = archive.write_archive(pages, scratch_path(spark, "test-warc"))
    records = archive.read_records(spark, stored)
    got = archive.parse_records(records).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got), key=str) == _want(ROWS)
    assert spark.table(stored["payloads"]).count() == len({(h or "") for *_, h in ROWS})
    for r in records.collect():  # stated lengths are those of the record's block
        head, _, rest = bytes(r["record"]).partition(b"\r\n\r\n")
        stated = int(head.split(b"Content-Length: ")[1].split(b"\r\n")[0])
        assert len(rest) == stated + 4 and rest.endswith(b"\r\n\r\n")


def test_query_matches_brute_force(spark):
    pages = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").select("page_id", "url", "html").collect()]
    got = queries.op7_warc(spark, SF_SMALL).drop("url").collect()
    assert sorted(map(tuple, got), key=str) == _want(pages)


def test_damage_is_found(spark):
    pages = spark.createDataFrame(ROWS[:3], "page_id long, url string, html string")
    records = archive.read_records(spark, archive.write_archive(pages, scratch_path(spark, "test-warc")))
    bad = records.select(F.regexp_replace(F.decode("record", "UTF-8"), "<p>ü<p>", "<q>ü<p>").cast("binary").alias("record"))
    with pytest.raises(Exception, match="does not match"):
        archive.parse_records(bad).collect()


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    stored = archive.write_archive(pages, scratch_path(spark, "test-warc"))
    assert archive.parse_records(archive.read_records(spark, stored)).count() == 0
