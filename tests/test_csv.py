import csv
import glob

from sparkfeat.sources.csv import read_csv_quoted, write_csv_quoted


VALUES = ["plain", "two\nlines", "cr\rlf\r\n end\n", " lead", "trail ", "\ttab\t", 'say "hi"', '"', '""', "", None, "a,b", ",", "\\", "\\N", "back\\\"slash",
          "null", "#no comment", "é 日本 \u2028", " ", "\n", "\x00nul", "x" * 70000, "'single'"]


def test_every_value_comes_back(spark, tmp_path):
    rows = [(i, a, VALUES[(7 * i + 3) % len(VALUES)], None if i % 5 == 0 else i / 4) for i, a in enumerate(VALUES * 3)] + [(None, None, None, None)]
    df = spark.createDataFrame(rows, "id int, a string, b string, x double").withColumnRenamed("b", 'b, "c"').repartition(4)
    path = write_csv_quoted(df, str(tmp_path / "c"))
    back = read_csv_quoted(spark, path, df.schema)
    assert back.columns == df.columns
    key = str
    assert sorted(map(tuple, back.collect()), key=key) == sorted(rows, key=key)


def test_other_readers_agree(spark, tmp_path):
    """Python's csv module reads the same texts (it has no null)."""
    rows = [(i, v) for i, v in enumerate(VALUES) if v is None or "\x00" not in v]
    path = write_csv_quoted(spark.createDataFrame(rows, "id int, v string").coalesce(1), str(tmp_path / "d"))
    (name,) = glob.glob(f"{path}/part-*")
    with open(name, newline="", encoding="utf-8") as f:
        got = list(csv.reader(f))
    assert got == [["id", "v"], *[[str(i), v or ""] for i, v in rows]]


def test_no_rows(spark, tmp_path):
    df = spark.createDataFrame([], "id int, v string")
    assert read_csv_quoted(spark, write_csv_quoted(df, str(tmp_path / "e")), df.schema).count() == 0
