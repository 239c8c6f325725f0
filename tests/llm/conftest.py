import pytest

from ..conftest import spark  # noqa: F401

WORDS = "the of and red fox hund katze maison être ñandú δοκιμή cat dog sun moon river stone cloud green blue".split()


def _text(seed, n):
    import random

    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(30)) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in any column, empty and long texts, ties, repeated rows, odd spaces."""
    shared = _text(99, 80)
    rows = [(i, _text(i, 5 + 7 * i), "en" if i % 3 else "de", f"s{i % 4}") for i in range(24)]
    rows += [(100, None, "en", "s1"), (101, "", "en", None), (102, " \n\t ", None, "s2"), (103, "one", "fr", "s3"),
             (104, "one two three", None, None), (None, "null id text here", "en", "s0"), (None, None, None, None),
             (105, shared, "en", "s0"), (106, "intro words " + shared + " tail words", "en", "s1"), (107, shared, "en", "s0"),
             (107, shared, "en", "s0"), (108, "same id a " + shared, "en", "s2"), (108, "same id b " + shared, "en", "s2"),
             (109, "na " * 4000, "en", "s0"), (110, _text(7, 9000), "de", "s1"), (111, "Tab\there\nLINE\nLINE\n\nline\x0bvt\x0cff\rcr", "en", "s2"),
             (112, "x" * 70000, "en", "s3"), (113, "é" * 300 + " ü", "fr", "s3"), (114, " nbsp em space", "fr", "s3"),
             (115, shared + "\n" + shared, "en", "s0"), (116, "&& ## << a b c" * 9, "en", "s0")]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):  # noqa: F811
    """The odd rows with extra columns whose names clash with outputs and keys."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(odd_rows, "doc_id long, text string, lang string, source string").repartition(3)
    return df.select("*", F.lit(7).cast("long").alias("n_words"), F.lit("x").alias("shard"), F.lit(None).cast("int").alias("size"),
                     F.lit(1).alias("key"), F.lit(2).alias("fp"), F.lit(3).alias("component_id"), F.lit(True).alias("kept"))


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
