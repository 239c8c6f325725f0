"""Incident-shaped rows built from the TPC-H-style test tables.

The test tables carry no incident data, so this adapter derives the twenty
incident columns the feature job uses from ``orders``, ``customer``,
``nation``, ``region`` and ``lineitem``.  It plants nulls, unparsable times,
hour 24 and intervals that end before they start.  The values and rules are
FIXED VALUES shared with the DuckDB oracle text in ``oracles.py``; this side is
written with DataFrame calls so that the two stay independent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rules import case

# FIXED VALUES: cause name by (order key mod 13); 12 -> null.
CAUSE_BY_MOD13 = [
    "Lightning", "Equipment Use", "Smoking", "Campfire", "Debris Burning",
    "Railroad", "Arson", "Children", "Miscellaneous", "Fireworks",
    "Powerline", "Structure",
]
# FIXED VALUES: size-class upper bounds on o_totalprice, in order; above -> 'G'.
CLASS_BOUNDS = [("A", 180000), ("B", 380000), ("C", 430000), ("D", 460000),
                ("E", 480000), ("F", 490000)]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _null_if(cond, value):
    return F.when(cond, F.lit(None)).otherwise(value)


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw incident rows (before the not-null scan filter)."""
    o = read_table(spark, sf_dir, "orders")
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    li = read_table(spark, sf_dir, "lineitem")

    # Partial aggregation collapses a hot order key map-side before the shuffle.
    last_ship = li.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last_ship"))
    # nation/region are dimension tables: the planner broadcasts them after
    # checking their file size against the broadcast threshold.
    geo = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")
    j = (o.join(c, o.o_custkey == c.c_custkey)
          .join(geo, c.c_nationkey == geo.n_nationkey)
          .join(last_ship, o.o_orderkey == last_ship.l_orderkey, "left"))

    key, cust, okey_cust = F.col("o_orderkey"), F.col("c_custkey"), F.col("o_custkey")
    price = F.col("o_totalprice")

    cause = case((key % 13 == i, F.lit(name)) for i, name in enumerate(CAUSE_BY_MOD13))
    size_class = case(((price < bound, F.lit(name)) for name, bound in CLASS_BOUNDS), "G")
    hhmm = ((key * 37) % 25) * 100 + (key * 13) % 60

    return j.select(
        key.alias("FOD_ID"),
        F.when(F.col("o_orderstatus") == "F", "FED")
         .when(F.col("o_orderstatus") == "O", "NONFED")
         .otherwise("INTERAGCY").alias("SOURCE_SYSTEM_TYPE"),
        F.col("o_orderpriority").alias("SOURCE_SYSTEM"),
        _null_if(key % 31 == 0, F.col("r_name")).alias("NWCG_REPORTING_AGENCY"),
        F.year("o_orderdate").cast("bigint").alias("FIRE_YEAR"),
        _null_if(key % 50 == 0, F.col("o_orderdate")).alias("DISCOVERY_DATE"),
        F.dayofyear("o_orderdate").cast("bigint").alias("DISCOVERY_DOY"),
        F.when(key % 11 == 0, F.lit(None).cast("string"))
         .when(key % 97 == 0, F.lit("bad"))
         .otherwise(F.lpad(hhmm.cast("string"), 4, "0")).alias("DISCOVERY_TIME"),
        (key % 13 + 1).cast("double").alias("STAT_CAUSE_CODE"),
        cause.alias("STAT_CAUSE_DESCR"),
        F.col("last_ship").alias("CONT_DATE"),
        _null_if(key % 101 == 0, price).alias("FIRE_SIZE"),
        _null_if(key % 103 == 0, size_class).alias("FIRE_SIZE_CLASS"),
        _null_if(key % 107 == 0, F.lit(18.0) + (key * 7919 % 52001) / F.lit(1e3)).alias("LATITUDE"),
        _null_if(key % 109 == 0, F.lit(-178.0) + (key * 6101 % 113001) / F.lit(1e3)).alias("LONGITUDE"),
        (cust % 16).cast("double").alias("OWNER_CODE"),
        _null_if(cust % 29 == 0, F.col("c_mktsegment")).alias("OWNER_DESCR"),
        F.col("n_name").alias("STATE"),
        _null_if(okey_cust % 3 == 0,
                 F.concat(F.lit("County_"), (okey_cust % 40).cast("string"))).alias("COUNTY"),
        _null_if(okey_cust % 3 == 0,
                 F.lpad((okey_cust % 40 * 2 + 1).cast("string"), 3, "0")).alias("FIPS_CODE"),
    )
