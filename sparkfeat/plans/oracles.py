"""DuckDB texts for the correctness gate.

Each entry computes, on the test tables registered as views, what the Spark
query of the same name computes with the library.  Floats are rounded to six
places on both sides; counts are bigint, flags and bins int.
"""

from __future__ import annotations

# The adapter, as SQL (FIXED VALUES shared with sources/adapter.py).
ADAPTER = """
SELECT
  o.o_orderkey AS FOD_ID,
  CASE o.o_orderstatus WHEN 'F' THEN 'FED' WHEN 'O' THEN 'NONFED' ELSE 'INTERAGCY' END AS SOURCE_SYSTEM_TYPE,
  o.o_orderpriority AS SOURCE_SYSTEM,
  CASE WHEN o.o_orderkey % 31 = 0 THEN NULL ELSE r.r_name END AS NWCG_REPORTING_AGENCY,
  CAST(year(o.o_orderdate) AS BIGINT) AS FIRE_YEAR,
  CASE WHEN o.o_orderkey % 50 = 0 THEN NULL ELSE o.o_orderdate END AS DISCOVERY_DATE,
  CAST(dayofyear(o.o_orderdate) AS BIGINT) AS DISCOVERY_DOY,
  CASE WHEN o.o_orderkey % 11 = 0 THEN NULL
       WHEN o.o_orderkey % 97 = 0 THEN 'bad'
       ELSE lpad(CAST((o.o_orderkey * 37 % 25) * 100 + o.o_orderkey * 13 % 60 AS VARCHAR), 4, '0') END AS DISCOVERY_TIME,
  CAST(o.o_orderkey % 13 + 1 AS DOUBLE) AS STAT_CAUSE_CODE,
  CASE o.o_orderkey % 13 WHEN 0 THEN 'Lightning' WHEN 1 THEN 'Equipment Use' WHEN 2 THEN 'Smoking'
       WHEN 3 THEN 'Campfire' WHEN 4 THEN 'Debris Burning' WHEN 5 THEN 'Railroad' WHEN 6 THEN 'Arson'
       WHEN 7 THEN 'Children' WHEN 8 THEN 'Miscellaneous' WHEN 9 THEN 'Fireworks' WHEN 10 THEN 'Powerline'
       WHEN 11 THEN 'Structure' ELSE NULL END AS STAT_CAUSE_DESCR,
  l.last_ship AS CONT_DATE,
  CASE WHEN o.o_orderkey % 101 = 0 THEN NULL ELSE o.o_totalprice END AS FIRE_SIZE,
  CASE WHEN o.o_orderkey % 103 = 0 THEN NULL
       WHEN o.o_totalprice < 180000 THEN 'A' WHEN o.o_totalprice < 380000 THEN 'B'
       WHEN o.o_totalprice < 430000 THEN 'C' WHEN o.o_totalprice < 460000 THEN 'D'
       WHEN o.o_totalprice < 480000 THEN 'E' WHEN o.o_totalprice < 490000 THEN 'F' ELSE 'G' END AS FIRE_SIZE_CLASS,
  CASE WHEN o.o_orderkey % 107 = 0 THEN NULL ELSE 18e0 + (o.o_orderkey * 7919 % 52001) / 1e3 END AS LATITUDE,
  CASE WHEN o.o_orderkey % 109 = 0 THEN NULL ELSE -178e0 + (o.o_orderkey * 6101 % 113001) / 1e3 END AS LONGITUDE,
  CAST(c.c_custkey % 16 AS DOUBLE) AS OWNER_CODE,
  CASE WHEN c.c_custkey % 29 = 0 THEN NULL ELSE c.c_mktsegment END AS OWNER_DESCR,
  n.n_name AS STATE,
  CASE WHEN o.o_custkey % 3 = 0 THEN NULL ELSE concat('County_', CAST(o.o_custkey % 40 AS VARCHAR)) END AS COUNTY,
  CASE WHEN o.o_custkey % 3 = 0 THEN NULL ELSE lpad(CAST(o.o_custkey % 40 * 2 + 1 AS VARCHAR), 3, '0') END AS FIPS_CODE
FROM orders o
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY l_orderkey) l
  ON l.l_orderkey = o.o_orderkey
"""

BASE = f"""WITH incidents AS ({ADAPTER}),
base AS (SELECT * FROM incidents WHERE FIRE_SIZE IS NOT NULL AND LATITUDE IS NOT NULL
         AND LONGITUDE IS NOT NULL AND FIRE_SIZE_CLASS IS NOT NULL)"""

REGION = """CASE WHEN LATITUDE >= 47 AND LONGITUDE <= -120 THEN 'PNW'
     WHEN LATITUDE >= 37 AND LONGITUDE <= -120 THEN 'CA'
     WHEN LATITUDE >= 37 AND LONGITUDE <= -100 THEN 'MW'
     WHEN LATITUDE >= 37 THEN 'North'
     WHEN LONGITUDE <= -100 THEN 'SW' ELSE 'SE' END"""

SEASON = """CASE WHEN month(DISCOVERY_DATE) IN (12, 1, 2) THEN 'Winter'
     WHEN month(DISCOVERY_DATE) IN (3, 4, 5) THEN 'Spring'
     WHEN month(DISCOVERY_DATE) IN (6, 7, 8) THEN 'Summer'
     WHEN month(DISCOVERY_DATE) IN (9, 10, 11) THEN 'Fall' END"""

TIME_NUM = r"""coalesce(CASE WHEN regexp_full_match(DISCOVERY_TIME, '\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*')
     THEN TRY_CAST(trim(DISCOVERY_TIME) AS DOUBLE) END, 1200e0)"""

HOUR = f"CAST(((CAST(floor({TIME_NUM} / 100) AS BIGINT) % 24) + 24) % 24 AS INTEGER)"

DURATION = """coalesce(CAST(floor((epoch_us(CONT_DATE) - epoch_us(DISCOVERY_DATE)) / 86400000000.0) AS BIGINT), 0)"""

HUMAN = """('Arson', 'Campfire', 'Children', 'Debris Burning', 'Equipment Use',
            'Fireworks', 'Powerline', 'Railroad', 'Smoking', 'Structure')"""


def _edges(col: str) -> str:
    return f"""(SELECT list_transform(range(0, 21), lambda i: CASE WHEN i = 20 THEN mx
                  WHEN i = 0 THEN mn - (mx - mn) * 0.001 ELSE i * ((mx - mn) / 20) + mn END)
        FROM (SELECT min({col}) AS mn, max({col}) AS mx FROM base))"""


FEATURES = f"""{BASE},
filled AS (
  SELECT *,
    CAST(month(DISCOVERY_DATE) AS INTEGER) AS discovery_month,
    CAST(isodow(DISCOVERY_DATE) - 1 AS INTEGER) AS discovery_day_of_week,
    coalesce({SEASON}, 'Unknown') AS season_f,
    {REGION} AS geographic_region,
    coalesce(SOURCE_SYSTEM_TYPE, 'Unknown') AS sst_f,
    coalesce(NWCG_REPORTING_AGENCY, 'Unknown') AS agency_f,
    coalesce(STAT_CAUSE_DESCR, 'Unknown') AS cause_f,
    coalesce(OWNER_DESCR, 'Unknown') AS owner_f,
    coalesce(STATE, 'Unknown') AS state_f,
    coalesce(COUNTY, 'Unknown') AS county_f,
    CAST(len(list_filter({_edges('LATITUDE')}, lambda z: z < LATITUDE)) - 1 AS INTEGER) AS lat_bin,
    CAST(len(list_filter({_edges('LONGITUDE')}, lambda z: z < LONGITUDE)) - 1 AS INTEGER) AS lon_bin
  FROM base)
SELECT
  FIRE_SIZE_CLASS, FOD_ID, state_f AS STATE, county_f AS COUNTY,
  discovery_month, FIRE_YEAR AS discovery_year, discovery_day_of_week,
  DISCOVERY_DOY AS discovery_day_of_year, season_f AS season,
  CAST(floor(FIRE_YEAR / 10) * 10 AS BIGINT) AS "decade",
  {DURATION} AS fire_duration_days,
  {HOUR} AS discovery_hour,
  LATITUDE, LONGITUDE, lat_bin, lon_bin, geographic_region,
  count(*) OVER (PARTITION BY lat_bin, lon_bin) AS location_fire_density,
  CAST(cause_f IN {HUMAN} AS INTEGER) AS human_caused,
  STAT_CAUSE_CODE, cause_f AS STAT_CAUSE_DESCR, sst_f AS SOURCE_SYSTEM_TYPE,
  agency_f AS NWCG_REPORTING_AGENCY, owner_f AS OWNER_DESCR,
  count(*) OVER (PARTITION BY state_f) AS state_fire_frequency,
  count(*) OVER (PARTITION BY county_f) AS county_fire_frequency,
  count(*) OVER (PARTITION BY cause_f) AS cause_frequency,
  count(*) OVER (PARTITION BY agency_f) AS agency_fire_frequency,
  FIPS_CODE, OWNER_CODE, SOURCE_SYSTEM,
  coalesce(CAST(discovery_month BETWEEN 5 AND 10 AS INTEGER), 0) AS fire_season,
  coalesce(CAST(discovery_day_of_week >= 5 AS INTEGER), 0) AS is_weekend,
  coalesce(CAST(discovery_month IN (6, 7, 8, 9) AS INTEGER), 0) AS high_risk_month,
  coalesce(CAST(discovery_month IN (7, 8, 9, 10) AS INTEGER), 0) AS drought_season
FROM filled"""

ORACLES: dict[str, str] = {}


def oracle(name: str, sql: str) -> None:
    ORACLES[name] = sql


oracle("scan_notnull", f"{BASE} SELECT * FROM base")
oracle("region_rules", f"{BASE} SELECT FOD_ID, {REGION} AS geographic_region FROM base")
oracle("frequency_encode", f"""{BASE}
SELECT FOD_ID,
  count(*) OVER (PARTITION BY coalesce(STATE, 'Unknown')) AS state_fire_frequency,
  count(*) OVER (PARTITION BY coalesce(COUNTY, 'Unknown')) AS county_fire_frequency,
  count(*) OVER (PARTITION BY coalesce(STAT_CAUSE_DESCR, 'Unknown')) AS cause_frequency,
  count(*) OVER (PARTITION BY coalesce(NWCG_REPORTING_AGENCY, 'Unknown')) AS agency_fire_frequency
FROM base""")
oracle("engineer_features", FEATURES)
oracle("stream_features", FEATURES)

# ---------------------------------------------------------------- filters, projections, fills
oracle("drop_null_target", f"""WITH incidents AS ({ADAPTER})
SELECT FOD_ID, FIRE_SIZE_CLASS FROM incidents WHERE FIRE_SIZE_CLASS IS NOT NULL""")
oracle("select_features", f"""{BASE}
SELECT FIRE_SIZE_CLASS, FOD_ID, STATE, COUNTY, LATITUDE, LONGITUDE, STAT_CAUSE_CODE, STAT_CAUSE_DESCR,
       SOURCE_SYSTEM_TYPE, NWCG_REPORTING_AGENCY, OWNER_DESCR, FIPS_CODE, OWNER_CODE, SOURCE_SYSTEM FROM base""")
oracle("fill_unknown", f"""{BASE}
SELECT FOD_ID, coalesce(SOURCE_SYSTEM_TYPE, 'Unknown') AS SOURCE_SYSTEM_TYPE,
       coalesce(NWCG_REPORTING_AGENCY, 'Unknown') AS NWCG_REPORTING_AGENCY,
       coalesce(STAT_CAUSE_DESCR, 'Unknown') AS STAT_CAUSE_DESCR, coalesce(OWNER_DESCR, 'Unknown') AS OWNER_DESCR,
       coalesce(STATE, 'Unknown') AS STATE, coalesce(COUNTY, 'Unknown') AS COUNTY FROM base""")
oracle("membership_flags", f"""{BASE}
SELECT FOD_ID, coalesce(CAST(STAT_CAUSE_DESCR IN {HUMAN} AS INTEGER), 0) AS human_caused,
       coalesce(CAST(month(DISCOVERY_DATE) IN (6, 7, 8, 9) AS INTEGER), 0) AS high_risk_month,
       coalesce(CAST(month(DISCOVERY_DATE) IN (7, 8, 9, 10) AS INTEGER), 0) AS drought_season FROM base""")
oracle("range_flags", f"""{BASE}
SELECT FOD_ID, coalesce(CAST(month(DISCOVERY_DATE) BETWEEN 5 AND 10 AS INTEGER), 0) AS fire_season,
       coalesce(CAST(isodow(DISCOVERY_DATE) - 1 >= 5 AS INTEGER), 0) AS is_weekend FROM base""")
oracle("season_lookup", f"{BASE} SELECT FOD_ID, {SEASON} AS season FROM base")
oracle("binary_label", f"""{BASE}
SELECT FOD_ID, CASE WHEN FIRE_SIZE_CLASS IN ('C', 'D', 'E', 'F', 'G') THEN 1e0 ELSE 0e0 END AS binary_label FROM base""")
oracle("sql_transform", f"{BASE} SELECT FOD_ID, LATITUDE AS latitude_copy FROM base")

# ---------------------------------------------------------------- dates, times, numbers
oracle("parse_timestamp", f"""{BASE}
SELECT FOD_ID,
  TRY_CAST(CASE WHEN FOD_ID % 7 = 0 THEN 'bad' ELSE strftime(DISCOVERY_DATE, '%Y-%m-%d') END AS TIMESTAMP) AS discovered,
  try_strptime(CASE WHEN FOD_ID % 5 = 0 THEN '31/02/2001' ELSE strftime(CONT_DATE, '%d/%m/%Y') END, '%d/%m/%Y') AS contained
FROM base""")
oracle("parse_inferred", f"""{BASE}, t AS (
  SELECT FOD_ID, CASE WHEN FOD_ID % 7 = 0 THEN strftime(DISCOVERY_DATE, '%Y-%m-%d') WHEN FOD_ID % 5 = 0 THEN '02/31/2001'
      ELSE strftime(DISCOVERY_DATE, '%m/%d/%Y') END AS us,
    CASE WHEN FOD_ID % 11 = 0 THEN '' ELSE strftime(CONT_DATE, '%d.%m.%Y') END AS eu,
    CASE WHEN FOD_ID % 13 = 0 THEN 'soon' ELSE strftime(DISCOVERY_DATE, '%b %-d, %Y %H:%M') END AS named,
    CASE WHEN FOD_ID % 2 = 0 THEN strftime(DISCOVERY_DATE, '%Y-%m-%d') ELSE strftime(CONT_DATE, '%-d %B %Y') END AS mixed FROM base
  UNION ALL SELECT 0, NULL, NULL, NULL, 'unknown'),
f AS (SELECT arg_min(us, FOD_ID) FILTER (us <> '') AS us, arg_min(eu, FOD_ID) FILTER (eu <> '') AS eu,
        arg_min(named, FOD_ID) FILTER (named <> '') AS named FROM t),
g AS (SELECT CASE WHEN try_strptime(us, '%Y-%m-%d') IS NOT NULL THEN '%Y-%m-%d' WHEN try_strptime(us, '%m/%d/%Y') IS NOT NULL THEN '%m/%d/%Y' WHEN try_strptime(us, '%d/%m/%Y') IS NOT NULL THEN '%d/%m/%Y' END AS us,
        CASE WHEN try_strptime(eu, '%m.%d.%Y') IS NOT NULL THEN '%m.%d.%Y' WHEN try_strptime(eu, '%d.%m.%Y') IS NOT NULL THEN '%d.%m.%Y' END AS eu,
        CASE WHEN try_strptime(named, '%B %d, %Y %H:%M') IS NOT NULL THEN '%B %d, %Y %H:%M' WHEN try_strptime(named, '%b %d, %Y %H:%M') IS NOT NULL THEN '%b %d, %Y %H:%M' END AS named FROM f)
SELECT t.FOD_ID, CASE WHEN g.us = '%Y-%m-%d' THEN try_strptime(t.us, '%Y-%m-%d') WHEN g.us = '%m/%d/%Y' THEN try_strptime(t.us, '%m/%d/%Y')
    ELSE try_strptime(t.us, '%d/%m/%Y') END AS us_date,
  CASE WHEN g.eu = '%m.%d.%Y' THEN try_strptime(t.eu, '%m.%d.%Y') ELSE try_strptime(t.eu, '%d.%m.%Y') END AS eu_date,
  CASE WHEN g.named = '%B %d, %Y %H:%M' THEN try_strptime(t.named, '%B %d, %Y %H:%M')
    ELSE try_strptime(t.named, '%b %d, %Y %H:%M') END AS named_date,
  coalesce(try_strptime(t.mixed, '%Y-%m-%d'), try_strptime(t.mixed, '%d %B %Y')) AS mixed_date
FROM t, g""")
oracle("date_parts", f"""{BASE}
SELECT FOD_ID, CAST(month(DISCOVERY_DATE) AS INTEGER) AS discovery_month,
       CAST(isodow(DISCOVERY_DATE) - 1 AS INTEGER) AS discovery_day_of_week,
       FIRE_YEAR AS discovery_year, DISCOVERY_DOY AS discovery_day_of_year,
       CAST(floor(FIRE_YEAR / 10) * 10 AS BIGINT) AS "decade" FROM base""")
oracle("duration_days", f"{BASE} SELECT FOD_ID, {DURATION} AS fire_duration_days FROM base")
oracle("hour_of_day", f"{BASE} SELECT FOD_ID, {TIME_NUM} AS discovery_time, {HOUR} AS discovery_hour FROM base")

# ---------------------------------------------------------------- binning, density
BINS = f"""bins AS (SELECT FOD_ID,
    CAST(len(list_filter({_edges('LATITUDE')}, lambda z: z < LATITUDE)) - 1 AS INTEGER) AS lat_bin,
    CAST(len(list_filter({_edges('LONGITUDE')}, lambda z: z < LONGITUDE)) - 1 AS INTEGER) AS lon_bin
  FROM base)"""
oracle("equal_width_bins", f"{BASE}, {BINS} SELECT FOD_ID, lat_bin, lon_bin FROM bins")
oracle("grid_density", f"""{BASE}, {BINS}
SELECT FOD_ID, count(*) OVER (PARTITION BY lat_bin, lon_bin) AS location_fire_density FROM bins""")

# ---------------------------------------------------------------- sources / sinks
oracle("dataset_shape", f"""{BASE}
SELECT count(*) AS n_rows, (SELECT CAST(count(*) AS INTEGER) FROM (DESCRIBE SELECT * FROM incidents)) AS n_columns
FROM base""")
oracle("csv_roundtrip", f"""{BASE}
SELECT CAST(FOD_ID AS INTEGER) AS FOD_ID, STATE, CAST(FIPS_CODE AS INTEGER) AS FIPS_CODE, LATITUDE, DISCOVERY_TIME
FROM base""")

oracle("csv_quoted", """
SELECT doc_id, CAST(length(t) AS BIGINT) AS n, sha256(t) AS text_sha256, lang, source FROM (
  SELECT *, CASE doc_id % 7 WHEN 0 THEN ' "' || text || '",' || chr(13) || chr(10) || ' ' WHEN 1 THEN '' WHEN 2 THEN NULL ELSE text END AS t FROM documents)""")

# ---------------------------------------------------------------- label coding and metrics
RANK = """r AS (SELECT FIRE_SIZE_CLASS, CAST(row_number() OVER (ORDER BY count(*) DESC, FIRE_SIZE_CLASS) - 1 AS DOUBLE) AS label
           FROM base GROUP BY 1),
p AS (SELECT FOD_ID, label, CAST(FOD_ID % 3 AS DOUBLE) AS prediction FROM base JOIN r USING (FIRE_SIZE_CLASS))"""
COUNTS = """m AS (SELECT r.label AS code, r.FIRE_SIZE_CLASS AS class,
    CAST((SELECT count(*) FROM p WHERE p.label = r.label AND p.prediction = r.label) AS DOUBLE) AS tp,
    CAST((SELECT count(*) FROM p WHERE p.label <> r.label AND p.prediction = r.label) AS DOUBLE) AS fp,
    CAST((SELECT count(*) FROM p WHERE p.label = r.label AND p.prediction <> r.label) AS DOUBLE) AS fn
  FROM r),
s AS (SELECT class, tp, fn,
    CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS precision,
    CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS recall FROM m),
f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM s)"""

oracle("label_decode", f"""{BASE}, {RANK}
SELECT p.FOD_ID, coalesce(r2.FIRE_SIZE_CLASS, 'N/A') AS name
FROM p LEFT JOIN r AS r2 ON r2.label = CAST(p.FOD_ID % 9 AS DOUBLE)""")
oracle("class_distribution", f"""{BASE}
SELECT CAST(dense_rank() OVER (ORDER BY FIRE_SIZE_CLASS) - 1 AS DOUBLE) AS label, count(*) AS count
FROM base GROUP BY FIRE_SIZE_CLASS""")
oracle("confusion_long", f"{BASE}, {RANK} SELECT label, prediction, count(*) AS count FROM p GROUP BY 1, 2")
oracle("confusion_wide", f"""{BASE}, {RANK}
SELECT rt.FIRE_SIZE_CLASS AS label,
  count(*) FILTER (WHERE rp.FIRE_SIZE_CLASS = 'A') AS "A", count(*) FILTER (WHERE rp.FIRE_SIZE_CLASS = 'B') AS "B",
  count(*) FILTER (WHERE rp.FIRE_SIZE_CLASS = 'C') AS "C", count(*) FILTER (WHERE rp.FIRE_SIZE_CLASS = 'D') AS "D",
  count(*) FILTER (WHERE rp.FIRE_SIZE_CLASS = 'E') AS "E", count(*) FILTER (WHERE rp.FIRE_SIZE_CLASS = 'F') AS "F",
  count(*) FILTER (WHERE rp.FIRE_SIZE_CLASS = 'G') AS "G", count(*) FILTER (WHERE rp.FIRE_SIZE_CLASS IS NULL) AS "N/A"
FROM p JOIN r AS rt ON p.label = rt.label LEFT JOIN r AS rp ON p.prediction = rp.label GROUP BY 1""")
oracle("per_class_metrics", f"""{BASE}, {RANK}, {COUNTS}
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM f""")
oracle("accuracy_f1", f"""{BASE}, {RANK}, {COUNTS}
SELECT round(sum(tp) / sum(tp + fn), 6) AS accuracy, round(sum(f1 * (tp + fn)) / sum(tp + fn), 6) AS f1_weighted FROM f""")
oracle("class_weights", f"""{BASE}
SELECT FOD_ID, round((SELECT count(*) FROM base)::DOUBLE / ((SELECT count(DISTINCT FIRE_SIZE_CLASS) FROM base)
       * count(*) OVER (PARTITION BY FIRE_SIZE_CLASS)), 6) AS weight FROM base""")
oracle("hash_split", f"""{BASE}
SELECT FOD_ID, CAST(CAST(('0x' || substr(md5(CAST(FOD_ID AS VARCHAR)), 1, 8)) AS BIGINT) % 10000 < 8000 AS INTEGER) AS is_train
FROM base""")

oracle("model_test_part", f"""{BASE}, cls AS (SELECT FIRE_SIZE_CLASS AS c, row_number() OVER (ORDER BY FIRE_SIZE_CLASS) - 1 AS label
  FROM base WHERE FIRE_SIZE_CLASS IS NOT NULL GROUP BY 1)
SELECT FOD_ID, CAST(label AS INTEGER) AS label FROM base JOIN cls ON FIRE_SIZE_CLASS = c
WHERE NOT CAST(('0x' || substr(md5(CAST(FOD_ID AS VARCHAR)), 1, 8)) AS BIGINT) % 10000 < 8000""")

# ---------------------------------------------------------------- ML feature stages
ML = f"""{BASE}, ml AS (SELECT *, TRY_CAST(FIPS_CODE AS DOUBLE) AS fips,
    CASE WHEN regexp_full_match(DISCOVERY_TIME, '\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?\\s*')
         THEN TRY_CAST(trim(DISCOVERY_TIME) AS DOUBLE) END AS tnum FROM base)"""


def _index(col: str, name: str) -> str:
    return f"""{name} AS (SELECT {col} AS v, row_number() OVER (ORDER BY count(*) DESC, {col}) - 1 AS k
        FROM base WHERE {col} IS NOT NULL GROUP BY 1)"""


oracle("impute_mean", f"""{ML}
SELECT FOD_ID, round(coalesce(fips, avg(fips) OVER ()), 6) AS FIPS_CODE_imputed,
       round(coalesce(tnum, avg(tnum) OVER ()), 6) AS discovery_time_num_imputed FROM ml""")
oracle("category_index", f"""{BASE}, {_index('OWNER_DESCR', 'io')}, {_index('NWCG_REPORTING_AGENCY', 'ia')}
SELECT FOD_ID, CAST(coalesce(io.k, (SELECT count(*) FROM io)) AS DOUBLE) AS OWNER_DESCR_idx,
       CAST(coalesce(ia.k, (SELECT count(*) FROM ia)) AS DOUBLE) AS NWCG_REPORTING_AGENCY_idx
FROM base LEFT JOIN io ON base.OWNER_DESCR = io.v LEFT JOIN ia ON base.NWCG_REPORTING_AGENCY = ia.v""")
oracle("category_index_table", f"""{BASE}, {_index('STATE', 'ist')}, {_index('COUNTY', 'ico')}
SELECT FOD_ID, CAST(coalesce(ist.k, (SELECT count(*) FROM ist)) AS DOUBLE) AS STATE_idx,
       CAST(coalesce(ico.k, (SELECT count(*) FROM ico)) AS DOUBLE) AS COUNTY_idx
FROM base LEFT JOIN ist ON base.STATE = ist.v LEFT JOIN ico ON base.COUNTY = ico.v""")
oracle("label_index", f"""{BASE}, {RANK}
SELECT FOD_ID, label AS label_freq,
       CAST(dense_rank() OVER (ORDER BY FIRE_SIZE_CLASS) - 1 AS DOUBLE) AS label_alpha
FROM base JOIN r USING (FIRE_SIZE_CLASS)""")
oracle("one_hot", f"""{BASE}, {_index('OWNER_DESCR', 'io')}
SELECT FOD_ID, CAST(k AS INTEGER) AS slot, 1e0 AS value FROM base JOIN io ON base.OWNER_DESCR = io.v""")
oracle("assemble", f"""{BASE}, {_index('OWNER_DESCR', 'io')}
SELECT FOD_ID, 0 AS slot, LATITUDE AS value FROM base WHERE LATITUDE <> 0
UNION ALL SELECT FOD_ID, 1 AS slot, OWNER_CODE AS value FROM base WHERE OWNER_CODE <> 0
UNION ALL SELECT FOD_ID, CAST(2 + k AS INTEGER) AS slot, 1e0 AS value FROM base JOIN io ON base.OWNER_DESCR = io.v""")
oracle("standard_scale", f"""{BASE}
SELECT FOD_ID, round(LATITUDE / stddev_samp(LATITUDE) OVER (), 6) AS latitude_scaled,
       round(LONGITUDE / stddev_samp(LONGITUDE) OVER (), 6) AS longitude_scaled FROM base""")
oracle("pipeline_features", f"""{ML}, t AS (SELECT * FROM ml WHERE FIRE_SIZE_CLASS IS NOT NULL),
cls AS (SELECT FIRE_SIZE_CLASS AS c, row_number() OVER (ORDER BY FIRE_SIZE_CLASS) - 1 AS label FROM t GROUP BY 1),
io AS (SELECT OWNER_DESCR AS v, row_number() OVER (ORDER BY count(*) DESC, OWNER_DESCR) - 1 AS k, count(*) AS n
  FROM t WHERE OWNER_DESCR IS NOT NULL GROUP BY 1),
ia AS (SELECT NWCG_REPORTING_AGENCY AS v, row_number() OVER (ORDER BY count(*) DESC, NWCG_REPORTING_AGENCY) - 1 AS k, count(*) AS n
  FROM t WHERE NWCG_REPORTING_AGENCY IS NOT NULL GROUP BY 1),
size AS (SELECT CAST(count(*) AS DOUBLE) AS total, (SELECT count(*) FROM io) AS owners FROM t),
filled AS (SELECT FOD_ID, FIRE_SIZE_CLASS, OWNER_DESCR, NWCG_REPORTING_AGENCY,
  coalesce(fips, avg(fips) OVER ()) AS f, coalesce(tnum, avg(tnum) OVER ()) AS h FROM t),
slots AS (
  SELECT FOD_ID, FIRE_SIZE_CLASS, 0 AS slot, f / stddev_samp(f) OVER () AS value FROM filled
  UNION ALL SELECT FOD_ID, FIRE_SIZE_CLASS, 1, h / stddev_samp(h) OVER () FROM filled
  UNION ALL SELECT FOD_ID, FIRE_SIZE_CLASS, 2 + k, CASE WHEN n = total THEN 0 ELSE 1 / sqrt(n * (total - n) / (total * (total - 1))) END
    FROM filled JOIN io ON OWNER_DESCR = io.v, size
  UNION ALL SELECT FOD_ID, FIRE_SIZE_CLASS, 2 + owners + k, CASE WHEN n = total THEN 0 ELSE 1 / sqrt(n * (total - n) / (total * (total - 1))) END
    FROM filled JOIN ia ON NWCG_REPORTING_AGENCY = ia.v, size)
SELECT FOD_ID, CAST(label AS INTEGER) AS label, CAST(slot AS INTEGER) AS slot, round(value, 6) AS value
FROM slots JOIN cls ON FIRE_SIZE_CLASS = c WHERE value <> 0""")
oracle("pca_explained", f"""{BASE},
c AS (SELECT var_samp(LATITUDE) a, var_samp(LONGITUDE) d, covar_samp(LATITUDE, LONGITUDE) b FROM base)
SELECT 1 AS k, round(((a + d) / 2 + sqrt(((a - d) / 2) * ((a - d) / 2) + b * b)) / (a + d), 6) AS explained_variance FROM c""")


# ---------------------------------------------------------------- statistics fitted on the training part
TRAIN = "CAST(('0x' || substr(md5(CAST(FOD_ID AS VARCHAR)), 1, 8)) AS BIGINT) % 10000 < 8000"


def _train_edges(col: str) -> str:
    return f"""(SELECT list_transform(range(0, 21), lambda i: CASE WHEN i = 20 THEN mx
                  WHEN i = 0 THEN mn - (mx - mn) * 0.001 ELSE i * ((mx - mn) / 20) + mn END)
        FROM (SELECT min({col}) AS mn, max({col}) AS mx FROM base WHERE {TRAIN}))"""


def _bounded_bin(col: str) -> str:
    k = f"len(list_filter({_train_edges(col)}, lambda z: z < {col})) - 1"
    return f"CAST(CASE WHEN {k} BETWEEN 0 AND 19 THEN {k} END AS INTEGER)"


FEATURES_TRAIN = f"""{BASE},
filled AS (
  SELECT *,
    {TRAIN} AS is_train,
    CAST(month(DISCOVERY_DATE) AS INTEGER) AS discovery_month,
    CAST(isodow(DISCOVERY_DATE) - 1 AS INTEGER) AS discovery_day_of_week,
    coalesce({SEASON}, 'Unknown') AS season_f,
    {REGION} AS geographic_region,
    coalesce(SOURCE_SYSTEM_TYPE, 'Unknown') AS sst_f,
    coalesce(NWCG_REPORTING_AGENCY, 'Unknown') AS agency_f,
    coalesce(STAT_CAUSE_DESCR, 'Unknown') AS cause_f,
    coalesce(OWNER_DESCR, 'Unknown') AS owner_f,
    coalesce(STATE, 'Unknown') AS state_f,
    coalesce(COUNTY, 'Unknown') AS county_f,
    {_bounded_bin('LATITUDE')} AS lat_bin,
    {_bounded_bin('LONGITUDE')} AS lon_bin
  FROM base),
st AS (SELECT state_f, count(*) AS n FROM filled WHERE is_train GROUP BY 1),
co AS (SELECT county_f, count(*) AS n FROM filled WHERE is_train GROUP BY 1),
ca AS (SELECT cause_f, count(*) AS n FROM filled WHERE is_train GROUP BY 1),
ag AS (SELECT agency_f, count(*) AS n FROM filled WHERE is_train GROUP BY 1),
ce AS (SELECT lat_bin, lon_bin, count(*) AS n FROM filled WHERE is_train GROUP BY 1, 2)
SELECT
  FIRE_SIZE_CLASS, FOD_ID, f.state_f AS STATE, f.county_f AS COUNTY,
  discovery_month, FIRE_YEAR AS discovery_year, discovery_day_of_week,
  DISCOVERY_DOY AS discovery_day_of_year, season_f AS season,
  CAST(floor(FIRE_YEAR / 10) * 10 AS BIGINT) AS "decade",
  {DURATION} AS fire_duration_days,
  {HOUR} AS discovery_hour,
  LATITUDE, LONGITUDE, f.lat_bin, f.lon_bin, geographic_region,
  coalesce(ce.n, 0) AS location_fire_density,
  CAST(f.cause_f IN {HUMAN} AS INTEGER) AS human_caused,
  STAT_CAUSE_CODE, f.cause_f AS STAT_CAUSE_DESCR, sst_f AS SOURCE_SYSTEM_TYPE,
  f.agency_f AS NWCG_REPORTING_AGENCY, owner_f AS OWNER_DESCR,
  st.n AS state_fire_frequency, co.n AS county_fire_frequency,
  ca.n AS cause_frequency, ag.n AS agency_fire_frequency,
  FIPS_CODE, OWNER_CODE, SOURCE_SYSTEM,
  coalesce(CAST(discovery_month BETWEEN 5 AND 10 AS INTEGER), 0) AS fire_season,
  coalesce(CAST(discovery_day_of_week >= 5 AS INTEGER), 0) AS is_weekend,
  coalesce(CAST(discovery_month IN (6, 7, 8, 9) AS INTEGER), 0) AS high_risk_month,
  coalesce(CAST(discovery_month IN (7, 8, 9, 10) AS INTEGER), 0) AS drought_season
FROM filled f
LEFT JOIN st ON f.state_f = st.state_f
LEFT JOIN co ON f.county_f = co.county_f
LEFT JOIN ca ON f.cause_f = ca.cause_f
LEFT JOIN ag ON f.agency_f = ag.agency_f
LEFT JOIN ce ON f.lat_bin = ce.lat_bin AND f.lon_bin = ce.lon_bin"""
oracle("features_fit_on_train", FEATURES_TRAIN)
