"""Fixed values of the incident data model.

Everything in this module is a FIXED VALUE: column names, category lists and
rule thresholds that must equal the source job's for results to match.  They
are listed plainly, in the order the source job declares them.
"""

# --- FIXED VALUES: raw incident columns read by the scan (declared order) ---
RAW_COLUMNS = [
    "FOD_ID", "FPA_ID", "SOURCE_SYSTEM_TYPE", "SOURCE_SYSTEM",
    "NWCG_REPORTING_AGENCY", "NWCG_REPORTING_UNIT_ID", "NWCG_REPORTING_UNIT_NAME",
    "SOURCE_REPORTING_UNIT", "SOURCE_REPORTING_UNIT_NAME",
    "LOCAL_FIRE_REPORT_ID", "LOCAL_INCIDENT_ID", "FIRE_CODE", "FIRE_NAME",
    "ICS_209_INCIDENT_NUMBER", "ICS_209_NAME", "MTBS_ID", "MTBS_FIRE_NAME",
    "COMPLEX_NAME", "FIRE_YEAR", "DISCOVERY_DATE", "DISCOVERY_DOY", "DISCOVERY_TIME",
    "STAT_CAUSE_CODE", "STAT_CAUSE_DESCR", "CONT_DATE", "CONT_DOY", "CONT_TIME",
    "FIRE_SIZE", "FIRE_SIZE_CLASS", "LATITUDE", "LONGITUDE",
    "OWNER_CODE", "OWNER_DESCR", "STATE", "COUNTY", "FIPS_CODE", "FIPS_NAME",
]

# --- FIXED VALUES: numeric raw columns and their Spark types (text input is cast by name) ---
RAW_NUMERIC_TYPES = {
    "FOD_ID": "bigint", "FIRE_YEAR": "bigint", "DISCOVERY_DOY": "bigint", "CONT_DOY": "bigint",
    "STAT_CAUSE_CODE": "double", "FIRE_SIZE": "double", "LATITUDE": "double", "LONGITUDE": "double",
    "OWNER_CODE": "double",
}

# --- FIXED VALUES: columns that must be non-null after the scan ---
NOT_NULL_COLUMNS = ["FIRE_SIZE", "LATITUDE", "LONGITUDE", "FIRE_SIZE_CLASS"]

TARGET = "FIRE_SIZE_CLASS"
ID_COLUMN = "FOD_ID"

# --- FIXED VALUES: categorical columns filled with 'Unknown' ---
FILL_UNKNOWN_COLUMNS = [
    "SOURCE_SYSTEM_TYPE", "NWCG_REPORTING_AGENCY", "STAT_CAUSE_DESCR",
    "OWNER_DESCR", "STATE", "COUNTY", "season", "geographic_region",
]
UNKNOWN = "Unknown"

# --- FIXED VALUES: frequency-encoded columns -> output name ---
FREQUENCY_COLUMNS = {
    "STATE": "state_fire_frequency",
    "COUNTY": "county_fire_frequency",
    "STAT_CAUSE_DESCR": "cause_frequency",
    "NWCG_REPORTING_AGENCY": "agency_fire_frequency",
}

# --- FIXED VALUES: month -> season ---
SEASON_BY_MONTH = {
    12: "Winter", 1: "Winter", 2: "Winter",
    3: "Spring", 4: "Spring", 5: "Spring",
    6: "Summer", 7: "Summer", 8: "Summer",
    9: "Fall", 10: "Fall", 11: "Fall",
}

# --- FIXED VALUES: causes counted as human-caused ---
HUMAN_CAUSES = [
    "Arson", "Campfire", "Children", "Debris Burning", "Equipment Use",
    "Fireworks", "Powerline", "Railroad", "Smoking", "Structure",
]

# --- FIXED VALUES: month lists of the risk flags ---
HIGH_RISK_MONTHS = [6, 7, 8, 9]
DROUGHT_MONTHS = [7, 8, 9, 10]
FIRE_SEASON_MONTHS = (5, 10)  # inclusive range
WEEKEND_FIRST_DAY = 5  # Monday = 0, so Saturday = 5

# --- FIXED VALUES: lenient time parse default and HHMM hour wrap ---
DEFAULT_DISCOVERY_TIME = 1200.0
HOURS_PER_DAY = 24

# --- FIXED VALUES: equal-width binning ---
N_BINS = 20
BIN_RANGE_ADJUST = 0.001  # 0.1 % of the range lowers the first edge

# --- FIXED VALUES: geographic region rules, first match wins.
# (name, min latitude or None, max longitude or None); the last rule is the default.
REGION_RULES = [
    ("PNW", 47.0, -120.0),
    ("CA", 37.0, -120.0),
    ("MW", 37.0, -100.0),
    ("North", 37.0, None),
    ("SW", None, -100.0),
]
REGION_DEFAULT = "SE"

# --- FIXED VALUES: binary target, classes counted as large fires ---
LARGE_FIRE_CLASSES = ["C", "D", "E", "F", "G"]

# --- FIXED VALUES: final feature table, declared order ---
FINAL_FEATURES = [
    "FIRE_SIZE_CLASS",
    "FOD_ID", "STATE", "COUNTY",
    "discovery_month", "discovery_year", "discovery_day_of_week",
    "discovery_day_of_year", "season", "decade", "fire_duration_days",
    "discovery_hour",
    "LATITUDE", "LONGITUDE", "lat_bin", "lon_bin",
    "geographic_region", "location_fire_density",
    "human_caused", "STAT_CAUSE_CODE", "STAT_CAUSE_DESCR",
    "SOURCE_SYSTEM_TYPE", "NWCG_REPORTING_AGENCY", "OWNER_DESCR",
    "state_fire_frequency", "county_fire_frequency", "cause_frequency",
    "agency_fire_frequency", "FIPS_CODE", "OWNER_CODE", "SOURCE_SYSTEM",
    "fire_season", "is_weekend", "high_risk_month", "drought_season",
]

# --- FIXED VALUES: model feature lists ---
CATEGORICAL_FEATURES = [
    "season", "geographic_region", "SOURCE_SYSTEM_TYPE", "NWCG_REPORTING_AGENCY",
    "STAT_CAUSE_DESCR", "OWNER_DESCR", "STATE", "SOURCE_SYSTEM",
]
NUMERIC_FEATURES = [
    "discovery_month", "discovery_year", "discovery_day_of_week",
    "discovery_day_of_year", "decade", "fire_duration_days", "discovery_hour",
    "LATITUDE", "LONGITUDE", "lat_bin", "lon_bin", "location_fire_density",
    "human_caused", "STAT_CAUSE_CODE", "FIPS_CODE", "OWNER_CODE",
    "state_fire_frequency", "county_fire_frequency", "cause_frequency",
    "agency_fire_frequency", "fire_season", "is_weekend", "high_risk_month",
    "drought_season",
]

# --- FIXED VALUES: experiment settings ---
SEED = 42
TRAIN_FRACTION = 0.8
PCA_KS = [10, 20, 30, 40, 50]
TOP_IMPORTANCES = 15
MISSING_LABEL_NAME = "N/A"
