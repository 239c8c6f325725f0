"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

All of them read the whole test tables through the incident adapter; none
caps, samples or filters rows to stay cheap.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import rules as R
from ..functions import temporal as TM
from ..functions.dateformat import parse_inferred
from ..operators import metrics as M
from ..operators import models as MD
from ..operators import stages as S
from ..operators.binning import equal_width_bins
from ..operators.category import category_table, index_category
from ..operators.clean import drop_null_target, fill_constant, numeric_as_double, select_available
from ..operators.frequency import cell_density, frequency_encode
from ..operators.split import is_train
from ..operators.weights import attach_class_weights
from ..session import discard, materialize, scratch_path
from ..sources.adapter import incidents
from ..sources.csv import read_csv, read_csv_quoted, write_csv, write_csv_quoted
from ..sources.incidents import dataset_shape, scan_incidents
from ..streaming import stream_features
from . import experiments as X
from .features import engineer_features, fit_feature_stats, temporal_features

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__.removeprefix("q_")] = fn
    return fn


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incident rows after the not-null scan."""
    return scan_incidents(incidents(spark, sf_dir))


@query
def q_scan_notnull(spark, sf_dir):
    return base(spark, sf_dir)


@query
def q_region_rules(spark, sf_dir):
    return base(spark, sf_dir).select(
        "FOD_ID", R.region_of(F.col("LATITUDE"), F.col("LONGITUDE")).alias("geographic_region"))


@query
def q_frequency_encode(spark, sf_dir):
    cols = list(K.FREQUENCY_COLUMNS)
    df = fill_constant(base(spark, sf_dir).select("FOD_ID", *cols), {c: K.UNKNOWN for c in cols})
    return frequency_encode(df, K.FREQUENCY_COLUMNS).select("FOD_ID", *K.FREQUENCY_COLUMNS.values())


@query
def q_engineer_features(spark, sf_dir):
    return engineer_features(incidents(spark, sf_dir))


# ---------------------------------------------------------------- filters, projections, fills

RAW_CATEGORICALS = ["SOURCE_SYSTEM_TYPE", "NWCG_REPORTING_AGENCY", "STAT_CAUSE_DESCR",
                    "OWNER_DESCR", "STATE", "COUNTY"]


def _dated(spark, sf_dir):
    """Base rows with the temporal features of the feature job."""
    return temporal_features(base(spark, sf_dir))


@query
def q_drop_null_target(spark, sf_dir):
    return drop_null_target(incidents(spark, sf_dir)).select("FOD_ID", "FIRE_SIZE_CLASS")


@query
def q_select_features(spark, sf_dir):
    return select_available(base(spark, sf_dir))


@query
def q_fill_unknown(spark, sf_dir):
    df = base(spark, sf_dir).select("FOD_ID", *RAW_CATEGORICALS)
    return fill_constant(df, {c: K.UNKNOWN for c in RAW_CATEGORICALS})


@query
def q_membership_flags(spark, sf_dir):
    df = base(spark, sf_dir)
    month = TM.month_of(F.col("DISCOVERY_DATE"))
    return df.select(
        "FOD_ID",
        R.membership_flag(F.col("STAT_CAUSE_DESCR"), K.HUMAN_CAUSES).alias("human_caused"),
        R.membership_flag(month, K.HIGH_RISK_MONTHS).alias("high_risk_month"),
        R.membership_flag(month, K.DROUGHT_MONTHS).alias("drought_season"))


@query
def q_range_flags(spark, sf_dir):
    d = F.col("DISCOVERY_DATE")
    return base(spark, sf_dir).select(
        "FOD_ID",
        R.range_flag(TM.month_of(d), *K.FIRE_SEASON_MONTHS).alias("fire_season"),
        R.threshold_flag(TM.day_of_week(d), K.WEEKEND_FIRST_DAY).alias("is_weekend"))


@query
def q_season_lookup(spark, sf_dir):
    return base(spark, sf_dir).select(
        "FOD_ID", R.lookup(TM.month_of(F.col("DISCOVERY_DATE")), K.SEASON_BY_MONTH).alias("season"))


@query
def q_binary_label(spark, sf_dir):
    return base(spark, sf_dir).select("FOD_ID", R.binary_target(F.col("FIRE_SIZE_CLASS")).alias("binary_label"))


@query
def q_sql_transform(spark, sf_dir):
    df = base(spark, sf_dir).select("FOD_ID", "LATITUDE")
    return S.copy_column("LATITUDE", "latitude_copy").transform(df).select("FOD_ID", "latitude_copy")


# ---------------------------------------------------------------- dates, times, numbers
@query
def q_parse_timestamp(spark, sf_dir):
    df = base(spark, sf_dir)
    iso = F.when(F.col("FOD_ID") % 7 == 0, F.lit("bad")).otherwise(
        F.date_format("DISCOVERY_DATE", "yyyy-MM-dd"))
    dmy = F.when(F.col("FOD_ID") % 5 == 0, F.lit("31/02/2001")).otherwise(
        F.date_format("CONT_DATE", "dd/MM/yyyy"))
    df = df.select("FOD_ID", iso.alias("iso_text"), dmy.alias("dmy_text"))
    return df.select(
        "FOD_ID",
        TM.lenient_timestamp(F.col("iso_text"), df.schema["iso_text"].dataType).alias("discovered"),
        TM.lenient_timestamp(F.col("dmy_text"), df.schema["dmy_text"].dataType, "dd/MM/yyyy").alias("contained"))


@query
def q_parse_inferred(spark, sf_dir):
    """Text dates whose format nobody gives: month-first, day-first, named months
    with a time, and a column whose first text is no date (each value by its own
    format then)."""
    key, disc, cont = F.col("FOD_ID"), F.col("DISCOVERY_DATE"), F.col("CONT_DATE")
    iso = F.date_format(disc, "yyyy-MM-dd")
    text = base(spark, sf_dir).select(
        "FOD_ID",
        F.when(key % 7 == 0, iso).when(key % 5 == 0, "02/31/2001").otherwise(F.date_format(disc, "MM/dd/yyyy")).alias("us_date"),
        F.when(key % 11 == 0, "").otherwise(F.date_format(cont, "dd.MM.yyyy")).alias("eu_date"),
        F.when(key % 13 == 0, "soon").otherwise(F.date_format(disc, "MMM d, yyyy HH:mm")).alias("named_date"),
        F.when(key % 2 == 0, iso).otherwise(F.date_format(cont, "d MMMM yyyy")).alias("mixed_date"))
    # A row before all others opens the mixed column with a text that is no date.
    head = spark.createDataFrame([(0, None, None, None, "unknown")], text.schema)
    return parse_inferred(text.unionByName(head), ["us_date", "eu_date", "named_date", "mixed_date"], "FOD_ID")


@query
def q_date_parts(spark, sf_dir):
    return _dated(spark, sf_dir).select(
        "FOD_ID", "discovery_month", "discovery_day_of_week", "discovery_year",
        "discovery_day_of_year", "decade")


@query
def q_duration_days(spark, sf_dir):
    return _dated(spark, sf_dir).select("FOD_ID", "fire_duration_days")


@query
def q_hour_of_day(spark, sf_dir):
    return _dated(spark, sf_dir).select(
        "FOD_ID", F.col("DISCOVERY_TIME").alias("discovery_time"), "discovery_hour")


# ---------------------------------------------------------------- binning, density
@query
def q_equal_width_bins(spark, sf_dir):
    df = base(spark, sf_dir).select("FOD_ID", "LATITUDE", "LONGITUDE")
    return equal_width_bins(df, {"LATITUDE": "lat_bin", "LONGITUDE": "lon_bin"}).select(
        "FOD_ID", "lat_bin", "lon_bin")


@query
def q_grid_density(spark, sf_dir):
    df = base(spark, sf_dir).select("FOD_ID", "LATITUDE", "LONGITUDE")
    binned = equal_width_bins(df, {"LATITUDE": "lat_bin", "LONGITUDE": "lon_bin"})
    out = cell_density(binned, ["lat_bin", "lon_bin"], "location_fire_density", (K.N_BINS + 1) ** 2)
    return out.select("FOD_ID", "location_fire_density")


# ---------------------------------------------------------------- sources / sinks
@query
def q_dataset_shape(spark, sf_dir):
    return dataset_shape(base(spark, sf_dir))


@query
def q_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "csv")
    write_csv(base(spark, sf_dir).select("FOD_ID", "STATE", "FIPS_CODE", "LATITUDE", "DISCOVERY_TIME"), path)
    return read_csv(spark, path)


@query
def q_csv_quoted(spark, sf_dir):
    """Whole texts of ``documents`` (line breaks, quotes, blanks, nulls) through a
    CSV file and back; the digest covers every byte."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    odd = docs.withColumn("text", F.when(F.col("doc_id") % 7 == 0, F.concat(F.lit(' "'), "text", F.lit('",\r\n ')))
                          .when(F.col("doc_id") % 7 == 1, F.lit("")).when(F.col("doc_id") % 7 == 2, None).otherwise(F.col("text")))
    back = read_csv_quoted(spark, write_csv_quoted(odd, scratch_path(spark, "csv-quoted")), odd.schema)
    return back.select("doc_id", F.length("text").cast("long").alias("n"), F.sha2("text", 256).alias("text_sha256"), "lang", "source")


# ---------------------------------------------------------------- label coding and metrics


def _round(c, places=6):
    return F.round(c, places)


def rule_predictions(spark, sf_dir):
    """Indexed labels (frequency-descending) and a rule prediction ``FOD_ID % 3``:
    a deterministic scored table for the metric operators."""
    b = base(spark, sf_dir).select("FOD_ID", "FIRE_SIZE_CLASS")
    model = S.label_indexer().fit(b)
    pred = model.transform(b).select(
        "FOD_ID", "label", (F.col("FOD_ID") % 3).cast("double").alias("prediction"))
    return pred, list(model.labels)


@query
def q_label_decode(spark, sf_dir):
    pred, labels = rule_predictions(spark, sf_dir)
    return pred.select("FOD_ID", R.decode_label((F.col("FOD_ID") % 9).cast("double"), labels).alias("name"))


@query
def q_class_distribution(spark, sf_dir):
    b = base(spark, sf_dir).select("FIRE_SIZE_CLASS")
    return M.class_distribution(S.label_indexer(order="alphabetAsc").fit(b).transform(b))


@query
def q_confusion_long(spark, sf_dir):
    return M.confusion_long(rule_predictions(spark, sf_dir)[0])


@query
def q_confusion_wide(spark, sf_dir):
    pred, labels = rule_predictions(spark, sf_dir)
    return M.confusion_wide(pred, labels)


@query
def q_per_class_metrics(spark, sf_dir):
    pred, labels = rule_predictions(spark, sf_dir)
    out = M.per_class_metrics(pred, labels)
    return out.select("class", *[_round(F.col(c)).alias(c) for c in ("precision", "recall", "f1")])


@query
def q_accuracy_f1(spark, sf_dir):
    out = M.accuracy_f1(rule_predictions(spark, sf_dir)[0])
    return out.select(*[_round(F.col(c)).alias(c) for c in ("accuracy", "f1_weighted")])


@query
def q_class_weights(spark, sf_dir):
    df = base(spark, sf_dir).select("FOD_ID", "FIRE_SIZE_CLASS")
    out = attach_class_weights(df, label="FIRE_SIZE_CLASS")
    return out.select("FOD_ID", _round(F.col("weight")).alias("weight"))


@query
def q_hash_split(spark, sf_dir):
    return base(spark, sf_dir).select("FOD_ID", is_train(F.col("FOD_ID")).cast("int").alias("is_train"))


# ---------------------------------------------------------------- ML feature stages
def _ml_input(spark, sf_dir):
    df = base(spark, sf_dir)
    df = df.withColumn("discovery_time_num",
                       TM.lenient_number(F.col("DISCOVERY_TIME"), df.schema["DISCOVERY_TIME"].dataType))
    return numeric_as_double(df, ["FIPS_CODE", "discovery_time_num", "LATITUDE", "LONGITUDE", "OWNER_CODE"])


@query
def q_impute_mean(spark, sf_dir):
    df = _ml_input(spark, sf_dir)
    cols = ["FIPS_CODE", "discovery_time_num"]
    out = S.imputer(cols).fit(df).transform(df)
    return out.select("FOD_ID", *[_round(F.col(f"{c}_imputed")).alias(f"{c}_imputed") for c in cols])


@query
def q_category_index(spark, sf_dir):
    df = _ml_input(spark, sf_dir)
    cols = ["OWNER_DESCR", "NWCG_REPORTING_AGENCY"]
    return S.category_indexer(cols).fit(df).transform(df).select("FOD_ID", *[f"{c}_idx" for c in cols])


@query
def q_category_index_table(spark, sf_dir):
    """Category indexes from written index tables instead of fitted label lists."""
    df = base(spark, sf_dir).select("FOD_ID", "STATE", "COUNTY")
    for c in ("STATE", "COUNTY"):
        df = index_category(df, category_table(df, c), c)
    return df.select("FOD_ID", "STATE_idx", "COUNTY_idx")


@query
def q_label_index(spark, sf_dir):
    df = base(spark, sf_dir).select("FOD_ID", "FIRE_SIZE_CLASS")
    df = S.label_indexer(order="frequencyDesc", out="label_freq").fit(df).transform(df)
    df = S.label_indexer(order="alphabetAsc", out="label_alpha").fit(df).transform(df)
    return df.select("FOD_ID", "label_freq", "label_alpha")


def _encoded(spark, sf_dir, cols):
    df = _ml_input(spark, sf_dir)
    df = S.category_indexer(cols).fit(df).transform(df)
    return S.one_hot(cols).fit(df).transform(df)


@query
def q_one_hot(spark, sf_dir):
    return S.vector_long(_encoded(spark, sf_dir, ["OWNER_DESCR"]), "FOD_ID", "OWNER_DESCR_enc")


@query
def q_assemble(spark, sf_dir):
    df = _encoded(spark, sf_dir, ["OWNER_DESCR"])
    vec = S.assembler(["LATITUDE", "OWNER_CODE", "OWNER_DESCR_enc"], handle_invalid="keep").transform(df)
    return S.vector_long(vec, "FOD_ID", "raw_features")


@query
def q_standard_scale(spark, sf_dir):
    df = S.assembler(["LATITUDE", "LONGITUDE"]).transform(_ml_input(spark, sf_dir))
    out = S.scaler().fit(df).transform(df)
    arr = vector_to_array("features")
    return out.select("FOD_ID", _round(arr[0]).alias("latitude_scaled"), _round(arr[1]).alias("longitude_scaled"))


@query
def q_pca_explained(spark, sf_dir):
    df = S.assembler(["LATITUDE", "LONGITUDE"], out="scaled_features").transform(_ml_input(spark, sf_dir))
    ev = float(sum(S.pca_fit(df, 1).explainedVariance.toArray()))
    return spark.createDataFrame([(1, ev)], "k int, ev double").select("k", _round(F.col("ev")).alias("explained_variance"))


# ---------------------------------------------------------------- models and experiments (rows-only)

#: Least partitions of the rows to fit; more only by their number (``X.FIT_ROWS``), so
#: seeded fits do not depend on the cluster.
FIT_PARTITIONS = 8
_NO_SECONDS = ["experiment", "variant", "k", "model", "train_rows", "test_rows", "accuracy", "f1_weighted"]


def model_input(spark, sf_dir):
    """Feature table of the whole adapter, typed for the ML stages and materialised.
    The adapter's joins run once; the feature job then scans their result."""
    raw = materialize(incidents(spark, sf_dir), "incidents")
    prepared = X.prepare(engineer_features(raw))
    discard(raw)
    return prepared


def transformed(spark, sf_dir, **opts):
    df, cats, nums = model_input(spark, sf_dir)
    model = S.feature_stages(cats, nums, **opts).fit(df)
    return model, model.transform(df)


def _class_weight_parts(spark, sf_dir):
    df, cats, nums = model_input(spark, sf_dir)
    stages = S.feature_stages(cats, nums, label_order="alphabetAsc", handle_invalid="keep")
    return X._fit_transform(stages, df, "hash", K.ID_COLUMN, "all", FIT_PARTITIONS)


@query
def q_feature_stages_fit(spark, sf_dir):
    _, data = transformed(spark, sf_dir, label_order="alphabetAsc", handle_invalid="keep")
    return data.select("FOD_ID", "label", vector_to_array("features").alias("features"))


@query
def q_pipeline_features(spark, sf_dir):
    """The class-weight pipeline (imputer, indexers, one-hot, assembler, scaler)
    over two numeric and two categorical columns of the whole table, one row per
    non-zero slot of each row's scaled vector."""
    df = _ml_input(spark, sf_dir).where(F.col("FIRE_SIZE_CLASS").isNotNull())
    stages = S.feature_stages(["OWNER_DESCR", "NWCG_REPORTING_AGENCY"], ["FIPS_CODE", "discovery_time_num"],
                              label_order="alphabetAsc", handle_invalid="keep")
    out = stages.fit(df).transform(df).select("FOD_ID", F.col("label").cast("int").alias("label"), "features")
    long = out.select("FOD_ID", "label", F.posexplode(vector_to_array("features")).alias("slot", "value"))
    return long.where("value <> 0").select("FOD_ID", "label", "slot", _round(F.col("value")).alias("value"))


def _predictions(spark, sf_dir, name):
    _, _, train, test = _class_weight_parts(spark, sf_dir)
    if name == "GBT":
        _, pred = MD.fit_score(MD.classifier("GBT", label="binary_label"),
                               MD.with_binary_label(train), MD.with_binary_label(test))
        return pred.select("FOD_ID", F.col("binary_label").alias("label"), "prediction")
    _, pred = MD.fit_score(MD.classifier(name), train, test)
    return pred.select("FOD_ID", "label", "prediction")


@query
def q_model_test_part(spark, sf_dir):
    """Keys and labels that every model is scored on."""
    _, _, _, test = _class_weight_parts(spark, sf_dir)
    return test.select("FOD_ID", F.col("label").cast("int").alias("label"))


@query
def q_model_random_forest(spark, sf_dir):
    return _predictions(spark, sf_dir, "RandomForest")


@query
def q_model_decision_tree(spark, sf_dir):
    return _predictions(spark, sf_dir, "DecisionTree")


@query
def q_model_logistic(spark, sf_dir):
    return _predictions(spark, sf_dir, "LogisticRegression")


@query
def q_model_gbt_binary(spark, sf_dir):
    return _predictions(spark, sf_dir, "GBT")


@query
def q_model_weighted(spark, sf_dir):
    model, _, train, test = _class_weight_parts(spark, sf_dir)
    weighted = attach_class_weights(train, max_classes=len(S.fitted_labels(model)) + 1)
    with X.persisted(train, test):
        rows = MD.compare_models(train, test, experiment="class_weight", variant="baseline", models=MD.MULTICLASS)
        rows += MD.compare_models(weighted, test, experiment="class_weight", variant="weighted",
                                  models=MD.MULTICLASS, weight="weight")
    return spark.createDataFrame(rows, MD.COMPARISON_SCHEMA).select(*_NO_SECONDS)


@query
def q_top_importances(spark, sf_dir):
    _, data, train, _ = _class_weight_parts(spark, sf_dir)
    rf = MD.classifier("RandomForest").fit(train)
    return MD.feature_importances(rf, data)


@query
def q_compare_models(spark, sf_dir):
    df, cats, nums = model_input(spark, sf_dir)
    _, _, train, test = X._fit_transform(S.feature_stages(cats, nums), df, "hash", K.ID_COLUMN, "all", FIT_PARTITIONS)
    with X.persisted(train, test):
        rows = MD.compare_models(train, test, experiment="scaling", variant="scaled")
    return spark.createDataFrame(rows, MD.COMPARISON_SCHEMA).select(*_NO_SECONDS)


@query
def q_pca_variance(spark, sf_dir):
    df, cats, nums = model_input(spark, sf_dir)
    stages = S.feature_stages(cats, nums).getStages()[:-1] + [S.scaler("raw_features", "scaled_features")]
    base_df = Pipeline(stages=stages).fit(df).transform(df)
    ev = S.pca_fit(base_df, max(K.PCA_KS)).explainedVariance.toArray()
    return spark.createDataFrame([(k, float(sum(ev[:k]))) for k in K.PCA_KS],
                                 "k int, explained_variance double")


def _experiment(spark, sf_dir, name):
    df, cats, nums = model_input(spark, sf_dir)
    return X.EXPERIMENTS[name](df, cats, nums, fit_partitions=FIT_PARTITIONS).comparison.select(*_NO_SECONDS)


@query
def q_exp_class_weight(spark, sf_dir):
    return _experiment(spark, sf_dir, "class_weight")


@query
def q_exp_scaling(spark, sf_dir):
    return _experiment(spark, sf_dir, "scaling")


@query
def q_exp_pca(spark, sf_dir):
    return _experiment(spark, sf_dir, "pca")


# ---------------------------------------------------------------- streaming
@query
def q_stream_features(spark, sf_dir):
    """Incident rows land as parquet files; the streaming job applies the
    statistics fitted on the same rows, so it must equal the batch job."""

    source = scratch_path(spark, "stream-source")
    incidents(spark, sf_dir).write.parquet(source)
    raw = spark.read.parquet(source)
    stats = fit_feature_stats(raw)
    sink = scratch_path(spark, "stream-sink")
    q = stream_features(spark, source, raw.schema, stats, sink)
    q.awaitTermination()
    return spark.read.parquet(sink)


# ---------------------------------------------------------------- random-forest details (rows-only)
def _rf_predictions(spark, sf_dir):
    model, _, train, test = _class_weight_parts(spark, sf_dir)
    _, pred = MD.fit_score(MD.classifier("RandomForest"), train, test)
    return pred, S.fitted_labels(model)


@query
def q_rf_confusion(spark, sf_dir):
    pred, labels = _rf_predictions(spark, sf_dir)
    return M.confusion_wide(pred, labels)


@query
def q_rf_per_class(spark, sf_dir):
    pred, labels = _rf_predictions(spark, sf_dir)
    return M.per_class_metrics(pred, labels)


@query
def q_features_fit_on_train(spark, sf_dir):
    """Feature table with bins, value counts and cell counts fitted on the
    key-hash training part only, applied to every row."""
    from .features import features_fit_on_train
    return features_fit_on_train(incidents(spark, sf_dir))
