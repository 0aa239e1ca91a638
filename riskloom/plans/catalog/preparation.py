"""Scans, preparation, cleansing, encoding and features over the transactions."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions.dates import parse_hour
from riskloom.operators import cleanse, encode, features, prepare
from riskloom.operators.importance import select_features as project_features
from riskloom.plans import flows
from riskloom.plans.catalog.registry import query
from riskloom.plans.catalog.sqltext import (
    CATEGORIES,
    DATE_PARTS,
    GENDERS,
    HOUR,
    STATES,
    TIME_FEATURES,
    TOP_N,
    VALID_POINTS,
    WEEKDAY_NAMES,
    hashed,
    oracle,
    r,
    r6,
    ratio,
)
from riskloom.schema import RAW_SCHEMA, ROW_INDEX
from riskloom.session import artefact, scratch_path, write_table
from riskloom.sources import files
from riskloom.sources.transactions import read_table, transactions

_TEXT_OUT = (
    'trans_num, "first", "last", gender, street, city, state, job, dob, profile, category, merchant, ssn'
)
_TXN_OUT = ", ".join(
    r6(f.name) + f" AS {f.name}"
    if f.dataType.typeName() == "double"
    else (f"CAST({f.name} AS BIGINT) AS {f.name}" if f.name == "is_fraud" else f'"{f.name}"')
    for f in RAW_SCHEMA
)


# ---- scans and sinks


@query("scan_csv_roundtrip", oracle(f"SELECT {_TXN_OUT} FROM txn", "txn"))
def scan_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "csv")
    files.write_csv(transactions(spark, sf), path)
    return files.scan_csv(spark, path, RAW_SCHEMA)


@query("csv_to_parquet", oracle(f"SELECT {_TXN_OUT} FROM txn", "txn"))
def csv_to_parquet(spark, sf):
    source, target = scratch_path(spark, "csv-in"), scratch_path(spark, "parquet-out")
    files.write_csv(transactions(spark, sf), source)
    return files.csv_to_parquet(spark, source, target, RAW_SCHEMA)


@query("scan_pruned", "SELECT l_orderkey, l_quantity FROM lineitem")
def scan_pruned(spark, sf):
    return files.scan_parquet(spark, f"{sf}/lineitem.parquet", ["l_orderkey", "l_quantity"])


@query(
    "scan_head_n",
    "SELECT event_id, user_id, event_type, value FROM events ORDER BY event_id LIMIT 500",
)
def scan_head_n(spark, sf):
    events = read_table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    return files.head_rows(events, 500, "event_id")


@query(
    "scan_bernoulli",
    f"SELECT event_id, value FROM events WHERE {hashed('event_id', 7)} < {int(0.25 * 4294967296)}",
)
def scan_bernoulli(spark, sf):
    events = read_table(spark, sf, "events").select("event_id", "value")
    return files.bernoulli_rows(events, 0.25, "event_id", seed=7)


@query("row_count", "SELECT CAST(count(*) AS BIGINT) AS rows FROM lineitem")
def row_count(spark, sf):
    return files.row_count(read_table(spark, sf, "lineitem"))


# ---- preparation


@query("clean_text", oracle(f"SELECT {_TEXT_OUT} FROM clean", "clean"))
def clean_text(spark, sf):
    cleaned = prepare.clean_text_columns(transactions(spark, sf))
    return cleaned.select("trans_num", *prepare.text_columns(cleaned), "ssn")


@query("clean_profile", oracle("SELECT trans_num, profile FROM clean", "clean"))
def clean_profile(spark, sf):
    return prepare.clean_text_columns(transactions(spark, sf, ["trans_num", "profile"]))


@query("clean_ssn", oracle("SELECT trans_num, ssn FROM clean", "clean"))
def clean_ssn(spark, sf):
    return prepare.clean_text_columns(transactions(spark, sf, ["trans_num", "ssn"]))


@query(
    "date_parts",
    oracle(
        f"""SELECT trans_num, trans_date, {DATE_PARTS}
            FROM (SELECT *, CAST(trans_date AS DATE) AS d FROM txn)""",
        "txn",
    ),
)
def date_parts(spark, sf):
    return prepare.add_date_parts(transactions(spark, sf, ["trans_num", "trans_date"]))


@query("time_hour", oracle(f"SELECT trans_num, trans_time, {HOUR} AS trans_hour FROM txn", "txn"))
def time_hour(spark, sf):
    return prepare.add_hour(transactions(spark, sf, ["trans_num", "trans_time"]))


_POINTS = ["trans_num", "lat", "long", "merch_lat", "merch_long"]
_POINTS_SQL = f"trans_num, {r6('lat')} AS lat, {r6('long')} AS long, " + (
    f"{r6('merch_lat')} AS merch_lat, {r6('merch_long')} AS merch_long"
)


@query("geo_filter", oracle(f"SELECT {_POINTS_SQL} FROM txn WHERE {VALID_POINTS}", "txn"))
def geo_filter(spark, sf):
    return prepare.valid_coordinates(transactions(spark, sf, _POINTS))


@query(
    "transform_audit",
    oracle(
        f"""SELECT rows_in, rows_out, null_dates_in, null_times_in, date_parse_failed,
              time_parse_failed, rows_in - rows_out AS rows_removed,
              {r(f"{ratio('rows_in - rows_out', 'rows_in')} * 100", 2)} AS pct_removed
            FROM (SELECT count(*) AS rows_in, count(*) FILTER (WHERE {VALID_POINTS}) AS rows_out,
              count(*) FILTER (WHERE trans_date IS NULL) AS null_dates_in,
              count(*) FILTER (WHERE trans_time IS NULL) AS null_times_in,
              count(*) FILTER (WHERE trans_date IS NOT NULL AND TRY_CAST(trans_date AS DATE) IS NULL)
                AS date_parse_failed,
              count(*) FILTER (WHERE trans_time IS NOT NULL AND {HOUR} IS NULL) AS time_parse_failed
              FROM txn)""",
        "txn",
    ),
)
def transform_audit(spark, sf):
    return prepare.transform_audit(transactions(spark, sf, [*_POINTS, "trans_date", "trans_time"]))


@query(
    "top_n_values",
    oracle('SELECT col AS "column", value, n AS count, rnk AS rank FROM kept', "kept"),
)
def top_n_values(spark, sf):
    cleaned = prepare.clean_text_columns(transactions(spark, sf, ["job", "merchant"]))
    return prepare.top_values(cleaned, top_n=TOP_N)


@query("reduce_categories", oracle("SELECT trans_num, job, merchant FROM reduced", "reduced"))
def reduce_categories(spark, sf):
    cleaned = prepare.clean_text_columns(transactions(spark, sf, ["trans_num", "job", "merchant"]))
    return prepare.reduce_categories(cleaned, prepare.fit_top_values(cleaned, top_n=TOP_N))


@query(
    "reduction_summary",
    oracle(
        f"""SELECT col AS "column", before AS unique_before, least({TOP_N + 1}, before) AS unique_after,
              {r(f"(1 - least({TOP_N + 1}, before) / CAST(before AS DOUBLE)) * 100", 1)} AS reduction_pct
            FROM (SELECT 'job' AS col, count(DISTINCT job) AS before FROM clean
                  UNION ALL SELECT 'merchant', count(DISTINCT merchant) FROM clean)""",
        "clean",
    ),
)
def reduction_summary(spark, sf):
    cleaned = prepare.clean_text_columns(transactions(spark, sf, ["job", "merchant"]))
    return prepare.reduction_summary(cleaned, top_n=TOP_N)


# ---- cleansing

_KEY = ["trans_num", "cc_num", "amt", "merchant", "trans_date", "trans_time"]
_KEY_SQL = "cc_num, amt, merchant, trans_date, trans_time"


@query(
    "dedup_keep_first",
    oracle(
        f"""SELECT trans_num, cc_num, {r6('amt')} AS amt, merchant, trans_date, trans_time
            FROM (SELECT *, row_number() OVER (PARTITION BY {_KEY_SQL} ORDER BY trans_num) AS rn FROM txn)
            WHERE rn = 1""",
        "txn",
    ),
)
def dedup_keep_first(spark, sf):
    return cleanse.drop_duplicates_keep_first(transactions(spark, sf, _KEY))


@query(
    "duplicate_report",
    oracle(
        f"""SELECT CAST(sum(n) AS BIGINT) AS total_rows, CAST(sum(n - 1) AS BIGINT) AS duplicates,
              {r6(ratio('sum(n - 1)', 'sum(n)') + ' * 100')} AS duplicate_pct
            FROM (SELECT count(*) AS n FROM txn GROUP BY {_KEY_SQL})""",
        "txn",
    ),
)
def duplicate_report(spark, sf):
    return cleanse.duplicate_report(transactions(spark, sf, _KEY))


@query("age_feature", oracle("SELECT trans_num, raw_age AS age FROM raw_aged", "raw_aged"))
def age_feature(spark, sf):
    rows = prepare.valid_coordinates(transactions(spark, sf, [*_POINTS, "dob", "trans_date"]))
    return cleanse.add_age(rows).select("trans_num", "age")


@query("age_impute", oracle("SELECT trans_num, age FROM aged", "aged"))
def age_impute(spark, sf):
    rows = prepare.valid_coordinates(transactions(spark, sf, [*_POINTS, "dob", "trans_date"]))
    return cleanse.impute_age(cleanse.add_age(rows)).select("trans_num", "age")


_DROPPED_OUT = (
    f"gender, city, state, zip, {r6('lat')} AS lat, {r6('long')} AS long, city_pop, job, profile, category, "
    f"merchant, {r6('amt')} AS amt, CAST(is_fraud AS BIGINT) AS is_fraud"
)


@query("drop_columns", oracle(f"SELECT {_DROPPED_OUT} FROM txn", "txn"))
def drop_columns(spark, sf):
    rows = transactions(spark, sf).withColumn(ROW_INDEX[0], F.col("trans_num"))
    return cleanse.drop_columns(rows)


_FENCES = """SELECT q1, q3, q3 - q1 AS iqr, q1 - 1.5::DOUBLE * (q3 - q1) AS lo,
  q3 + 1.5::DOUBLE * (q3 - q1) AS hi
  FROM (SELECT quantile_cont(amt, 0.25) AS q1, quantile_cont(amt, 0.75) AS q3 FROM txn)"""


@query(
    "iqr_bounds",
    oracle(
        f"""SELECT {r6('q1')} AS q1, {r6('q3')} AS q3, {r6('iqr')} AS iqr, {r6('lo')} AS lower_bound,
              {r6('hi')} AS upper_bound FROM fences""",
        "txn",
        extra={"fences": _FENCES},
    ),
)
def iqr_bounds(spark, sf):
    return cleanse.iqr_bounds(transactions(spark, sf, ["amt"]))


@query(
    "outlier_filter",
    oracle(
        f"SELECT trans_num, {r6('amt')} AS amt FROM txn, fences WHERE amt >= lo AND amt <= hi",
        "txn",
        extra={"fences": _FENCES},
    ),
)
def outlier_filter(spark, sf):
    return cleanse.remove_outliers(transactions(spark, sf, ["trans_num", "amt"]))


_IMPACT = """SELECT m AS multiplier, q1 - m * iqr AS lower_bound, q3 + m * iqr AS upper_bound,
  count(*) FILTER (WHERE amt < q1 - m * iqr OR amt > q3 + m * iqr) AS rows_removed,
  CAST(sum(CASE WHEN amt < q1 - m * iqr OR amt > q3 + m * iqr THEN is_fraud ELSE 0 END) AS BIGINT)
    AS fraud_removed,
  count(*) AS n, sum(is_fraud) AS f
  FROM txn, fences, (SELECT unnest([1.5::DOUBLE, 2.0::DOUBLE, 3.0::DOUBLE]) AS m)
  GROUP BY m, q1, q3, iqr"""


@query(
    "outlier_impact",
    oracle(
        f"""SELECT multiplier, {r6('lower_bound')} AS lower_bound, {r6('upper_bound')} AS upper_bound,
              rows_removed, {r6(ratio('rows_removed', 'n') + ' * 100')} AS pct_rows, fraud_removed,
              {r6(ratio('fraud_removed', 'f') + ' * 100')} AS pct_fraud FROM impact""",
        "txn",
        extra={"fences": _FENCES, "impact": _IMPACT},
    ),
)
def outlier_impact(spark, sf):
    return cleanse.outlier_impact(transactions(spark, sf, ["amt", "is_fraud"]))


@query(
    "outlier_recommendation",
    oracle(
        f"""SELECT best AS multiplier,
              CASE WHEN best IS NULL THEN 'keep outliers' ELSE 'remove outliers' END AS advice
            FROM (SELECT min(CASE WHEN {ratio('fraud_removed', 'f')} * 100 < 5 THEN multiplier END) AS best
                  FROM impact)""",
        "txn",
        extra={"fences": _FENCES, "impact": _IMPACT},
    ),
)
def outlier_recommendation(spark, sf):
    rows = transactions(spark, sf, ["amt", "is_fraud"])
    return cleanse.outlier_recommendation(cleanse.outlier_impact(rows))


# ---- features

_KM = "2 * 6371 * atan2(sqrt(a), sqrt(1 - a))"
_CHORD = """CASE WHEN lat IS NOT NULL AND merch_lat IS NOT NULL
  THEN least(CAST(1 AS DOUBLE), pow(sin((radians(merch_lat) - radians(lat)) / 2), 2)
  + cos(radians(lat)) * cos(radians(merch_lat)) * pow(sin((radians(merch_long) - radians(long)) / 2), 2))
  END"""


@query(
    "haversine",
    oracle(
        f"""SELECT trans_num, {r6(f'coalesce({_KM}, 0)')} AS km
            FROM (SELECT trans_num, {_CHORD} AS a FROM txn)""",
        "txn",
    ),
)
def haversine(spark, sf):
    return features.add_distance(transactions(spark, sf, _POINTS)).select(
        "trans_num", F.col("distance_from_home").alias("km")
    )


@query(
    "distance_features",
    oracle(
        f"""SELECT trans_num, {r6('km')} AS distance_from_home,
              CAST(CASE WHEN km < 50 THEN 1 ELSE 0 END AS BIGINT) AS is_local_transaction
            FROM (SELECT trans_num, coalesce({_KM}, 0) AS km
                  FROM (SELECT trans_num, {_CHORD} AS a FROM txn WHERE {VALID_POINTS}))""",
        "txn",
    ),
)
def distance_features(spark, sf):
    rows = prepare.valid_coordinates(transactions(spark, sf, _POINTS))
    return features.add_distance(rows).select(
        "trans_num", "distance_from_home", "is_local_transaction"
    )


_TIME_OUT = (
    "trans_num, CAST(is_night AS BIGINT) AS is_night, CAST(is_weekend AS BIGINT) AS is_weekend, "
    f"CAST(is_business_hours AS BIGINT) AS is_business_hours, {r6('hour_sin')} AS hour_sin, "
    f"{r6('hour_cos')} AS hour_cos, day_of_month"
)
_TIME_COLUMNS = (
    "trans_num", "is_night", "is_weekend", "is_business_hours", "hour_sin", "hour_cos", "day_of_month",
)


@query(
    "time_features",
    oracle(f"SELECT {_TIME_OUT} FROM (SELECT trans_num, {TIME_FEATURES} FROM timed)", "timed"),
)
def time_features(spark, sf):
    rows = transactions(spark, sf, ["trans_num", "trans_date", "trans_time"])
    timed = prepare.add_hour(prepare.add_date_parts(rows))
    return features.add_time_features(timed).select(*_TIME_COLUMNS)


_AMOUNT_COLUMNS = (
    "trans_num", "amt_log", "amt_zscore", "is_high_value", "is_micro_transaction", "is_outlier_iqr",
)
_AMOUNT_OUT = (
    f"trans_num, {r6('amt_log')} AS amt_log, {r6('amt_zscore')} AS amt_zscore, "
    "CAST(is_high_value AS BIGINT) AS is_high_value, "
    "CAST(is_micro_transaction AS BIGINT) AS is_micro_transaction, "
    "CAST(is_outlier_iqr AS BIGINT) AS is_outlier_iqr"
)


def placed(spark, sf, columns=()):
    """Transactions with calendar parts and valid coordinates."""
    wanted = {*_POINTS, "trans_date", "trans_time", *columns}
    return prepare.transform(transactions(spark, sf, wanted))


def feature_rows(spark, sf, columns=()):
    """Placed transactions with age and all engineered features.

    The placed rows, with the columns that are asked for, are an artefact: written once per session. The median age
    and the amount statistics then read one column.
    """
    def make(path):
        rows = cleanse.add_age(placed(spark, sf, {"dob", "amt", "is_fraud", *columns}))
        rows.drop("dob", "trans_date").write.parquet(path)

    path = artefact(spark, sf, "-".join(["placed", *sorted(columns)]), make)
    return flows.engineer(cleanse.impute_age(spark.read.parquet(path)))


@query("amount_features", oracle(f"SELECT {_AMOUNT_OUT} FROM feats", "feats"))
def amount_features(spark, sf):
    return features.add_amount_features(placed(spark, sf, ["amt"])).select(*_AMOUNT_COLUMNS)


@query(
    "outlier_share",
    oracle(
        f"""SELECT CAST(sum(is_outlier_iqr) AS BIGINT) AS outliers,
              {r6('avg(is_outlier_iqr) * 100')} AS outlier_pct FROM feats""",
        "feats",
    ),
)
def outlier_share(spark, sf):
    return features.outlier_share(features.add_amount_features(placed(spark, sf, ["amt"])))


_INTERACTIONS = (
    "night_x_high_value", "weekend_x_high_value", "outlier_x_night", "high_value_x_business_hours",
)


@query(
    "interaction_features",
    oracle(
        f"""SELECT trans_num, {r6('amt_per_age')} AS amt_per_age,
              {", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in _INTERACTIONS)} FROM feats""",
        "feats",
    ),
)
def interaction_features(spark, sf):
    return feature_rows(spark, sf).select("trans_num", "amt_per_age", *_INTERACTIONS)


_SELECTED = ("amt", "amt_zscore", "hour_cos", "amt_per_age", "amt_log", "trans_hour", "age")


@query(
    "select_features",
    oracle(
        f"""SELECT {", ".join(f"{r6(c)} AS {c}" for c in _SELECTED[:5])}, trans_hour, age,
              CAST(is_fraud AS BIGINT) AS is_fraud FROM feats""",
        "feats",
    ),
)
def select_features(spark, sf):
    return project_features(feature_rows(spark, sf), _SELECTED, "is_fraud")


# ---- encoding

_ONE_HOT_VALUES = {
    "gender": GENDERS, "trans_weekday": WEEKDAY_NAMES, "category": CATEGORIES, "state": STATES,
}
_ONE_HOT_SQL = ", ".join(
    f"""CAST(CASE WHEN {col} = '{v}' THEN 1 ELSE 0 END AS BIGINT) AS "{col}_{v}\""""
    for col, values in _ONE_HOT_VALUES.items()
    for v in values
)


@query("onehot_encode", oracle(f"SELECT trans_num, {_ONE_HOT_SQL} FROM prepared", "prepared"))
def onehot_encode(spark, sf):
    columns = [*_POINTS, "gender", "trans_date", "category", "state"]
    cleaned = prepare.clean_text_columns(transactions(spark, sf, columns))
    rows = write_table(prepare.transform(cleaned).select("trans_num", *_ONE_HOT_VALUES), "prepared")
    vocabulary = encode.collect_vocabulary(encode.onehot_vocabulary(rows))
    return encode.onehot_encode(rows, vocabulary)


@query(
    "onehot_vocab",
    oracle(
        """SELECT DISTINCT col AS "column", value, col || '_' || value AS column_name FROM (
             SELECT 'gender' AS col, gender AS value FROM prepared
             UNION ALL SELECT 'trans_weekday', trans_weekday FROM prepared
             UNION ALL SELECT 'category', category FROM prepared
             UNION ALL SELECT 'state', state FROM prepared) WHERE value IS NOT NULL""",
        "prepared",
    ),
)
def onehot_vocab(spark, sf):
    columns = [*_POINTS, "gender", "trans_date", "category", "state"]
    cleaned = prepare.clean_text_columns(transactions(spark, sf, columns))
    return encode.onehot_vocabulary(prepare.transform(cleaned))


_CODES = """
  SELECT col, value, dense_rank() OVER (PARTITION BY col ORDER BY num, value) - 1 AS code FROM (
    SELECT DISTINCT col, value, CASE WHEN col = 'zip' THEN CAST(value AS BIGINT) ELSE 0 END AS num FROM (
      SELECT 'job' AS col, coalesce(job, 'unknown') AS value FROM prepared
      UNION ALL SELECT 'merchant', coalesce(merchant, 'unknown') FROM prepared
      UNION ALL SELECT 'city', coalesce(city, 'unknown') FROM prepared
      UNION ALL SELECT 'profile', coalesce(profile, 'unknown') FROM prepared
      UNION ALL SELECT 'zip', CAST(zip AS VARCHAR) FROM prepared))"""
_CODED = ("job", "merchant", "city", "profile", "zip")


def prepared_rows(spark, sf, columns):
    """Cleaned, reduced and transformed rows with the columns a query needs."""
    wanted = {*_POINTS, "trans_date", "trans_time", *columns}
    return flows.prepare(transactions(spark, sf, wanted), TOP_N)


@query(
    "label_vocab",
    oracle('SELECT col AS "column", value, code FROM codes', "prepared", extra={"codes": _CODES}),
)
def label_vocab(spark, sf):
    return encode.label_vocabulary(prepared_rows(spark, sf, _CODED))


_ENCODED_JOINS = " ".join(
    f"""LEFT JOIN codes AS c_{c} ON c_{c}.col = '{c}'
        AND c_{c}.value = coalesce(CAST(rows.{c} AS VARCHAR), 'unknown')"""
    for c in _CODED
)
_ENCODED_OUT = ", ".join(f"coalesce(c_{c}.code, -1) AS {c}_encoded" for c in _CODED)


@query(
    "label_encode",
    oracle(
        f"SELECT trans_num, {_ENCODED_OUT} FROM prepared AS rows {_ENCODED_JOINS}",
        "prepared",
        extra={"codes": _CODES},
    ),
)
def label_encode(spark, sf):
    rows = write_table(prepared_rows(spark, sf, _CODED).select("trans_num", *_CODED), "prepared")
    return encode.label_encode(rows, encode.fit_labels(rows))


@query(
    "onehot_mapping",
    oracle(
        """SELECT col AS "column", 'one-hot' AS encoding_type, count(*) AS num_columns_created,
             string_agg(value, '|' ORDER BY value) AS unique_values,
             string_agg(col || '_' || value, '|' ORDER BY col || '_' || value) AS column_names
           FROM (SELECT DISTINCT 'gender' AS col, gender AS value FROM clean WHERE gender IS NOT NULL
                 UNION ALL SELECT DISTINCT 'category', category FROM clean WHERE category IS NOT NULL)
           GROUP BY col""",
        "clean",
    ),
)
def onehot_mapping(spark, sf):
    """The encoding map, stored as JSON and read again."""
    cleaned = prepare.clean_text_columns(transactions(spark, sf, ["gender", "category"]))
    mapping = encode.onehot_mapping(encode.onehot_vocabulary(cleaned))
    path = scratch_path(spark, "onehot-mapping")
    files.write_report(mapping, path, "json")
    stored = files.read_report(spark, path, mapping.schema, "json")
    joined = {c: F.array_join(c, "|") for c in ("unique_values", "column_names")}
    return stored.withColumns(joined)


@query(
    "label_mapping",
    oracle(
        """SELECT col AS "column", 'label' AS encoding_type, count(*) AS num_unique_values,
             string_agg(CASE WHEN code < 10 THEN value END, '|' ORDER BY code) AS sample_values
           FROM codes GROUP BY col""",
        "prepared",
        extra={"codes": _CODES},
    ),
)
def label_mapping(spark, sf):
    vocabulary = encode.fit_labels(prepared_rows(spark, sf, _CODED))
    mapping = encode.label_mapping(vocabulary)
    return mapping.withColumn("sample_values", F.array_join("sample_values", "|"))


# ---- the whole flow

_FLOW = {
    "codes": _CODES.replace("FROM prepared", "FROM unique_rows"),
    "ages": """SELECT *, CAST(round(date_diff('day', TRY_CAST(dob AS DATE), CAST(trans_date AS DATE))
                 / CAST(365.25 AS DOUBLE)) AS BIGINT) AS raw_age FROM unique_rows""",
    "whole": """SELECT *, CASE WHEN raw_age < 0 OR raw_age > 120
                  THEN (SELECT CAST(floor(quantile_cont(raw_age, 0.5) + 0.5) AS BIGINT) FROM ages
                        WHERE raw_age BETWEEN 0 AND 120) ELSE raw_age END AS age FROM ages""",
    "points": """SELECT avg(amt) AS mean, stddev_samp(amt) AS std, quantile_cont(amt, 0.25) AS q25,
                   quantile_cont(amt, 0.75) AS q75, quantile_cont(amt, 0.95) AS q95 FROM whole""",
    "marked": f"""SELECT whole.*, {TIME_FEATURES}, ln(1 + amt) AS amt_log, (amt - mean) / std AS amt_zscore,
                    CASE WHEN amt > q95 THEN 1 ELSE 0 END AS is_high_value,
                    CASE WHEN amt < 5 THEN 1 ELSE 0 END AS is_micro_transaction,
                    CASE WHEN amt < q25 - 1.5::DOUBLE * (q75 - q25)
                           OR amt > q75 + 1.5::DOUBLE * (q75 - q25) THEN 1 ELSE 0 END AS is_outlier_iqr
                  FROM whole, points""",
}
_UNIQUE = {
    "unique_rows": f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {_KEY_SQL}
                       ORDER BY trans_num) AS rn FROM prepared) WHERE rn = 1"""
}
_PRODUCTS = {
    "night_x_high_value": "is_night * is_high_value",
    "weekend_x_high_value": "is_weekend * is_high_value",
    "outlier_x_night": "is_outlier_iqr * is_night",
    "high_value_x_business_hours": "is_high_value * is_business_hours",
}
_FLOW_OUT = ", ".join(
    [
        "trans_num, city_pop, trans_year, trans_month, trans_day, trans_hour, age, day_of_month",
        *[f"{r6(c)} AS {c}" for c in ("lat", "long", "amt", "hour_sin", "hour_cos", "amt_log", "amt_zscore")],
        *[
            f"CAST({c} AS BIGINT) AS {c}"
            for c in (
                "is_fraud", "is_night", "is_weekend", "is_business_hours", "is_high_value",
                "is_micro_transaction", "is_outlier_iqr",
            )
        ],
        f"{r6('coalesce(amt / nullif(age, 0), 0)')} AS amt_per_age",
        *[f"CAST({sql} AS BIGINT) AS {name}" for name, sql in _PRODUCTS.items()],
        _ONE_HOT_SQL,
        _ENCODED_OUT,
    ]
)


@query(
    "feature_table",
    oracle(
        f"SELECT {_FLOW_OUT} FROM marked AS rows {_ENCODED_JOINS}",
        "prepared",
        extra={**_UNIQUE, **_FLOW},
    ),
)
def feature_table(spark, sf):
    """Raw transactions to model features, the row id kept."""
    return flows.feature_table(transactions(spark, sf), TOP_N, keep=["trans_num"])
