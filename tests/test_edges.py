"""Rows and tables that break naive operators."""

import pytest
from pyspark.sql import functions as F

from riskloom.operators import cleanse, correlate, encode, features, prepare, profile, risk
from riskloom.schema import RAW_SCHEMA


def test_text_cleanup_handles_unicode(spark):
    data = [("  Café del  Mar! ",), ("A\tB\n C",), ("x　 y",), (None,), ("#$%",), ("a_b-c.d 9",)]
    got = [r[0] for r in prepare.clean_text_columns(spark.createDataFrame(data, "city string")).collect()]
    assert got == ["caf del mar", "a b c", "x y", None, "", "a_b-c.d 9"]


def test_null_token_option(spark):
    df = spark.createDataFrame([(None,), ("Ab",)], "city string")
    assert [r[0] for r in prepare.clean_text_columns(df, "nan").collect()] == ["nan", "ab"]


def test_profile_and_ssn(spark):
    df = spark.createDataFrame([("Adults_2550_Female_Urban.json", "012-34-5678")], "profile string, ssn string")
    assert tuple(prepare.clean_text_columns(df).first()) == ("adults2550femaleurban", "012345678")


def test_bad_dates_and_times_become_null(spark):
    data = [
        ("2024-02-29", "23:59:59"), ("2023-02-29", "24:00:00"), ("n/a", "bad"), (None, None),
        ("2024", "7"), ("2024-01-05T10:00", "12:61:00"), ("2024-1-5", "7:05:09"),
    ]
    df = spark.createDataFrame(data, "trans_date string, trans_time string")
    got = prepare.add_hour(prepare.add_date_parts(df)).collect()
    assert [r["trans_day"] for r in got] == [29, None, None, None, None, None, 5]
    assert [r["trans_hour"] for r in got] == [23, None, None, None, None, None, 7]
    assert got[0]["trans_weekday"] == "Thursday"
    audit = prepare.transform_audit(df.select("*", F.lit(1.0).alias("lat"), F.lit(1.0).alias("long"))).first()
    assert (audit["null_dates_in"], audit["date_parse_failed"], audit["time_parse_failed"]) == (1, 4, 4)


def test_coordinates(spark):
    data = [(0.0, 0.0), (90.0, 180.0), (90.1, 0.0), (0.0, -180.5), (None, 0.0), (0.0, None)]
    df = spark.createDataFrame(data, "lat double, long double")
    assert prepare.valid_coordinates(df).count() == 2


def test_age_rules(spark):
    data = [("2024-01-01", d) for d in ("1984-01-01", "2000-01-01", "2030-01-01", "1850-01-01", "n/a", None)]
    df = cleanse.impute_age(cleanse.add_age(spark.createDataFrame(data, "trans_date string, dob string")))
    # the median of 40 and 24 replaces the two impossible ages
    assert [r["age"] for r in df.collect()] == [40, 24, 32, 32, None, None]


def test_missing_optional_columns_are_skipped(spark):
    df = spark.createDataFrame([(5.0,)], "amt double")
    made = features.add_interactions(features.add_time_features(features.add_distance(df)))
    assert made.columns == ["amt"]
    assert cleanse.drop_columns(df).columns == ["amt"]


def test_constant_amounts(spark):
    df = spark.createDataFrame([(7.0,)] * 5, "amt double")
    row = features.add_amount_features(df).first()
    assert (row["amt_zscore"], row["is_high_value"], row["is_outlier_iqr"]) == (0.0, 0, 0)


def test_null_and_zero_amounts(spark):
    df = spark.createDataFrame([(None, 30), (0.0, 0), (10.0, None), (10.0, 5)], "amt double, age int")
    rows = features.add_interactions(features.add_amount_features(df)).collect()
    assert [r["amt_per_age"] for r in rows] == [0.0, 0.0, 0.0, 2.0]
    assert rows[0]["amt_log"] is None and rows[0]["is_micro_transaction"] == 0
    assert cleanse.remove_outliers(df).filter("amt IS NULL").count() == 0


def test_time_flags(spark):
    data = [("Saturday", 12), ("Monday", 9), ("Monday", 18), ("Sunday", None), ("Friday", 23), (None, 6)]
    df = spark.createDataFrame(data, "trans_weekday string, trans_hour int")
    got = [(r["is_night"], r["is_weekend"], r["is_business_hours"]) for r in features.add_time_features(df).collect()]
    assert got == [(0, 1, 0), (0, 0, 1), (0, 0, 0), (0, 1, 0), (1, 0, 0), (1, 0, 0)]


def test_single_class(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 2.0)], "is_fraud int, amt double")
    row = profile.target_imbalance(df).first()
    assert row["imbalance_ratio"] == float("inf") and row["severity"] == "severe"
    assert [r["count"] for r in profile.target_distribution(df).collect()] == [2, 0]
    assert profile.class_weights(df).first()["scale_pos_weight"] is None
    by_class = {r["metric"]: r for r in profile.amount_by_class(df).collect()}
    assert by_class["mean"]["non_fraud"] == 1.5 and by_class["mean"]["fraud"] is None


def test_empty_table(spark):
    df = spark.createDataFrame([], RAW_SCHEMA)
    assert profile.overview(df).filter("metric = 'total_rows'").first()["value"] == 0
    assert profile.missing_values(df).count() == 0
    assert cleanse.duplicate_report(df).first()["duplicates"] == 0
    assert len(risk.fraud_by_hour(prepare.add_hour(df)).collect()) == 24
    assert features.add_amount_features(df).count() == 0
    assert cleanse.drop_duplicates_keep_first(df).count() == 0
    assert encode.label_vocabulary(df).count() == 0


def test_all_null_column(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double")
    row = {r["column"]: r for r in profile.numeric_describe(df).collect()}
    assert row["b"]["count"] == 0 and row["b"]["mean"] is None and row["b"]["q50"] is None
    assert correlate.correlation_matrix(df, ["a", "b"]).first()["correlation"] is None


def test_correlation_uses_pairwise_known_rows(spark):
    data = [(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, None, 5.0), (4.0, 8.0, 5.0), (None, 1.0, 5.0)]
    df = spark.createDataFrame(data, "a double, b double, c double")
    got = {(r["feature1"], r["feature2"]): r["correlation"] for r in correlate.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert got["a", "b"] == pytest.approx(1.0)
    assert got["a", "c"] is None and got["b", "c"] is None


def test_nulls_are_left_out_of_groups(spark):
    df = spark.createDataFrame([("x", 1), (None, 1), ("x", 0)], "category string, is_fraud int")
    rows = risk.risk_by_value(df, "category").collect()
    assert len(rows) == 1 and rows[0]["fraud_rate"] == 50.0
