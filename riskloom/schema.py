"""Column names and types of the transactions table."""

from __future__ import annotations

from pyspark.sql import types as T

LABEL = "is_fraud"
ROW_ID = "trans_num"

RAW_SCHEMA = T.StructType(
    [
        T.StructField("trans_num", T.LongType()),
        T.StructField("cc_num", T.LongType()),
        T.StructField("ssn", T.StringType()),
        T.StructField("acct_num", T.LongType()),
        T.StructField("first", T.StringType()),
        T.StructField("last", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("street", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("zip", T.LongType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("long", T.DoubleType()),
        T.StructField("city_pop", T.LongType()),
        T.StructField("job", T.StringType()),
        T.StructField("dob", T.StringType()),
        T.StructField("profile", T.StringType()),
        T.StructField("trans_date", T.StringType()),
        T.StructField("trans_time", T.StringType()),
        T.StructField("unix_time", T.LongType()),
        T.StructField("category", T.StringType()),
        T.StructField("merchant", T.StringType()),
        T.StructField("amt", T.DoubleType()),
        T.StructField("merch_lat", T.DoubleType()),
        T.StructField("merch_long", T.DoubleType()),
        T.StructField("is_fraud", T.IntegerType()),
    ]
)

# Columns which text cleanup leaves alone.
NOT_TEXT = (
    "trans_date", "trans_time", "unix_time", "ssn", "cc_num", "acct_num", "trans_num",
    "lat", "long", "merch_lat", "merch_long", "amt", "zip", "is_fraud",
)

# Columns dropped before modelling.
COLLINEAR = ("merch_lat", "merch_long", "unix_time")
PERSONAL = ("ssn", "cc_num", "acct_num", "first", "last", "street", "trans_num", "dob")
EXTRACTED = ("trans_date", "trans_time")
ROW_INDEX = ("Unnamed: 0",)
DROPPED = COLLINEAR + PERSONAL + EXTRACTED + ROW_INDEX

# Column groups of the preparation and encoding steps.
REDUCED = ("job", "merchant")
ONE_HOT = ("gender", "trans_weekday", "category", "state")
LABEL_CODED = ("job", "merchant", "city", "profile", "zip")
RISK_COLUMNS = ("job", "merchant", "category")
DEDUP_KEY = ("cc_num", "amt", "merchant", "trans_date", "trans_time")

# English weekday names, Monday first.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
