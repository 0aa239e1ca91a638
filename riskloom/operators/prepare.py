"""Text cleanup, category reduction, calendar parts and coordinate checks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import StringType

from riskloom.functions.dates import date_column, parse_hour, weekday_name
from riskloom.functions.geo import valid_point
from riskloom.functions.numbers import round_half_even, safe_ratio
from riskloom.functions.text import clean_profile, clean_ssn, clean_text
from riskloom.schema import NOT_TEXT, REDUCED
from riskloom.session import write_table


def text_columns(df: DataFrame) -> list[str]:
    """String columns that hold free text."""
    return [
        f.name for f in df.schema if isinstance(f.dataType, StringType) and f.name not in NOT_TEXT
    ]


def clean_text_columns(df: DataFrame, null_token: str | None = None) -> DataFrame:
    """Normalise every text column. Nulls stay null unless ``null_token`` names their replacement."""
    changed = {}
    for name in text_columns(df):
        col = F.col(name) if null_token is None else F.coalesce(F.col(name), F.lit(null_token))
        changed[name] = clean_profile(col) if name == "profile" else clean_text(col)
    if "ssn" in df.columns:
        changed["ssn"] = clean_ssn(F.col("ssn"))
    return df.withColumns(changed)


def value_counts(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Tall ``(column, value, count)`` of the non-null values of several columns, in one scan."""
    columns = [c for c in columns if c in df.columns]
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    return (
        df.select(F.inline(pairs))
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def top_values(df: DataFrame, columns: Iterable[str] = REDUCED, top_n: int = 50) -> DataFrame:
    """The ``top_n`` most frequent values per column; ties go to the smaller value.

    Spark prunes to ``top_n`` rows per column before the shuffle of the ranking window.
    """
    by_count = Window.partitionBy("column").orderBy(F.desc("count"), "value")
    return (
        value_counts(df, columns)
        .withColumn("rank", F.row_number().over(by_count))
        .filter(F.col("rank") <= top_n)
    )


def fit_top_values(df: DataFrame, columns: Iterable[str] = REDUCED, top_n: int = 50) -> DataFrame:
    """The kept values as a written table, so that the rows are counted once and later rows can be
    reduced with the same list."""
    return write_table(top_values(df, columns, top_n), "top-values")


def reduce_categories(df: DataFrame, kept: DataFrame, columns: Iterable[str] = REDUCED) -> DataFrame:
    """Replace values outside ``kept`` (a ``top_values`` table) by ``'other'``; null becomes ``'other'``.

    The list holds at most ``top_n`` rows per column, so it is always small enough to broadcast.
    """
    for name in columns:
        if name not in df.columns:
            continue
        listed = kept.filter(F.col("column") == name).select(F.col("value").alias("_kept"))
        df = (
            df.join(listed, F.col(name) == F.col("_kept"), "left")
            .withColumn(name, F.coalesce("_kept", F.lit("other")))
            .drop("_kept")
        )
    return df


def reduction_summary(
    df: DataFrame, columns: Iterable[str] = REDUCED, top_n: int = 50
) -> DataFrame:
    """Distinct values before and after the reduction, and the saving in percent."""
    before = F.col("unique_before")
    after = F.least(F.lit(top_n + 1), before)
    return (
        value_counts(df, columns)
        .groupBy("column")
        .agg(F.count(F.lit(1)).alias("unique_before"))
        .withColumn("unique_after", after)
        .withColumn("reduction_pct", round_half_even((1 - after / before) * 100, 1))
    )


def add_date_parts(df: DataFrame) -> DataFrame:
    """Year, month, day and weekday name of ``trans_date``, which becomes a date."""
    if "trans_date" not in df.columns:
        return df
    return df.withColumn("trans_date", date_column(df, "trans_date")).withColumns(
        {
            "trans_year": F.year("trans_date"),
            "trans_month": F.month("trans_date"),
            "trans_day": F.day("trans_date"),
            "trans_weekday": weekday_name(F.col("trans_date")),
        }
    )


def add_hour(df: DataFrame) -> DataFrame:
    if "trans_time" not in df.columns:
        return df
    return df.withColumn("trans_hour", parse_hour(F.col("trans_time")))


def valid_coordinates(df: DataFrame) -> DataFrame:
    """Drop rows whose customer or merchant point is null or outside the legal ranges."""
    for lat, long in (("lat", "long"), ("merch_lat", "merch_long")):
        if lat in df.columns and long in df.columns:
            df = df.filter(valid_point(F.col(lat), F.col(long)))
    return df


def transform(df: DataFrame) -> DataFrame:
    """Calendar parts, hour and the coordinate check."""
    return valid_coordinates(add_hour(add_date_parts(df)))


def transform_audit(df: DataFrame) -> DataFrame:
    """One row: rows in and out, nulls on the way in, parse failures, share dropped."""
    date, time = F.col("trans_date"), F.col("trans_time")
    points = valid_point(F.col("lat"), F.col("long"))
    if "merch_lat" in df.columns and "merch_long" in df.columns:
        points = points & valid_point(F.col("merch_lat"), F.col("merch_long"))
    bad_date = date.isNotNull() & date_column(df, "trans_date").isNull()
    bad_time = time.isNotNull() & parse_hour(time).isNull()
    counted = df.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(points).alias("rows_out"),
        F.count_if(date.isNull()).alias("null_dates_in"),
        F.count_if(time.isNull()).alias("null_times_in"),
        F.count_if(bad_date).alias("date_parse_failed"),
        F.count_if(bad_time).alias("time_parse_failed"),
    )
    removed = F.col("rows_in") - F.col("rows_out")
    return counted.withColumns(
        {
            "rows_removed": removed,
            "pct_removed": round_half_even(safe_ratio(removed, F.col("rows_in")) * 100, 2),
        }
    )
