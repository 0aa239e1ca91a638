"""Distance, time, amount and interaction features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.functions.geo import haversine_km
from riskloom.functions.numbers import flag
from riskloom.operators.ordered import quantiles

LOCAL_KM = 50.0
MICRO_AMOUNT = 5.0


def add_distance(df: DataFrame) -> DataFrame:
    """Distance between customer and merchant, and whether it is local."""
    if not {"lat", "long", "merch_lat", "merch_long"}.issubset(df.columns):
        return df
    km = haversine_km(F.col("lat"), F.col("long"), F.col("merch_lat"), F.col("merch_long"))
    return df.withColumn("distance_from_home", km).withColumn(
        "is_local_transaction", flag(F.col("distance_from_home") < LOCAL_KM)
    )


def weekend(df: DataFrame) -> Column | None:
    """The weekend condition, from the weekday name or from its one-hot columns."""
    if "trans_weekday" in df.columns:
        return F.coalesce(F.col("trans_weekday").isin("Saturday", "Sunday"), F.lit(False))
    parts = ("trans_weekday_Saturday", "trans_weekday_Sunday")
    if set(parts).issubset(df.columns):
        return (F.col(parts[0]) == 1) | (F.col(parts[1]) == 1)
    return None


def add_time_features(df: DataFrame) -> DataFrame:
    """Night (23-06), weekend, office hours (weekdays 9-17), the hour on a circle, day of month."""
    if "trans_hour" not in df.columns:
        return df
    hour = F.col("trans_hour")
    angle = F.lit(2.0) * F.pi() * hour / 24
    made = {"is_night": flag((hour >= 23) | (hour <= 6))}
    free_day = weekend(df)
    if free_day is not None:
        made["is_weekend"] = flag(free_day)
        made["is_business_hours"] = flag(~free_day & hour.between(9, 17))
    made["hour_sin"] = F.sin(angle)
    made["hour_cos"] = F.cos(angle)
    if "trans_day" in df.columns:
        made["day_of_month"] = F.col("trans_day")
    return df.withColumns(made)


def amount_statistics(df: DataFrame, column: str = "amt") -> DataFrame:
    """One row: mean, sample deviation, quartiles and 95th percentile over the whole table."""
    spread = df.agg(F.avg(column).alias("mean"), F.stddev_samp(column).alias("std"))
    marks = quantiles(df, [column], [0.25, 0.75, 0.95]).select(F.struct("q25", "q75", "q95"))
    return spread.withColumn("_q", marks.scalar()).select("mean", "std", "_q.*")


def add_amount_features(df: DataFrame, statistics: DataFrame | None = None) -> DataFrame:
    """Log, z-score, high-value, micro and outlier flags from global statistics.

    The statistics reach the rows as a scalar subquery: no join, and the wide rows stay in their scan
    stage. Pass a stored one-row table to score new rows with the statistics of the training rows.
    """
    if "amt" not in df.columns:
        return df
    stats = amount_statistics(df) if statistics is None else statistics
    packed = stats.select(F.struct("mean", "std", "q25", "q75", "q95")).scalar()
    amt = F.col("amt")
    iqr = F.col("_s.q75") - F.col("_s.q25")
    outside = (amt < F.col("_s.q25") - 1.5 * iqr) | (amt > F.col("_s.q75") + 1.5 * iqr)
    return (
        df.withColumn("_s", packed)
        .withColumns(
            {
                "amt_log": F.log1p(amt),
                "amt_zscore": F.when(
                    F.col("_s.std") > 0, (amt - F.col("_s.mean")) / F.col("_s.std")
                ).otherwise(F.lit(0.0)),
                "is_high_value": flag(amt > F.col("_s.q95")),
                "is_micro_transaction": flag(amt < MICRO_AMOUNT),
                "is_outlier_iqr": flag(outside),
            }
        )
        .drop("_s")
    )


def outlier_share(df: DataFrame) -> DataFrame:
    """Count and percentage of rows flagged as amount outliers."""
    return df.agg(
        F.sum("is_outlier_iqr").alias("outliers"),
        (F.avg("is_outlier_iqr") * 100).alias("outlier_pct"),
    )


def add_interactions(df: DataFrame) -> DataFrame:
    """Amount per year of age and products of flags; a missing input skips its feature."""
    made = {}
    if {"amt", "age"}.issubset(df.columns):
        made["amt_per_age"] = F.coalesce(F.try_divide(F.col("amt"), F.col("age")), F.lit(0.0))
    # Feature name and the two flags it multiplies.
    products = (
        ("night_x_high_value", "is_night", "is_high_value"),
        ("weekend_x_high_value", "is_weekend", "is_high_value"),
        ("outlier_x_night", "is_outlier_iqr", "is_night"),
        ("high_value_x_business_hours", "is_high_value", "is_business_hours"),
    )
    for name, left, right in products:
        if {left, right}.issubset(df.columns):
            made[name] = F.col(left) * F.col(right)
    return df.withColumns(made) if made else df
