"""Fraud rates over time and over category values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.functions.numbers import percent_rate
from riskloom.schema import LABEL, RISK_COLUMNS, WEEKDAYS


def _counts(label: str) -> list[Column]:
    return [
        F.count_if(F.col(label) == 1).alias("fraud_count"),
        F.count(F.lit(1)).alias("total_count"),
    ]


def _rate() -> Column:
    return percent_rate(F.col("fraud_count"), F.col("total_count"))


def fraud_by(df: DataFrame, column: str, name: str | None = None, label: str = LABEL) -> DataFrame:
    """Positives, rows and rate in percent per value; null values are left out."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias(name or column))
        .agg(*_counts(label))
        .withColumn("fraud_rate", _rate())
    )


def all_hours(by_hour: DataFrame) -> DataFrame:
    """Complete an hour table to 24 rows; hours without transactions get zeros."""
    empty = by_hour.sparkSession.range(24).select(
        F.col("id").cast("int").alias("hour"),
        F.lit(0).cast("long").alias("fraud_count"),
        F.lit(0).cast("long").alias("total_count"),
    )
    return (
        by_hour.select("hour", "fraud_count", "total_count")
        .unionByName(empty)
        .groupBy("hour")
        .agg(F.sum("fraud_count").alias("fraud_count"), F.sum("total_count").alias("total_count"))
        .withColumn("fraud_rate", _rate())
    )


def fraud_by_hour(df: DataFrame, label: str = LABEL) -> DataFrame:
    return all_hours(fraud_by(df, "trans_hour", "hour", label)).orderBy("hour")


def fraud_by_weekday(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Monday first; days without transactions are left out."""
    place = F.array_position(F.array(*[F.lit(d) for d in WEEKDAYS]), F.col("weekday"))
    return fraud_by(df, "trans_weekday", "weekday", label).orderBy(place)


def fraud_by_month(df: DataFrame, label: str = LABEL) -> DataFrame:
    return fraud_by(df, "trans_month", "month", label).orderBy("month")


def peak_hours(hourly: DataFrame, weekly: DataFrame) -> DataFrame:
    """Hour with the highest and lowest rate and the day with the highest; ties go to the first."""
    place = F.array_position(F.array(*[F.lit(d) for d in WEEKDAYS]), F.col("weekday"))
    hours = hourly.agg(
        F.max_by("hour", F.struct("fraud_rate", -F.col("hour"))).alias("peak_hour"),
        F.max("fraud_rate").alias("peak_rate"),
        F.min_by("hour", F.struct("fraud_rate", "hour")).alias("lowest_hour"),
        F.min("fraud_rate").alias("lowest_rate"),
    )
    days = weekly.agg(
        F.struct(
            F.max_by("weekday", F.struct("fraud_rate", -place)).alias("day"),
            F.max("fraud_rate").alias("rate"),
        ).alias("_top")
    )
    return (
        hours.withColumn("_top", days.scalar())
        .withColumns({"peak_day": F.col("_top.day"), "peak_day_rate": F.col("_top.rate")})
        .drop("_top")
    )


def night_day_pattern(hourly: DataFrame, factor: float = 1.2) -> DataFrame:
    """Mean of the hourly rates at night (0-5) and in office hours (9-17), and which one stands out."""
    hour, rate = F.col("hour"), F.col("fraud_rate")
    night, day = F.col("night_rate"), F.col("business_rate")
    return hourly.agg(
        F.avg(F.when(hour.between(0, 5), rate)).alias("night_rate"),
        F.avg(F.when(hour.between(9, 17), rate)).alias("business_rate"),
    ).withColumn(
        "pattern",
        F.when(night > day * factor, "night")
        .when(day > night * factor, "daytime")
        .otherwise("even"),
    )


def period_summary(hourly: DataFrame, factor: float = 1.2) -> DataFrame:
    """Mean hourly rate of the four six-hour periods, and the overall pattern."""
    hour, rate = F.col("hour"), F.col("fraud_rate")

    def mean(first: int) -> Column:
        return F.avg(F.when(hour.between(first, first + 5), rate))

    night, morning, afternoon = (F.col(f"{p}_rate") for p in ("night", "morning", "afternoon"))
    return hourly.agg(
        mean(0).alias("night_rate"),
        mean(6).alias("morning_rate"),
        mean(12).alias("afternoon_rate"),
        mean(18).alias("evening_rate"),
    ).withColumn(
        "pattern",
        F.when(night > morning * factor, "night")
        .when(afternoon > night * factor, "daytime")
        .otherwise("even"),
    )


def risk_by_value(df: DataFrame, column: str, label: str = LABEL) -> DataFrame:
    """Fraud per value of a category, highest rate first."""
    return fraud_by(df, column, column, label).orderBy(F.desc("fraud_rate"), column)


def risk_table(df: DataFrame, columns: Sequence[str] = RISK_COLUMNS, label: str = LABEL) -> DataFrame:
    """Tall fraud counts of several category columns from one scan. A value shared by most rows, such
    as ``'other'``, is summed up before the shuffle."""
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(c).alias("value"))
            for c in columns
            if c in df.columns
        ]
    )
    return (
        df.select(label, F.inline(pairs))
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(*_counts(label))
        .withColumn("fraud_rate", _rate())
    )


def risk_top_k(risk: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` values with the highest rate and with the most positives per column.

    Rank 1 of each ranking is the column's key finding; ``unique_values`` counts all its values.
    """
    def ranked(kind: str, measure: str) -> DataFrame:
        order = Window.partitionBy("column").orderBy(F.desc(measure), "value")
        return (
            risk.withColumn("rank", F.row_number().over(order))
            .filter(F.col("rank") <= k)
            .withColumn("ranking", F.lit(kind))
        )

    sizes = risk.groupBy("column").agg(F.count(F.lit(1)).alias("unique_values"))
    both = ranked("rate", "fraud_rate").unionByName(ranked("count", "fraud_count"))
    # one row per analysed column
    return both.join(sizes, "column")
