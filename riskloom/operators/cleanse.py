"""Duplicates, age, dropped columns and amount outliers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.functions.dates import age_years, date_column
from riskloom.functions.numbers import safe_ratio
from riskloom.operators.ordered import quantiles
from riskloom.schema import DEDUP_KEY, DROPPED, LABEL, ROW_ID
from riskloom.session import write_table

MULTIPLIERS = (1.5, 2.0, 3.0)


def repeated_keys(
    df: DataFrame, key: Sequence[str] = DEDUP_KEY, order_by: str = ROW_ID
) -> DataFrame:
    """The keys that occur more than once, with the smallest ``order_by`` of each.

    Copies are counted with a map-side partial aggregate over the key columns only, so a key held by a
    third of all rows sends one row per task.
    """
    return (
        df.groupBy(*key)
        .agg(F.min(order_by).alias("_first"), F.count(F.lit(1)).alias("_copies"))
        .filter(F.col("_copies") > 1)
        .drop("_copies")
    )


def drop_duplicates_keep_first(
    df: DataFrame, key: Sequence[str] = DEDUP_KEY, order_by: str = ROW_ID
) -> DataFrame:
    """Keep, per key, the row with the smallest ``order_by`` (unique per row). Null equals null.

    The repeated keys are written first. Their size is then known: few of them are broadcast and the
    wide rows stay where they are; many of them are joined by a shuffle in which adaptive execution
    splits a hot key.
    """
    repeated = write_table(repeated_keys(df, key, order_by), "repeated-keys")
    marked = repeated.select(*[F.col(c).alias(f"_key_{c}") for c in key], "_first")
    matches = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_key_{c}")) for c in key])
    return (
        df.join(marked, matches, "left")
        .filter(F.col("_first").isNull() | (F.col(order_by) == F.col("_first")))
        .select(*df.columns)
    )


def duplicate_report(df: DataFrame, key: Sequence[str] = DEDUP_KEY) -> DataFrame:
    """Rows, surplus copies and their share in percent."""
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    total = F.coalesce(F.sum("_n"), F.lit(0))
    surplus = F.coalesce(F.sum(F.col("_n") - 1), F.lit(0))
    return per_key.agg(
        total.alias("total_rows"),
        surplus.alias("duplicates"),
        (safe_ratio(surplus, total) * 100).alias("duplicate_pct"),
    )


def add_age(df: DataFrame) -> DataFrame:
    """Age at the transaction; null when a date is missing or malformed."""
    if "dob" not in df.columns or "trans_date" not in df.columns:
        return df
    return df.withColumn(
        "age", age_years(date_column(df, "trans_date"), date_column(df, "dob"))
    )


def median_valid_age(df: DataFrame) -> DataFrame:
    """One row with the median of the ages 0..120, a half rounded up. The ages are counted first, so
    the median sees at most 121 rows."""
    counted = (
        df.filter(F.col("age").between(0, 120)).groupBy("age").agg(F.count(F.lit(1)).alias("_n"))
    )
    return counted.agg(F.floor(F.percentile("age", 0.5, F.col("_n")) + 0.5).cast("int").alias("median_age"))


def impute_age(df: DataFrame) -> DataFrame:
    """Replace ages below 0 or above 120 by the median of the valid ones; null stays null."""
    if "age" not in df.columns:
        return df
    invalid = (F.col("age") < 0) | (F.col("age") > 120)
    return df.withColumn(
        "age", F.when(invalid, median_valid_age(df).scalar()).otherwise(F.col("age"))
    )


def drop_columns(df: DataFrame, names: Sequence[str] = DROPPED) -> DataFrame:
    """Drop the listed columns that exist."""
    return df.drop(*names)


def iqr_bounds(df: DataFrame, column: str = "amt", multiplier: float = 1.5) -> DataFrame:
    """One row: quartiles, their distance and the outlier fences."""
    iqr = F.col("q3") - F.col("q1")
    return (
        quantiles(df, [column], [0.25, 0.75])
        .select(F.col("q25").alias("q1"), F.col("q75").alias("q3"))
        .withColumn("iqr", iqr)
        .withColumn("lower_bound", F.col("q1") - multiplier * F.col("iqr"))
        .withColumn("upper_bound", F.col("q3") + multiplier * F.col("iqr"))
    )


def remove_outliers(df: DataFrame, column: str = "amt", multiplier: float = 1.5) -> DataFrame:
    """Keep the rows inside the fences; a null value is dropped."""
    fences = iqr_bounds(df, column, multiplier)
    low = fences.select("lower_bound").scalar()
    high = fences.select("upper_bound").scalar()
    return df.filter((F.col(column) >= low) & (F.col(column) <= high))


def outlier_impact(
    df: DataFrame, column: str = "amt", multipliers: Sequence[float] = MULTIPLIERS
) -> DataFrame:
    """Rows and positive labels that each fence multiplier would remove, in one pass over the rows."""
    bounds = iqr_bounds(df, column).select(F.struct("q1", "q3", "iqr")).scalar()
    amount, label = F.col(column), F.col(LABEL)
    edges = {
        m: (
            F.col("_b.q1") - F.lit(float(m)) * F.col("_b.iqr"),
            F.col("_b.q3") + F.lit(float(m)) * F.col("_b.iqr"),
        )
        for m in multipliers
    }
    sums = []
    for i, (low, high) in enumerate(edges.values()):
        outside = (amount < low) | (amount > high)
        sums += [
            F.count_if(outside).alias(f"_rows_{i}"),
            F.coalesce(F.sum(F.when(outside, label)), F.lit(0)).alias(f"_fraud_{i}"),
        ]
    totals = (
        df.select(column, LABEL)
        .withColumn("_b", bounds)
        .groupBy("_b")
        .agg(
            F.count(F.lit(1)).alias("_rows"),
            F.coalesce(F.sum(LABEL), F.lit(0)).alias("_fraud"),
            *sums,
        )
    )
    lines = F.array(
        *[
            F.struct(
                F.lit(float(m)).alias("multiplier"),
                low.alias("lower_bound"),
                high.alias("upper_bound"),
                F.col(f"_rows_{i}").alias("rows_removed"),
                (safe_ratio(F.col(f"_rows_{i}"), F.col("_rows")) * 100).alias("pct_rows"),
                F.col(f"_fraud_{i}").alias("fraud_removed"),
                (safe_ratio(F.col(f"_fraud_{i}"), F.col("_fraud")) * 100).alias("pct_fraud"),
            )
            for i, (m, (low, high)) in enumerate(edges.items())
        ]
    )
    return totals.select(F.inline(lines))


def outlier_recommendation(impact: DataFrame, max_fraud_pct: float = 5.0) -> DataFrame:
    """The smallest multiplier that loses less than ``max_fraud_pct`` of the positives, else keep all."""
    fine = F.col("pct_fraud") < max_fraud_pct
    chosen = F.min(F.when(fine, F.col("multiplier")))
    return impact.agg(
        chosen.alias("multiplier"),
        F.when(chosen.isNull(), "keep outliers").otherwise("remove outliers").alias("advice"),
    )
