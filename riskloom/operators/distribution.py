"""Histograms, box-plot statistics and the empirical distribution of an amount, per class."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.operators.ordered import (
    fill_levels,
    histogram_quantiles,
    running_totals,
    value_histogram,
    value_rows,
)
from riskloom.schema import LABEL


def bin_number(value: Column, low: Column, high: Column, bins: int) -> Column:
    """0-based equal-width bin; the last bin includes its upper edge; null outside the range."""
    place = F.floor(F.try_divide(value - low, high - low) * bins)
    inside = (value >= low) & (value <= high)
    return F.when(inside, F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1))).cast("int")


def even_bins(rows: DataFrame, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Counts per bin from ``(by..., value, n, _span)`` rows; empty bins are kept.

    ``_span`` is a struct ``(low, high)``, the same on every row.
    """
    bin_of = bin_number(F.col("value"), F.col("_span.low"), F.col("_span.high"), bins)
    counted = rows.groupBy(*by, "_span", bin_of.alias("bin")).agg(F.sum("n").alias("n"))
    width = (F.col("_span.high") - F.col("_span.low")) / bins
    return (
        fill_levels(counted, "bin", 0, bins - 1, ["n"], [*by, "_span"])
        .withColumnRenamed("n", "count")
        .select(
            *by,
            "bin",
            (F.col("_span.low") + F.col("bin") * width).alias("left_edge"),
            (F.col("_span.low") + (F.col("bin") + 1) * width).alias("right_edge"),
            "count",
        )
    )


def _with_density(hist: DataFrame, by: str, width: Column) -> DataFrame:
    totals = hist.groupBy(by).agg(F.sum("count").alias("_all"))
    # one row per class
    return (
        hist.join(totals, by)
        .withColumn(
            "density",
            F.coalesce(F.try_divide(F.col("count"), F.col("_all") * width), F.lit(0.0)),
        )
        .drop("_all")
    )


def _class_values(df: DataFrame, label: str, column: str) -> DataFrame:
    """Rows ``(label, value, n = 1)`` of the two classes; they collapse in the aggregate that follows."""
    known = df.filter(F.col(label).isin(0, 1))
    return value_rows(known, [column], [label]).select(label, "value", "n")


def amount_histogram(
    df: DataFrame, bins: int = 49, label: str = LABEL, column: str = "amt"
) -> DataFrame:
    """Density per class between 0 and the smaller of the two class maxima, 50 edges by default."""
    values = _class_values(df, label, column)
    top = F.least(
        F.max(F.when(F.col(label) == 0, F.col("value"))),
        F.max(F.when(F.col(label) == 1, F.col("value"))),
    )
    span = values.agg(F.struct(F.lit(0.0).alias("low"), top.alias("high"))).scalar()
    hist = even_bins(values.withColumn("_span", span), bins, [label])
    return _with_density(hist, label, F.col("right_edge") - F.col("left_edge"))


def amount_histogram_log(
    df: DataFrame, bins: int = 49, label: str = LABEL, column: str = "amt"
) -> DataFrame:
    """The same with edges spaced evenly in ``log10`` from the smallest to the largest amount."""
    values = _class_values(df, label, column).filter(F.col("value") > 0)
    logs = values.withColumn("value", F.log10("value"))
    span = logs.agg(
        F.struct(F.min("value").alias("low"), F.max("value").alias("high"))
    ).scalar()
    hist = even_bins(logs.withColumn("_span", span), bins, [label]).withColumns(
        {
            "left_edge": F.pow(F.lit(10.0), "left_edge"),
            "right_edge": F.pow(F.lit(10.0), "right_edge"),
        }
    )
    return _with_density(hist, label, F.col("right_edge") - F.col("left_edge"))


def amount_boxplot(df: DataFrame, label: str = LABEL, column: str = "amt") -> DataFrame:
    """Quartiles per class and the whiskers: the most extreme values within 1.5 IQR of the box."""
    values = _class_values(df, label, column)
    boxes = histogram_quantiles(
        values.withColumn("column", F.lit(column)), [0.25, 0.5, 0.75], [label]
    ).drop("column")
    reach = 1.5 * (F.col("q75") - F.col("q25"))
    # one box per class
    near = values.join(boxes, label).filter(
        F.col("value").between(F.col("q25") - reach, F.col("q75") + reach)
    )
    return near.groupBy(label, "q25", "q50", "q75").agg(
        F.min("value").alias("whisker_low"), F.max("value").alias("whisker_high")
    )


def amount_cdf(df: DataFrame, label: str = LABEL, column: str = "amt") -> DataFrame:
    """Empirical distribution per class: the i-th of n sorted values stands at ``(i-1)/(n-1)``.

    One row per distinct value with the heights of its first and last copy.
    """
    known = df.filter(F.col(label).isin(0, 1))
    values = value_histogram(known, [column], [label]).select(label, "value", "n")
    totals = running_totals(values, "n", "value", [label])
    last = F.col("n_all") - 1

    def height(position: Column) -> Column:
        return F.coalesce(F.try_divide(position, last), F.lit(0.0))

    return totals.select(
        label,
        F.col("value").alias(column),
        "n",
        height(F.col("n_before")).alias("cdf_first"),
        height(F.col("n_before") + F.col("n") - 1).alias("cdf_last"),
    )
