"""Table profile and label analysis."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DateType, NumericType, StringType, TimestampNTZType, TimestampType

from riskloom.functions.numbers import round_half_even, safe_ratio
from riskloom.operators.ordered import histogram_quantiles, quantiles, value_rows
from riskloom.operators.prepare import value_counts
from riskloom.schema import LABEL

_TIME_TYPES = (DateType, TimestampType, TimestampNTZType)


def columns_of(df: DataFrame, *kinds: type) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, kinds)]


def numeric_columns(df: DataFrame) -> list[str]:
    return columns_of(df, NumericType)


def text_columns(df: DataFrame) -> list[str]:
    return columns_of(df, StringType)


def _tall(row: DataFrame, lines: Sequence[Column]) -> DataFrame:
    """Turn a one-row aggregate into one line per struct."""
    return row.select(F.inline(F.array(*lines)))


def overview(df: DataFrame) -> DataFrame:
    """Rows, columns and columns per kind as ``(metric, value)``."""
    counted = df.agg(F.count(F.lit(1)).alias("_rows"))
    facts = [
        ("total_rows", F.col("_rows")),
        ("total_columns", F.lit(len(df.columns))),
        ("numerical_columns", F.lit(len(numeric_columns(df)))),
        ("categorical_columns", F.lit(len(text_columns(df)))),
        ("datetime_columns", F.lit(len(columns_of(df, *_TIME_TYPES)))),
    ]
    return _tall(
        counted,
        [F.struct(F.lit(k).alias("metric"), v.cast("long").alias("value")) for k, v in facts],
    )


def missing_values(df: DataFrame) -> DataFrame:
    """Columns with nulls: count, share in percent, type; most missing first. One pass over the rows."""
    fields = list(enumerate(df.schema))
    counted = df.selectExpr(
        "count(1) AS _rows", *[f"count_if(`{f.name}` IS NULL) AS _{i}" for i, f in fields]
    )
    lines = ", ".join(
        f"named_struct('column', '{f.name}', 'missing_count', _{i}, 'data_type', "
        f"'{f.dataType.simpleString()}')"
        for i, f in fields
    )
    return (
        counted.selectExpr("_rows", f"inline(array({lines}))")
        .filter(F.col("missing_count") > 0)
        .withColumn(
            "missing_percent",
            round_half_even(safe_ratio(F.col("missing_count"), F.col("_rows")) * 100, 2),
        )
        .drop("_rows")
        .orderBy(F.desc("missing_count"), "column")
    )


def _moments(df: DataFrame, columns: Sequence[str], ddof: int) -> DataFrame:
    """Tall count, mean, deviation, extremes and nulls of several columns from one aggregate."""
    deviation = "stddev_pop" if ddof == 0 else "stddev_samp"
    numbered = list(enumerate(columns))
    counted = df.selectExpr(
        "count(1) AS _rows",
        *[
            f"""named_struct('column', '{c}', 'count', count(`{c}`),
                'mean', avg(cast(`{c}` AS double)), 'std', {deviation}(cast(`{c}` AS double)),
                'min', min(cast(`{c}` AS double)), 'max', max(cast(`{c}` AS double))) AS _{i}"""
            for i, c in numbered
        ],
    )
    tall = counted.selectExpr("_rows", f"inline(array({', '.join(f'_{i}' for i, _ in numbered)}))")
    return tall.select(
        "column",
        "count",
        *[round_half_even(F.col(m), 2).alias(m) for m in ("mean", "std", "min", "max")],
        (F.col("_rows") - F.col("count")).alias("missing"),
    )


def numeric_summary(df: DataFrame, columns: Sequence[str] | None = None, ddof: int = 0) -> DataFrame:
    """Count, mean, deviation, min, max and missing per number column."""
    return _moments(df, columns or numeric_columns(df), ddof)


def numeric_describe(df: DataFrame, columns: Sequence[str] | None = None, ddof: int = 1) -> DataFrame:
    """``numeric_summary`` with exact quartiles."""
    columns = list(columns or numeric_columns(df))
    marks = quantiles(df, columns, [0.25, 0.5, 0.75]).select(
        "column", *[round_half_even(F.col(q), 2).alias(q) for q in ("q25", "q50", "q75")]
    )
    # one row per number column
    return _moments(df, columns, ddof).join(marks, "column", "left")


def categorical_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct values, the most common value and its count; ties go to the smaller value."""
    ranking = F.struct(-F.col("count"), F.col("value"))
    return (
        value_counts(df, columns or text_columns(df))
        .groupBy("column")
        .agg(
            F.count(F.lit(1)).alias("unique_values"),
            F.min_by("value", ranking).alias("most_common"),
            F.max("count").alias("most_common_count"),
        )
    )


def _label_counts(df: DataFrame, label: str) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col(label) == 0).alias("non_fraud"),
        F.count_if(F.col(label) == 1).alias("fraud"),
    )


def target_distribution(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Count and share of both classes; an absent class shows as 0."""
    share = safe_ratio(F.col("fraud"), F.col("total")) * 100
    return _tall(
        _label_counts(df, label),
        [
            F.struct(
                F.lit(0).alias(label), F.col("non_fraud").alias("count"), (100 - share).alias("percentage")
            ),
            F.struct(F.lit(1).alias(label), F.col("fraud").alias("count"), share.alias("percentage")),
        ],
    )


def target_imbalance(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Positive rate, negatives per positive (infinite without positives) and the severity band."""
    rate = F.col("fraud_rate")
    return (
        _label_counts(df, label)
        .withColumn("fraud_rate", safe_ratio(F.col("fraud"), F.col("total")) * 100)
        .withColumn(
            "imbalance_ratio",
            F.coalesce(F.try_divide(F.col("non_fraud"), F.col("fraud")), F.lit(float("inf"))),
        )
        .withColumn(
            "severity",
            F.when(rate < 0.5, "severe")
            .when(rate < 1.0, "high")
            .when(rate < 5.0, "moderate")
            .otherwise("balanced"),
        )
    )


def class_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Positive weight ``neg/pos`` and the balanced weights ``n / (2 n_c)``."""
    both = F.col("non_fraud") + F.col("fraud")
    return _label_counts(df, label).select(
        F.try_divide(F.col("non_fraud"), F.col("fraud")).alias("scale_pos_weight"),
        F.try_divide(both, 2 * F.col("non_fraud")).alias("weight_negative"),
        F.try_divide(both, 2 * F.col("fraud")).alias("weight_positive"),
    )


def amount_by_class(df: DataFrame, label: str = LABEL, column: str = "amt", ddof: int = 0) -> DataFrame:
    """Eight amount statistics as rows, one column per class."""
    deviation = F.stddev_pop if ddof == 0 else F.stddev_samp
    known = df.filter(F.col(label).isin(0, 1) & F.col(column).isNotNull())
    spread = known.groupBy(label).agg(
        F.count(column).cast("double").alias("count"),
        F.avg(column).alias("mean"),
        deviation(column).alias("std"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
    )
    marks = histogram_quantiles(value_rows(known, [column], [label]), [0.25, 0.5, 0.75], [label])
    # two rows, one per class
    both = spread.join(marks, label).withColumnRenamed("q50", "median")
    metrics = ("count", "mean", "median", "std", "min", "max", "q25", "q75")
    lines = F.array(
        *[
            F.struct(F.lit(m).alias("metric"), round_half_even(F.col(m), 2).alias("value"))
            for m in metrics
        ]
    )
    return (
        both.select(label, F.inline(lines))
        .groupBy("metric")
        .agg(
            F.max(F.when(F.col(label) == 0, F.col("value"))).alias("non_fraud"),
            F.max(F.when(F.col(label) == 1, F.col("value"))).alias("fraud"),
        )
    )


def amount_class_difference(
    df: DataFrame, label: str = LABEL, column: str = "amt", threshold: float = 10.0
) -> DataFrame:
    """Difference of class means and medians, their direction, and whether the means differ clearly."""
    known = df.filter(F.col(label).isin(0, 1) & F.col(column).isNotNull())
    medians = histogram_quantiles(value_rows(known, [column], [label]), [0.5], [label])
    means = known.groupBy(label).agg(F.avg(column).alias("mean"))

    def gap(name: str) -> Column:
        positive = F.max(F.when(F.col(label) == 1, F.col(name)))
        return positive - F.max(F.when(F.col(label) == 0, F.col(name)))

    def side(name: str) -> Column:
        return F.when(F.col(name) > 0, "fraud higher").otherwise("fraud lower")

    return (
        means.join(medians, label)
        .agg(gap("mean").alias("mean_diff"), gap("q50").alias("median_diff"))
        .withColumn("mean_direction", side("mean_diff"))
        .withColumn("median_direction", side("median_diff"))
        .withColumn("significant", (F.abs("mean_diff") > threshold).cast("int"))
    )
