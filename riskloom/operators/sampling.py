"""Stratified samples and splits of exact size, Bernoulli strata and sample checks.

Strata are the few classes of the label. Membership is decided by a hash of the row id, so a task that
runs again picks the same rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.functions.numbers import safe_ratio, sample_hash
from riskloom.operators.ordered import hash_cut, within_cut
from riskloom.schema import LABEL, ROW_ID
from riskloom.sources.files import below_fraction


def sample_plan(df: DataFrame, size: int, label: str = LABEL) -> DataFrame:
    """One row: class totals, the target count per class and the sampling rates.

    Labels other than 0 and 1, null among them, belong to no class and are refused.
    """
    counted = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col(label) == 1).alias("total_fraud"),
        F.count_if(F.col(label) == 0).alias("total_legit"),
    )
    two_classes = F.col("total_fraud") + F.col("total_legit") == F.col("total_rows")
    refused = F.raise_error(F.lit(f"{label} holds values other than 0 and 1"))
    counted = counted.withColumn("total_rows", F.when(two_classes, F.col("total_rows")).otherwise(refused.cast("long")))
    ratio = safe_ratio(F.col("total_fraud"), F.col("total_rows"))
    return (
        counted.withColumn("fraud_ratio", ratio)
        .withColumn("target_fraud", F.floor(F.lit(size) * F.col("fraud_ratio")).cast("long"))
        .withColumn("target_legit", F.lit(size).cast("long") - F.col("target_fraud"))
        .withColumn("fraud_rate", safe_ratio(F.col("target_fraud"), F.col("total_fraud")))
        .withColumn("legit_rate", safe_ratio(F.col("target_legit"), F.col("total_legit")))
    )


def _targets(df: DataFrame, size: int, label: str) -> DataFrame:
    """``(label, n)``: how many rows each class contributes to a sample of ``size``."""
    plan = sample_plan(df, size, label)
    return _per_class(
        plan.select(F.col("target_legit").alias("_n0"), F.col("target_fraud").alias("_n1")), df, label
    )


def _per_class(counts: DataFrame, df: DataFrame, label: str) -> DataFrame:
    """``(label, n)``, two rows, from one row ``(_n0, _n1)``. Two rows are always fit to broadcast."""
    kind = df.schema[label].dataType
    lines = [
        F.struct(F.lit(value).cast(kind).alias(label), F.col(f"_n{value}").alias("n"))
        for value in (0, 1)
    ]
    return counts.select(F.inline(F.array(*lines)))


def stratified_sample(
    df: DataFrame, size: int, label: str = LABEL, row_id: str = ROW_ID, seed: int = 42
) -> DataFrame:
    """Exactly ``size`` rows with the class ratio of the table (a class gives at most all its rows)."""
    cut = hash_cut(df, label, row_id, _targets(df, size, label), seed)
    # one cut per class
    return (
        df.join(F.broadcast(cut), label).filter(within_cut(df, row_id, seed)).select(*df.columns)
    )


def stratified_cap(
    df: DataFrame, size: int, label: str = LABEL, row_id: str = ROW_ID, seed: int = 42
) -> DataFrame:
    """Down-sample to ``size`` rows when there are more; keep everything otherwise."""
    cut = hash_cut(df, label, row_id, _targets(df, size, label), seed)
    total = df.agg(F.count(F.lit(1))).scalar()
    return (
        df.join(F.broadcast(cut), label, "left")
        .filter((total <= size) | within_cut(df, row_id, seed))
        .select(*df.columns)
    )


def stratified_split(
    df: DataFrame,
    test_size: float = 0.2,
    label: str = LABEL,
    row_id: str = ROW_ID,
    seed: int = 42,
    names: tuple[str, str] = ("train", "test"),
) -> DataFrame:
    """Mark each row as train or test; every class gives the same share to the test part."""
    def share(value: int) -> Column:
        rows = F.count_if(F.col(label) == value) * F.lit(float(test_size))
        return F.round(rows).cast("long")

    wanted = _per_class(df.agg(share(0).alias("_n0"), share(1).alias("_n1")), df, label)
    cut = hash_cut(df, label, row_id, wanted, seed)
    return (
        df.join(F.broadcast(cut), label, "left")
        .withColumn("split", F.when(within_cut(df, row_id, seed), names[1]).otherwise(names[0]))
        .select(*df.columns, "split")
    )


def split_check(split: DataFrame, label: str = LABEL, tolerance: float = 0.001) -> DataFrame:
    """Rows, positives and rate per part, and whether the rates agree within the tolerance."""
    parts = split.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(label).alias("fraud"),
        F.avg(label).alias("fraud_rate"),
    )
    spread = parts.agg(F.max("fraud_rate") - F.min("fraud_rate")).scalar()
    return parts.withColumn("rates_match", (spread <= tolerance).cast("int"))


def sample_by(
    df: DataFrame,
    fractions: Mapping[int, float],
    label: str = LABEL,
    row_id: str = ROW_ID,
    seed: int = 42,
) -> DataFrame:
    """Approximate strata: keep each row with the probability of its class; absent classes give none."""
    keep = F.lit(False)
    for value, fraction in fractions.items():
        keep = keep | ((F.col(label) == value) & below_fraction(df, row_id, fraction, seed))
    return df.filter(keep)


def sample_check(df: DataFrame, sample: DataFrame, label: str = LABEL) -> DataFrame:
    """Realised class counts and rate of a sample against the table it was drawn from."""
    original = df.agg(F.avg(label)).scalar()
    return (
        sample.agg(
            F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum(label), F.lit(0)).alias("fraud"),
            F.avg(label).alias("sample_rate"),
        )
        .withColumn("original_rate", original)
        .withColumn("rate_diff", F.abs(F.col("sample_rate") - F.col("original_rate")))
    )


def rows_in_sample(df: DataFrame, sample: DataFrame, row_id: str = ROW_ID) -> DataFrame:
    """Semi join: the full rows whose id is in the sample."""
    return df.join(sample.select(row_id).distinct(), row_id, "left_semi")


def union_ids(*samples: DataFrame, row_id: str = ROW_ID) -> DataFrame:
    """Distinct row ids of several samples."""
    ids = samples[0].select(row_id)
    for other in samples[1:]:
        ids = ids.unionByName(other.select(row_id))
    return ids.distinct()


def union_strata(*strata: DataFrame) -> DataFrame:
    """All rows of several strata with matching column names."""
    rows = strata[0]
    for other in strata[1:]:
        rows = rows.unionByName(other)
    return rows


def shuffle_rows(df: DataFrame, row_id: str = ROW_ID, seed: int = 42) -> DataFrame:
    """Random but repeatable row order: a range-partitioned sort on the hash of the id."""
    return df.orderBy(sample_hash(df, row_id, seed), row_id)
