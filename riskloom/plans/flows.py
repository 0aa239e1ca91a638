"""Whole flows: preparation, cleansing, encoding and features, as chains of operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from riskloom.operators.cleanse import (
    add_age,
    drop_columns,
    drop_duplicates_keep_first,
    impute_age,
)
from riskloom.operators.encode import (
    collect_vocabulary,
    fit_labels,
    label_encode,
    onehot_encode,
    onehot_vectors,
    onehot_vocabulary,
)
from riskloom.operators.features import add_amount_features, add_interactions, add_time_features
from riskloom.operators.prepare import (
    clean_text_columns,
    fit_top_values,
    reduce_categories,
    transform,
)
from riskloom.schema import DROPPED, ONE_HOT, REDUCED
from riskloom.session import write_table


def prepare(df: DataFrame, top_n: int = 50) -> DataFrame:
    """Text cleanup, category reduction, calendar parts, coordinate check.

    The cleaned rows are written once; counting the values, finding copies and the rows themselves all read
    that table.
    """
    rows = clean_text_columns(df)
    if set(REDUCED) & set(rows.columns):
        rows = write_table(rows, "cleaned")
        rows = reduce_categories(rows, fit_top_values(rows, top_n=top_n))
    return transform(rows)


def cleanse(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Remove copies, derive the age and drop the columns that must not reach a model.

    Copies are found on the reduced merchant, as the steps follow each other. The rows are written
    once, before the median age, the vocabularies, the amount statistics and the features each read
    their few columns of them.
    """
    unique = add_age(drop_duplicates_keep_first(df))
    kept = drop_columns(unique, [c for c in DROPPED if c not in keep])
    return impute_age(write_table(kept, "cleansed"))


def encode(df: DataFrame, vectors: bool = False) -> DataFrame:
    """One-hot and label encoding with vocabularies learned from ``df``.

    ``vectors`` gives a sparse vector per column instead of a column per value, and no vocabulary reaches the driver.
    """
    labels = fit_labels(df)
    if vectors:
        wide = onehot_vectors(df, fit_labels(df, ONE_HOT))
    else:
        wide = onehot_encode(df, collect_vocabulary(onehot_vocabulary(df)))
    return label_encode(wide, labels)


def engineer(df: DataFrame) -> DataFrame:
    """Time, amount and interaction features."""
    return add_interactions(add_amount_features(add_time_features(df)))


def feature_table(df: DataFrame, top_n: int = 50, keep: Sequence[str] = ()) -> DataFrame:
    """Raw transactions to model features."""
    return engineer(encode(cleanse(prepare(df, top_n), keep)))
