"""One-hot and label encoding: learn a vocabulary, then apply it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType

from riskloom.operators.ordered import dense_codes
from riskloom.operators.prepare import value_counts
from riskloom.schema import LABEL_CODED, ONE_HOT
from riskloom.session import write_table

UNKNOWN = "unknown"
#: Columns with more values than this are joined instead of looked up in maps, and the buckets that keep maps short: Spark
#: searches a map from its start.
MAP_LIMIT, MAP_BUCKETS = 20_000, 256


def onehot_vocabulary(df: DataFrame, columns: Sequence[str] = ONE_HOT) -> DataFrame:
    """Tall ``(column, value, column_name)`` of the distinct non-null values."""
    return value_counts(df, columns).select(
        "column", "value", F.concat_ws("_", "column", "value").alias("column_name")
    )


def onehot_mapping(vocabulary: DataFrame) -> DataFrame:
    """The documentation record per column: sorted values and generated column names."""
    return vocabulary.groupBy("column").agg(
        F.lit("one-hot").alias("encoding_type"),
        F.array_sort(F.collect_set("value")).alias("unique_values"),
        F.count(F.lit(1)).alias("num_columns_created"),
        F.array_sort(F.collect_set("column_name")).alias("column_names"),
    )


def collect_vocabulary(vocabulary: DataFrame) -> dict[str, list[str]]:
    """Bring the vocabulary to the driver, where it becomes column names of the wide form.

    A table with a column per value needs their names in its schema. For columns with very many values ask
    for ``onehot_vectors`` instead, which collects nothing.
    """
    found: dict[str, list[str]] = {}
    for row in sorted((r["column"], r["value"]) for r in vocabulary.select("column", "value").collect()):
        found.setdefault(row[0], []).append(row[1])
    return found


def onehot_encode(df: DataFrame, vocabulary: Mapping[str, Sequence[str]]) -> DataFrame:
    """One 0/1 column per known value in place of the source column. Null and unseen values give zeros."""
    pairs = [(c, v) for c, values in vocabulary.items() if c in df.columns for v in values]
    columns = df.columns
    made = [
        F.equal_null(F.col(c).cast("string"), F.lit(v)).cast("int").alias(f"{c}_{v}") for c, v in pairs
    ]
    return df.select(*[c for c in columns if c not in vocabulary], *made)


def onehot_vectors(df: DataFrame, vocabulary: DataFrame, columns: Sequence[str] = ONE_HOT) -> DataFrame:
    """One sparse vector ``<column>_onehot`` in place of each source column, for any number of values.

    ``vocabulary`` is a written label vocabulary (``fit_labels``); its codes are the places in the vector.
    Unseen values give zeros.
    """
    present = [c for c in columns if c in df.columns]
    coded = label_encode(df, vocabulary, present)
    for name in present:
        codes = vocabulary.filter(F.col("column") == name).select(F.col("code").cast("double").alias("_place"))
        # one more place, for unseen values, which the encoder leaves out as the last
        unseen = codes.agg((F.coalesce(F.max("_place"), F.lit(-1.0)) + 1).alias("_place"))
        encoder = OneHotEncoder(inputCol="_place", outputCol=f"{name}_onehot", dropLast=True).fit(codes.union(unseen))
        place = F.when(F.col(f"{name}_encoded") >= 0, F.col(f"{name}_encoded")).otherwise(unseen.scalar())
        coded = encoder.transform(coded.withColumn("_place", place.cast("double"))).drop("_place", f"{name}_encoded")
    return coded


def label_vocabulary(df: DataFrame, columns: Sequence[str] = LABEL_CODED) -> DataFrame:
    """Tall ``(column, value, code)``: sorted distinct values, null as ``'unknown'``, codes from 0.

    Number columns sort as numbers. Even a very large vocabulary is not sorted in one task.
    """
    present = [c for c in columns if c in df.columns]
    numeric = [f.name for f in df.schema if f.name in present and isinstance(f.dataType, NumericType)]
    filled = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN)).alias(c) for c in present])
    return dense_codes(value_counts(filled, present).select("column", "value"), numeric)


def fit_labels(df: DataFrame, columns: Sequence[str] = LABEL_CODED) -> DataFrame:
    """The vocabulary as a written table, the artefact that later rows are encoded with."""
    return write_table(label_vocabulary(df, columns), "label-vocabulary")


def label_mapping(vocabulary: DataFrame, sample: int = 10) -> DataFrame:
    """The documentation record per column: number of values and the first values in code order."""
    first = F.when(F.col("code") < sample, F.struct("code", "value"))
    return vocabulary.groupBy("column").agg(
        F.lit("label").alias("encoding_type"),
        F.count(F.lit(1)).alias("num_unique_values"),
        F.transform(F.array_sort(F.collect_list(first)), lambda pair: pair["value"]).alias(
            "sample_values"
        ),
    )


def label_encode(
    df: DataFrame, vocabulary: DataFrame, columns: Sequence[str] = LABEL_CODED, map_limit: int = MAP_LIMIT
) -> DataFrame:
    """Replace each column by ``<column>_encoded``; unseen values give -1.

    Use a written vocabulary (``fit_labels``): its size on disk is known. All columns with at most ``map_limit`` values are
    looked up in one pass over the rows, in maps that reach them as scalar subqueries. The columns with more values are joined one
    by one; Spark broadcasts their codes below the threshold and shuffles beyond it. Counting the values runs a job.
    """
    present = [c for c in columns if c in df.columns]
    sizes = {r["column"]: r["count"] for r in vocabulary.groupBy("column").count().collect()} if present else {}
    mapped = [c for c in present if sizes.get(c, 0) <= map_limit]
    filled = {c: F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN)) for c in present}

    def bucket(value: Column) -> Column:
        return F.pmod(F.xxhash64(value), F.lit(MAP_BUCKETS)).cast("int")

    def code(name: str) -> Column:
        own = vocabulary.filter(F.col("column") == name)
        short = own.groupBy(bucket(F.col("value")).alias("_bucket")).agg(
            F.map_from_entries(F.collect_list(F.struct("value", F.col("code").cast("long")))).alias("_codes")
        )
        whole = short.agg(F.map_from_entries(F.collect_list(F.struct("_bucket", "_codes"))).alias("_maps")).scalar()
        found = F.try_element_at(F.try_element_at(whole, bucket(filled[name])), filled[name])
        return F.coalesce(found, F.lit(-1).cast("long"))

    df = df.withColumns({f"{c}_encoded": code(c) for c in mapped}).drop(*mapped)
    for name in present:
        if name in mapped:
            continue
        own = vocabulary.filter(F.col("column") == name).select(
            F.col("value").alias("_value"), F.col("code").alias("_code")
        )
        df = (
            df.join(own, filled[name] == F.col("_value"), "left")
            .withColumn(f"{name}_encoded", F.coalesce("_code", F.lit(-1)).cast("long"))
            .drop("_value", "_code", name)
        )
    return df
