"""CSV, JSON and Parquet scans and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from riskloom.functions.numbers import sample_hash


def scan_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with a header and a declared schema: one pass, no inference."""
    return spark.read.csv(path, schema=schema, header=True, enforceSchema=True)


def scan_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    table = spark.read.parquet(path)
    return table.select(*columns) if columns else table


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)


def write_report(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """A finished report or encoding map as CSV or JSON lines."""
    if fmt == "csv":
        write_csv(df, path)
    elif fmt == "json":
        df.write.mode("overwrite").json(path)
    else:
        raise ValueError(f"unknown report format {fmt!r}")


def read_report(spark: SparkSession, path: str, schema: StructType, fmt: str = "csv") -> DataFrame:
    return scan_csv(spark, path, schema) if fmt == "csv" else spark.read.schema(schema).json(path)


def csv_to_parquet(spark: SparkSession, source: str, target: str, schema: StructType) -> DataFrame:
    """Convert CSV to snappy Parquet under one forced schema and return the new table."""
    write_parquet(scan_csv(spark, source, schema), target)
    return spark.read.schema(schema).parquet(target)


def head_rows(df: DataFrame, n: int, order_by: str) -> DataFrame:
    """The first ``n`` rows in a stated order; a table has no order of its own."""
    return df.orderBy(order_by).limit(n)


def bernoulli_rows(df: DataFrame, fraction: float, row_id: str, seed: int = 42) -> DataFrame:
    """Keep each row with the given probability.

    The draw is a hash of the row id, so a re-run task or a different partitioning picks the same
    rows, and the scan keeps its narrow plan.
    """
    return df.filter(below_fraction(df, row_id, fraction, seed))


def below_fraction(df: DataFrame, row_id: str, fraction: float, seed: int = 42) -> Column:
    return sample_hash(df, row_id, seed) < F.lit(int(fraction * 4294967296))


def row_count(df: DataFrame) -> DataFrame:
    """Number of rows as a one-row table; over Parquet it reads no column."""
    return df.agg(F.count(F.lit(1)).alias("rows"))


def footer_facts(spark: SparkSession, path: str, columns: Sequence[str] = ()) -> DataFrame:
    """``rows`` and, of number and date columns, ``min_<column>`` and ``max_<column>``, from Parquet footers alone.

    No data page is read. The session's own settings stay as they are: the scan belongs to a session of the same
    application in which Parquet is a source with aggregate pushdown.
    """
    own = spark.newSession()
    kinds = own.conf.get("spark.sql.sources.useV1SourceList").split(",")
    own.conf.set("spark.sql.sources.useV1SourceList", ",".join(k for k in kinds if k != "parquet"))
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    bounds = [f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))]
    return own.read.parquet(path).agg(F.count(F.lit(1)).alias("rows"), *bounds)
