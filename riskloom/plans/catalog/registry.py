"""Registration of queries together with the SQL that another engine can check them with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, DoubleType, IntegerType

from riskloom.functions.numbers import round_half_even

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

DIGITS = 6


def tidy(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Comparable output: integers as bigint, doubles rounded, dates as text."""
    out = []
    for field in df.schema:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, IntegerType):
            col = col.cast("long")
        elif isinstance(field.dataType, DoubleType):
            col = round_half_even(col, digits)
        elif isinstance(field.dataType, DateType):
            col = col.cast("string")
        out.append(col.alias(field.name))
    return df.select(*out)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register ``(spark, sf_dir) -> DataFrame`` under a key, with its oracle SQL if there is one."""
    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return tidy(function(spark, sf_dir))

        run.__name__, run.__doc__ = name, function.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register
