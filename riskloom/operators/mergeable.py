"""Profiles that grow with the files: one stored state per file and column, merged when asked.

A state is moments, extremes and two sketches (quantiles and distinct values), some kilobytes whatever the file's size.
A file that is added later is the only one that is read; the profile of the whole is the merge of all states.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.operators.profile import numeric_columns

#: Size parameters of the sketches: rank error of quantiles below 0.5 %, of distinct counts about 1.6 %.
QUANTILE_SIZE, DISTINCT_BITS = 800, 12
_PART = "source"


def file_states(df: DataFrame, columns: Sequence[str] | None = None, by: str | None = None) -> DataFrame:
    """Tall states ``(source, column, rows, known, mean, m2, low, high, marks, distinct)``, one pass over the rows.

    ``by`` names a column that tells the sources apart; by default it is the file a row was read from.
    """
    columns = list(columns or numeric_columns(df))
    source = F.col(by) if by else F.input_file_name()
    rows = df.select(source.cast("string").alias(_PART), *[F.col(f"`{c}`").cast("double").alias(c) for c in columns])
    each = [
        F.struct(
            F.lit(c).alias("column"),
            F.count(F.lit(1)).alias("rows"),
            F.count(c).alias("known"),
            F.avg(c).alias("mean"),
            (F.var_pop(c) * F.count(c)).alias("m2"),
            F.min(c).alias("low"),
            F.max(c).alias("high"),
            F.kll_sketch_agg_double(F.col(c), QUANTILE_SIZE).alias("marks"),
            F.hll_sketch_agg(F.col(c).cast("string"), DISTINCT_BITS).alias("distinct"),
        ).alias(f"_{i}")
        for i, c in enumerate(columns)
    ]
    packed = rows.groupBy(_PART).agg(*each)
    return packed.select(_PART, F.inline(F.array(*[f"_{i}" for i in range(len(columns))])))


def merge_states(states: DataFrame) -> DataFrame:
    """One state per column. The order of merging does not matter beyond rounding."""
    spread = F.sum(F.col("known") * F.coalesce(F.col("mean") * F.col("mean"), F.lit(0.0)))
    merged = states.groupBy("column").agg(
        F.sum("rows").alias("rows"),
        F.sum("known").alias("known"),
        F.try_divide(F.sum(F.col("known") * F.coalesce("mean", F.lit(0.0))), F.sum("known")).alias("mean"),
        F.sum(F.coalesce("m2", F.lit(0.0))).alias("_within"),
        spread.alias("_spread"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.kll_merge_agg_double(F.col("marks")).alias("marks"),
        F.hll_union_agg(F.col("distinct")).alias("distinct"),
    )
    between = F.greatest(F.col("_spread") - F.col("known") * F.col("mean") * F.col("mean"), F.lit(0.0))
    return merged.withColumn("m2", F.col("_within") + between).drop("_within", "_spread")


def profile_of(states: DataFrame, probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Rows, missing, mean, deviation, extremes, about-quantiles and about-distinct of each column."""
    merged = merge_states(states)
    marks = [
        F.when(F.col("known") > 0, F.kll_sketch_get_quantile_double("marks", F.lit(float(p)))).alias(f"about_q{round(p * 100):02d}")
        for p in probs
    ]
    return merged.select(
        "column",
        "rows",
        (F.col("rows") - F.col("known")).alias("missing"),
        "mean",
        F.sqrt(F.try_divide(F.col("m2"), F.col("known").cast("double"))).alias("std"),
        F.col("low").alias("min"),
        F.col("high").alias("max"),
        *marks,
        F.hll_sketch_estimate("distinct").alias("about_distinct"),
    )


class ProfileStore:
    """States of the Parquet files of a folder, kept below ``path``. Files never change once they are written.

    With ``folders`` a source is a folder below that one, with all its files, which many tasks may have written.
    """

    def __init__(self, spark: SparkSession, path: str, columns: Sequence[str] | None = None, folders: bool = False):
        self.spark, self.path, self.columns, self.folders = spark, path, columns, folders

    def states(self) -> DataFrame | None:
        from pyspark.errors import AnalysisException

        try:
            return self.spark.read.parquet(self.path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def refresh(self, folder: str) -> int:
        """Reads the sources that have no state yet and adds theirs; returns how many. Two refreshes at once must not run."""
        reader = self.spark.read.option("recursiveFileLookup", str(self.folders).lower())
        found: dict[str, list[str]] = {}
        for file in reader.parquet(folder).inputFiles():
            found.setdefault(file.rsplit("/", 1)[0] if self.folders else file, []).append(file)
        known = self.states()
        if known is not None:
            for r in known.select(_PART).distinct().collect():
                found.pop(r[_PART], None)
        if found:
            rows = self.spark.read.parquet(*sorted(f for own in found.values() for f in own))
            columns = list(self.columns or numeric_columns(rows))
            source = F.regexp_replace(F.input_file_name(), "/[^/]*$", "") if self.folders else F.input_file_name()
            states = file_states(rows.select(source.alias("_from"), *columns), columns, "_from")
            states.coalesce(1).write.mode("append").parquet(self.path)
        return len(found)

    def profile(self) -> DataFrame:
        """The profile of all files with a state."""
        states = self.states()
        if states is None:
            raise ValueError("no file has been read yet")
        return profile_of(states)
