"""The most frequent values without a shuffled row per distinct value.

Each task keeps a Misra-Gries summary of bounded size per column. Merged, the summaries name every value that can be among
the most frequent, and one more scan counts just those. Counts are exact; whether the list is complete is proven from
the summaries' error, and where it cannot be proven, a larger summary and in the end a full count takes its place.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from riskloom.operators.prepare import top_values
from riskloom.session import write_table

#: Counters of a summary at first, and the most that are tried before all values are counted.
COUNTERS, MOST_COUNTERS = 1024, 65_536


def _shrunk(counts: dict[str, int], size: int) -> int:
    """Subtracts the count of the first value beyond ``size`` from all and drops what falls to 0: the summary's error."""
    if len(counts) <= size:
        return 0
    lost = sorted(counts.values(), reverse=True)[size]
    for value in [v for v, n in counts.items() if n <= lost]:
        del counts[value]
    for value in counts:
        counts[value] -= lost
    return lost


def summaries(df: DataFrame, columns: Sequence[str], counters: int = COUNTERS) -> DataFrame:
    """Tall ``(column, value, count, error)``: the summary of each task, and its error in a row with a null value.

    A count is at most the true one in the task, and misses it by no more than the error. Values without a
    counter occur no more often than the error.
    """
    names = list(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[dict[str, int]] = [{} for _ in names]
        errors = [0] * len(names)
        for batch in batches:
            for own, at in zip(found, range(len(names))):
                seen = pc.value_counts(batch.column(at).drop_null())
                for value, n in zip(seen.field(0).to_pylist(), seen.field(1).to_pylist()):
                    own[value] = own.get(value, 0) + n
                if len(own) > 4 * counters:
                    errors[at] += _shrunk(own, counters)
        rows = []
        for name, own, error in zip(names, found, errors):
            error += _shrunk(own, counters)
            rows += [(name, v, n, 0) for v, n in own.items()] + [(name, None, 0, error)]
        kinds = (pa.string(), pa.string(), pa.int64(), pa.int64())
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["column", "value", "count", "error"])

    texts = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in names])
    return texts.mapInArrow(run, "column string, value string, count long, error long")


def survivors(summary: DataFrame, top_n: int) -> DataFrame:
    """``(column, value, error)`` of all values that may be among the ``top_n``, and the error of the column.

    A value outside has a true count no larger than the error, or one below that of ``top_n`` others.
    """
    errors = summary.groupBy("column").agg(F.sum("error").alias("error"))
    merged = summary.filter(F.col("value").isNotNull()).groupBy("column", "value").agg(F.sum("count").alias("low"))
    place = F.row_number().over(Window.partitionBy("column").orderBy(F.desc("low")))
    nth = merged.withColumn("place", place).filter(F.col("place") == top_n).select("column", F.col("low").alias("nth"))
    # one row per column on these two sides
    return (
        merged.join(F.broadcast(errors), "column")
        .join(F.broadcast(nth), "column", "left")
        .filter(F.col("low") + F.col("error") >= F.coalesce("nth", F.lit(0)))
        .select("column", "value", "error")
    )


def heavy_values(df: DataFrame, columns: Sequence[str], top_n: int, counters: int = COUNTERS) -> DataFrame:
    """``(column, value, count, rank)``: the ``top_n`` most frequent non-null values of each column, ties to the smaller value.

    Same answer as ``prepare.top_values``. Three steps run when called: the summaries, the survivors and their counts are
    written, the last to be judged.
    """
    names = [c for c in columns if c in df.columns]
    counters = max(counters, top_n + 1)
    done = []
    while names and counters <= MOST_COUNTERS:
        summary = write_table(summaries(df, names, counters), "summaries")
        listed = write_table(survivors(summary, top_n), "survivors")
        exact = write_table(_counted(df, names, listed), "heavy")
        place = F.row_number().over(Window.partitionBy("column").orderBy(F.desc("count"), "value"))
        ranked = exact.withColumn("rank", place)
        judged = ranked.groupBy("column").agg(
            F.max("error").alias("error"), F.max(F.when(F.col("rank") == top_n, F.col("count"))).alias("nth")
        )
        marks = {r["column"]: (r["error"], r["nth"]) for r in judged.collect()}  # one row per column
        # no error: the summary held all values. Otherwise the last of the list must beat all that was left out
        proven = [c for c, (error, nth) in marks.items() if not error or (nth or 0) > error]
        empty = [c for c in names if c not in marks and not summary.filter((F.col("column") == c) & (F.col("error") > 0)).head(1)]
        if proven:
            done.append(ranked.filter(F.col("column").isin(proven) & (F.col("rank") <= top_n)).select("column", "value", "count", "rank"))
        names = [c for c in names if c not in proven and c not in empty]
        counters *= 8
    if names:
        done.append(top_values(df, names, top_n).select("column", "value", "count", "rank"))
    if not done:
        return df.sparkSession.createDataFrame([], "column string, value string, count long, rank int")
    rows = done[0]
    for more in done[1:]:
        rows = rows.unionByName(more)
    return rows


def _counted(df: DataFrame, columns: Sequence[str], listed: DataFrame) -> DataFrame:
    """Exact counts of the listed values: rows of other values end at the join, before any shuffle of counts."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns])
    tall = df.select(F.inline(pairs)).filter(F.col("value").isNotNull())
    # at most the counters of the tasks per column; written, so Spark knows its size
    return tall.join(listed, ["column", "value"]).groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("count"), F.max("error").alias("error")
    )


def modes(df: DataFrame, columns: Sequence[str], counters: int = COUNTERS) -> DataFrame:
    """``(column, most_common, most_common_count)``; ties go to the smaller value."""
    return heavy_values(df, columns, 1, counters).select(
        "column", F.col("value").alias("most_common"), F.col("count").alias("most_common_count")
    )
