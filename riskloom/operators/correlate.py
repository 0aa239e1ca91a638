"""Pearson correlations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame, Window, functions as F

from riskloom.operators.distribution import even_bins
from riskloom.schema import LABEL

#: Sums of one aggregate, which scans the table once.
SUMS_AT_ONCE = 400


def pair_correlations(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Tall ``(feature1, feature2, correlation)`` for the given column pairs.

    Each pair uses the rows where both values are known; a constant column, or no common row, gives null.
    The sums of products of the centred values are plain sums in ungrouped aggregates, so a task sends one
    row whatever nulls there are. A first pass counts the nulls and takes the means: sums over the rows where
    another column is known are only made for columns that have nulls.
    """
    if not pairs:
        return df.sparkSession.createDataFrame([], "feature1 string, feature2 string, correlation double")
    names = list(dict.fromkeys(c for pair in pairs for c in pair))
    at = {c: i for i, c in enumerate(names)}
    values = df.select(*[F.col(f"`{c}`").cast("double").alias(f"x{i}") for c, i in at.items()])
    facts = values.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count(f"x{i}").alias(f"n{i}") for i in at.values()],
        *[F.avg(f"x{i}").alias(f"m{i}") for i in at.values()],
    ).first()
    gaps = {i for i in at.values() if facts[f"n{i}"] < facts["n"]}
    centred = values.select(
        *[F.coalesce(F.col(f"x{i}") - F.lit(facts[f"m{i}"]), F.lit(0.0)).alias(f"d{i}") for i in at.values()],
        *[F.col(f"x{i}").isNotNull().cast("double").alias(f"k{i}") for i in gaps],
    )

    def total(term: str, *known: int) -> str:
        """A sum over the rows where the given columns are known."""
        factors = [term] if term else []
        return "sum(" + " * ".join(factors + [f"k{i}" for i in sorted(set(known) & gaps)] or ["1D"]) + ")"

    sums_of = {
        (a, b): (
            total("", i, j), total(f"d{i}", j), total(f"d{j}", i), total(f"d{i} * d{i}", j), total(f"d{j} * d{j}", i),
            total(f"d{min(i, j)} * d{max(i, j)}"),
        )
        for a, b in pairs
        for i, j in [(at[a], at[b])]
    }
    blocks: list[tuple[list, dict]] = [([], {})]
    for pair, sums in sums_of.items():
        lines, place = blocks[-1]
        if len(place) + len(sums) > SUMS_AT_ONCE:
            lines, place = [], {}
            blocks.append((lines, place))
        spots = [place.setdefault(s, len(place)) for s in sums]
        lines.append((*pair, *spots))
    parts = []
    for lines, place in blocks:
        made = centred.selectExpr(*[f"{s} AS s{i}" for s, i in place.items()])
        parts.append(
            made.selectExpr(
                "inline(array("
                + ", ".join(
                    f"named_struct('feature1', '{a}', 'feature2', '{b}', 'n', s{n}, 'sx', s{sx}, 'sy', s{sy}, "
                    f"'sxx', s{sxx}, 'syy', s{syy}, 'sxy', s{sxy})"
                    for a, b, n, sx, sy, sxx, syy, sxy in lines
                )
                + "))"
            )
        )
    return reduce(DataFrame.unionByName, parts).selectExpr(
        "feature1",
        "feature2",
        """try_divide(sxy - try_divide(sx * sy, n), sqrt(greatest(
             (sxx - try_divide(sx * sx, n)) * (syy - try_divide(sy * sy, n)), 0D))) AS correlation""",
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Correlation of every unordered pair of columns."""
    return pair_correlations(df, list(combinations(columns, 2)))


def target_correlations(
    df: DataFrame, columns: Sequence[str], label: str = LABEL
) -> DataFrame:
    """Correlation of each feature with the label, strongest first, with rank per sign."""
    pairs = [(c, label) for c in columns if c != label]
    found = (
        pair_correlations(df, pairs)
        .filter(F.col("correlation").isNotNull())
        .select(F.col("feature1").alias("feature"), "correlation")
    )
    sign = F.when(F.col("correlation") > 0, "positive").when(F.col("correlation") < 0, "negative")
    # one row per feature column
    # differences below 1e-9 are rounding noise of the sums and count as ties
    size = F.round("abs_correlation", 9)
    per_sign = Window.partitionBy("direction").orderBy(size.desc(), "feature")
    return (
        found.withColumn("abs_correlation", F.abs("correlation"))
        .withColumn("direction", F.coalesce(sign, F.lit("none")))
        .withColumn("direction_rank", F.row_number().over(per_sign))
        .orderBy(size.desc(), "feature")
    )


def high_correlation_pairs(matrix: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Pairs whose absolute correlation exceeds the threshold."""
    return matrix.filter(F.abs("correlation") > threshold)


def predictor_bands(target: DataFrame, strong: float = 0.05, weak: float = 0.01) -> DataFrame:
    """Label each feature as strong, medium or weak predictor by absolute correlation."""
    size = F.col("abs_correlation")
    band = F.when(size > strong, "strong").when(size < weak, "weak").otherwise("medium")
    return target.select("feature", "correlation", "abs_correlation", band.alias("band"))


def correlation_histogram(target: DataFrame, bins: int = 30) -> DataFrame:
    """How the feature correlations spread over equal bins between their extremes."""
    # one row per feature column
    everything = Window.partitionBy(F.lit(0))
    span = F.struct(
        F.min("correlation").over(everything).alias("low"),
        F.max("correlation").over(everything).alias("high"),
    )
    rows = target.select(F.col("correlation").alias("value"), F.lit(1).alias("n"), span.alias("_span"))
    return even_bins(rows, bins)
