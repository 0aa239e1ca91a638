"""Order statistics that scale: running totals, exact quantiles, codes in sort order, exact-n cuts.

A running total over a whole table in one sorted task does not scale. Here rows are first put into
bins whose order follows the sort order; windows total the bins level by level, and a last window runs
inside the finest bins only. Results are exact, and no window sees more rows than the bins allow.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.functions.numbers import sample_hash, value_bins
from riskloom.session import write_table

# Hash buckets of the exact-n cut: 2^18 of 2^32 hash values.
_BUCKET_WIDTH = 1 << 14


def running_totals(
    df: DataFrame, total: str, value: str, group: Sequence[str] = ()
) -> DataFrame:
    """Add ``<total>_before``, the sum of ``total`` over all smaller values of the group, and
    ``<total>_all``, the sum over the group. ``df`` has one row per group and value, not null."""
    group = list(group)
    binned = df.withColumns(value_bins(value))
    fine = binned.groupBy(*group, "_b1", "_b2").agg(F.sum(total).alias("_t"))
    coarse = fine.groupBy(*group, "_b1").agg(F.sum("_t").alias("_t"))

    def earlier(column: str, part: Sequence[str], order: str) -> Column:
        window = Window.partitionBy(*(part or [F.lit(0)])).orderBy(order)
        before = F.sum(column).over(window.rowsBetween(Window.unboundedPreceding, -1))
        return F.coalesce(before, F.lit(0))

    whole = Window.partitionBy(*(group or [F.lit(0)]))
    starts = coarse.select(
        *group,
        "_b1",
        earlier("_t", group, "_b1").alias("_start"),
        F.sum("_t").over(whole).alias(f"{total}_all"),
    )
    inner = fine.withColumn("_inner", earlier("_t", [*group, "_b1"], "_b2")).drop("_t")
    placed = inner.join(starts, [*group, "_b1"]).withColumn("_start", F.expr("_start + _inner"))
    return (
        binned.join(placed, [*group, "_b1", "_b2"])
        .withColumn("_own", earlier(total, [*group, "_b1", "_b2"], value))
        .withColumn(f"{total}_before", F.expr("_start + _own"))
        .drop("_b1", "_b2", "_start", "_inner", "_own")
    )


def value_rows(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Tall ``(by..., column, value, n)`` of non-null numeric values, with n = 1 on every row."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]
    )
    rows = df.select(*by, F.inline(pairs)).filter(F.col("value").isNotNull())
    return rows.withColumn("n", F.lit(1).cast("long"))


def value_histogram(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Tall ``(by..., column, value, n)`` of non-null numeric values. Equal values collapse before the
    shuffle, so a value held by a third of all rows costs one row per task."""
    rows = value_rows(df, columns, by)
    return rows.groupBy(*by, "column", "value").agg(F.sum("n").alias("n"))


def fill_levels(
    counted: DataFrame, level: str, first: int, last: int, sums: Sequence[str], group: Sequence[str] = ()
) -> DataFrame:
    """Complete counts per level to all levels ``first..last``, with 0 for the absent ones.

    ``counted`` has one row per group and level, so each group gathers a fixed, small number of rows.
    """
    entry = F.struct(F.col(level), F.struct(*sums))
    known = F.map_from_entries(F.collect_list(F.when(F.col(level).isNotNull(), entry)))
    return (
        counted.groupBy(*group)
        .agg(known.alias("_known"))
        .select(*group, "_known", F.explode(F.sequence(F.lit(first), F.lit(last))).alias(level))
        .selectExpr(
            *group, level, *[f"coalesce(try_element_at(_known, {level}).{s}, 0L) AS {s}" for s in sums]
        )
    )


def quantile_name(p: float) -> str:
    return f"q{round(p * 100):02d}"


def histogram_quantiles(
    histogram: DataFrame, probs: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Exact linear-interpolation quantiles from a ``value_histogram``: one row per (by, column).

    The rows are counted per bin (``n`` may also be 1 on every row), and only the bins that hold a wanted
    position are opened, at most two per probability, group and level. Their values are counted last, so no
    exchange carries a row per distinct value. Without ``by`` the lists of opened bins have a fixed bound and are broadcast.
    """
    group = [*by, "column"]
    small = (lambda rows: rows) if by else F.broadcast
    binned = histogram.withColumns(value_bins("value"))
    # quantile p stands at position (total - 1) * p, between its floor and its ceiling
    spots = {quantile_name(p): f"((_total - 1) * {float(p)}D)" for p in probs}
    ends = [f"cast({edge}({at}) AS bigint)" for at in spots.values() for edge in ("floor", "ceil")]
    hit = " OR ".join(f"(_from <= {end} AND {end} < _from + n)" for end in ends)

    def upto(part: Sequence[str], order: str) -> Column:
        window = Window.partitionBy(*part).orderBy(order)
        return F.sum("n").over(window.rowsBetween(Window.unboundedPreceding, 0))

    first = (
        binned.groupBy(*group, "_b1")
        .agg(F.sum("n").alias("n"))
        .withColumn("_total", F.sum("n").over(Window.partitionBy(*group)))
        .withColumn("_from", upto(group, "_b1") - F.col("n"))
        .filter(hit)
        .select(*group, "_b1", "_total", F.col("_from").alias("_base"))
    )
    second = (
        binned.join(small(first), [*group, "_b1"])
        .groupBy(*group, "_b1", "_b2", "_total", "_base")
        .agg(F.sum("n").alias("n"))
        .withColumn("_from", F.col("_base") + upto([*group, "_b1"], "_b2") - F.col("n"))
        .filter(hit)
        .select(*group, "_b1", "_b2", "_total", F.col("_from").alias("_base"))
    )
    opened = binned.join(small(second), [*group, "_b1", "_b2"])
    opened = opened.groupBy(*group, "_b1", "_b2", "_total", "_base", "value").agg(F.sum("n").alias("n"))
    placed = opened.withColumn(
        "_from", F.col("_base") + upto([*group, "_b1", "_b2"], "value") - F.col("n")
    )

    def value_at(end: str) -> str:
        return f"max(if(_from <= {end} AND {end} < _from + n, value, NULL))"

    picked = placed.groupBy(*group).agg(
        F.max("_total").alias("_total"),
        *[
            F.expr(value_at(f"cast({edge}({at}) AS bigint)")).alias(f"_{edge}_{name}")
            for name, at in spots.items()
            for edge in ("floor", "ceil")
        ],
    )
    return picked.selectExpr(
        *group,
        *[
            f"_floor_{q} + (_ceil_{q} - _floor_{q}) * ({at} - floor({at})) AS {q}"
            for q, at in spots.items()
        ],
    )


def quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Exact quantiles ``q25, q50, ...`` of several numeric columns, optionally per group."""
    return histogram_quantiles(value_rows(df, columns, by), probs, by)


def spaced_values(df: DataFrame, columns: Sequence[str], parts: int) -> DataFrame:
    """``(column, place, value)``: the values at positions ``floor(place * (rows - 1) / parts)`` of each sorted column, for
    places from 0 to ``parts``. Exact, like ``quantiles``, with one condition however many places are asked for."""
    binned = value_rows(df, columns).withColumns(value_bins("value"))
    group = ["column"]

    def upto(part: Sequence[str], order: str) -> Column:
        return F.sum("n").over(Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))

    # the first place at or behind position _from, and whether its position is before the end of the bin
    step = "greatest(_total - 1, 1)"
    first_place = f"((_from * {parts} + {step} - 1) div {step})"
    hit = f"{first_place} <= {parts} AND ({first_place} * (_total - 1)) div {parts} < _from + n"
    first = (
        binned.groupBy(*group, "_b1")
        .agg(F.sum("n").alias("n"))
        .withColumn("_total", F.sum("n").over(Window.partitionBy(*group)))
        .withColumn("_from", upto(group, "_b1") - F.col("n"))
        .filter(hit)
        .select(*group, "_b1", "_total", F.col("_from").alias("_base"))
    )
    # at most a row per place and column on each of the two sides
    second = (
        binned.join(F.broadcast(first), [*group, "_b1"])
        .groupBy(*group, "_b1", "_b2", "_total", "_base")
        .agg(F.sum("n").alias("n"))
        .withColumn("_from", F.col("_base") + upto([*group, "_b1"], "_b2") - F.col("n"))
        .filter(hit)
        .select(*group, "_b1", "_b2", "_total", F.col("_from").alias("_base"))
    )
    opened = binned.join(F.broadcast(second), [*group, "_b1", "_b2"])
    opened = opened.groupBy(*group, "_b1", "_b2", "_total", "_base", "value").agg(F.sum("n").alias("n"))
    placed = opened.withColumn("_from", F.col("_base") + upto([*group, "_b1", "_b2"], "value") - F.col("n")).filter(hit)
    # all places whose position falls on the value; a single row is at every place
    last_place = f"least({parts}, if(_total = 1, {parts}, ((_from + n) * {parts} - 1) div {step}))"
    return placed.selectExpr("column", f"explode(sequence({first_place}, {last_place})) AS place", "value")


def approx_quantiles(
    df: DataFrame, column: str, probs: Sequence[float], accuracy: int = 10000
) -> DataFrame:
    """Sketch-based quantiles in a single pass, for exploratory use on very large tables."""
    found = df.agg(F.approx_percentile(column, [float(p) for p in probs], accuracy).alias("_q"))
    return found.select(
        F.lit(column).alias("column"),
        *[F.col("_q")[i].alias(quantile_name(p)) for i, p in enumerate(probs)],
    )


def dense_codes(values: DataFrame, numeric: Iterable[str] = ()) -> DataFrame:
    """Codes 0..n-1 in sort order for a tall ``(column, value)`` table of distinct values.

    Columns in ``numeric`` sort as numbers (a value that is no number goes last), the others as text.
    The values are range-partitioned and written, which fixes the parts; a value's code is the size of
    the earlier parts plus its place in its own part.
    """
    numeric = list(numeric)
    is_number = F.col("column").isin(*numeric) if numeric else F.lit(False)
    number = F.coalesce(F.col("value").try_cast("double"), F.lit(float("inf")))
    keyed = values.withColumn("_number", F.when(is_number, number).otherwise(F.lit(0.0)))
    parts = write_table(
        keyed.repartitionByRange("column", "_number", "value").withColumn(
            "_part", F.spark_partition_id()
        ),
        "sorted-values",
    )
    before = Window.partitionBy("column").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        parts.groupBy("column", "_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("column", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    place = F.row_number().over(Window.partitionBy("column", "_part").orderBy("_number", "value"))
    # one row per column and part
    return parts.join(offsets, ["column", "_part"]).select(
        "column", "value", (F.col("_offset") + place - 1).cast("long").alias("code")
    )


def hash_cut(
    df: DataFrame, label: str, row_id: str, wanted: DataFrame, seed: int = 42
) -> DataFrame:
    """Per label the last (hash, id) of the ``n`` rows with the smallest hashes.

    ``wanted`` has ``(label, n)``, one row per class of a two-class label. A row belongs to the sample exactly when its (hash, id) does not
    exceed the cut, so the sample itself is a plain filter: the wide rows are never shuffled or sorted.
    The cut is found from bucket counts and from the ids of one bucket per label.
    """
    hashed = df.select(label, F.col(row_id).alias("_id"), sample_hash(df, row_id, seed).alias("_hash"))
    bucket = F.floor(F.col("_hash") / _BUCKET_WIDTH).cast("long")
    per_bucket = hashed.groupBy(label, bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy(label).orderBy("_bucket")
    edge = (
        per_bucket.withColumn("_upto", F.sum("_n").over(upto))
        .withColumn("_all", F.sum("_n").over(Window.partitionBy(label)))
        .join(F.broadcast(wanted.select(label, "n")), label)
        .withColumn("n", F.least("n", "_all"))
        .filter((F.col("n") > F.col("_upto") - F.col("_n")) & (F.col("n") <= F.col("_upto")))
        .select(label, "_bucket", (F.col("n") - (F.col("_upto") - F.col("_n"))).alias("_need"))
    )
    in_bucket = Window.partitionBy(label).orderBy("_hash", "_id")
    return (
        hashed.withColumn("_bucket", bucket)
        .join(F.broadcast(edge), [label, "_bucket"])
        .withColumn("_place", F.row_number().over(in_bucket))
        .filter(F.col("_place") == F.col("_need"))
        .select(label, F.col("_hash").alias("_cut_hash"), F.col("_id").alias("_cut_id"))
    )


def within_cut(df: DataFrame, row_id: str, seed: int = 42) -> Column:
    """True for rows at or before the joined cut; null (no cut for the label) counts as false."""
    spread = sample_hash(df, row_id, seed)
    inside = (spread < F.col("_cut_hash")) | (
        (spread == F.col("_cut_hash")) & (F.col(row_id) <= F.col("_cut_id"))
    )
    return F.coalesce(inside, F.lit(False))
