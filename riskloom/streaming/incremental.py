"""Passes that continue where they stopped: keep-first deduplication and an exact stratified sample over a stream.

Both keep their state as tables, one version for each micro-batch below a folder of their own. A batch that runs again
after a failure reads the version before it and writes the same rows once more, so its output never doubles and nothing
depends on which executor is lost. Input that arrives in many files gives the same result as one batch job over all.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from riskloom.functions.numbers import sample_hash
from riskloom.schema import DEDUP_KEY, LABEL, ROW_ID


def _version(path: str, number: int) -> str:
    return f"{path}/batch={number:012d}"


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def run_batches(stream: DataFrame, checkpoint: str, work: Callable[[DataFrame, int], None]) -> None:
    """Hands all available input to ``work`` in micro-batches; a restart goes on after the last whole one."""
    query = (
        stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


# ---- keep-first


def run_keep_first(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    key: Sequence[str] = DEDUP_KEY,
    order_by: str = ROW_ID,
    clock: str | None = None,
    window: int = 0,
) -> None:
    """Appends to ``target`` the rows whose key did not occur before. Null equals null.

    Within a micro-batch the row with the smallest ``order_by`` stays. Seen keys are kept as a 128-bit digest below ``target``
    with the latest ``clock`` (a whole number, such as seconds) of their batch. With ``window`` the keys of batches that lie more
    than that behind the newest clock are no longer looked at, which bounds the state; copies must then arrive within the window. The
    result equals the batch pass if the first of all copies arrives in an earlier micro-batch than the others, or in the same.
    """
    spark = stream.sparkSession
    rows_at, keys_at = f"{target}/rows", f"{target}/keys"
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in key]
    digest = F.sha2(F.concat_ws("\x1f", *parts), 256)

    def work(batch: DataFrame, number: int) -> None:
        own = batch.withColumn("_digest", F.substring(digest, 1, 32))
        place = F.row_number().over(Window.partitionBy("_digest").orderBy(order_by))
        first = own.withColumn("_place", place).filter(F.col("_place") == 1).drop("_place")
        seen = _read(spark, keys_at)
        if seen is not None:
            seen = seen.filter(F.col("batch") < number)  # a batch that runs again does not meet its own keys
            if clock and window:
                newest = batch.agg(F.max(clock)).first()[0]
                if newest is not None:
                    # whole versions are left out by their partition's clock; the newest batch decides alone
                    seen = seen.filter(F.col("at") >= newest - window)
            first = first.join(seen.select("_digest").distinct(), "_digest", "left_anti")
        first.drop("_digest").write.mode("overwrite").parquet(_version(rows_at, number))
        at = F.max(clock).cast("long") if clock else F.lit(0).cast("long")
        own.groupBy("_digest").agg(at.alias("at")).write.mode("overwrite").parquet(_version(keys_at, number))

    run_batches(stream, checkpoint, work)


def kept_rows(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(f"{target}/rows").drop("batch")


# ---- stratified sample


def run_sample(
    stream: DataFrame, target: str, checkpoint: str, size: int, label: str = LABEL, row_id: str = ROW_ID, seed: int = 42
) -> None:
    """Keeps, per class, the ``size`` rows with the smallest hashes, and the class totals, below ``target``.

    Such a state merges in any order: whatever a class may give to a sample of ``size`` is among them. Only the last two versions
    are read again, the rows of older ones may be removed.
    """
    spark = stream.sparkSession
    state_at, totals_at = f"{target}/state", f"{target}/totals"

    def before(path: str, number: int) -> DataFrame | None:
        return _read(spark, _version(path, number - 1)) if number else None

    def work(batch: DataFrame, number: int) -> None:
        counts = batch.groupBy(label).agg(F.count(F.lit(1)).alias("rows"))
        old = before(totals_at, number)
        counts = counts if old is None else counts.unionByName(old)
        counts.groupBy(label).agg(F.sum("rows").alias("rows")).coalesce(1).write.mode("overwrite").parquet(_version(totals_at, number))
        rows, old = batch, before(state_at, number)
        rows = rows if old is None else rows.unionByName(old)
        place = F.row_number().over(Window.partitionBy(label).orderBy("_at", row_id))
        # tasks drop what cannot be among the first before any row is shuffled
        least = rows.withColumn("_at", sample_hash(rows, row_id, seed)).withColumn("_place", place)
        least.filter(F.col("_place") <= size).drop("_at", "_place").write.mode("overwrite").parquet(_version(state_at, number))

    run_batches(stream, checkpoint, work)


def current_sample(
    spark: SparkSession, target: str, size: int, label: str = LABEL, row_id: str = ROW_ID, seed: int = 42
) -> DataFrame:
    """The stratified sample of all input so far: the same rows as ``sampling.stratified_sample`` of the whole table."""
    totals = spark.read.parquet(f"{target}/totals")
    last = totals.agg(F.max("batch")).first()[0]
    totals = totals.filter(F.col("batch") == last)
    state = spark.read.parquet(f"{target}/state").filter(F.col("batch") == last).drop("batch")
    # a table with as many rows per class as there were; its plan gives the targets
    plan = totals.agg(
        F.sum("rows").alias("total_rows"),
        F.coalesce(F.sum(F.when(F.col(label) == 1, F.col("rows"))), F.lit(0)).alias("total_fraud"),
        F.coalesce(F.sum(F.when(F.col(label) == 0, F.col("rows"))), F.lit(0)).alias("total_legit"),
    )
    ratio = F.try_divide(F.col("total_fraud").cast("double"), F.col("total_rows").cast("double"))
    fraud = F.floor(F.lit(size) * F.coalesce(ratio, F.lit(0.0))).cast("long")
    known = plan.filter("total_fraud + total_legit = total_rows").select(fraud.alias("n1"), (F.lit(size) - fraud).alias("n0"))
    wanted = known.select(
        F.inline(F.array(F.struct(F.lit(0).alias(label), F.col("n0").alias("_n")), F.struct(F.lit(1).alias(label), F.col("n1").alias("_n"))))
    )
    place = F.row_number().over(Window.partitionBy(label).orderBy("_at", row_id))
    ranked = state.withColumn("_at", sample_hash(state, row_id, seed)).withColumn("_place", place)
    kept = ranked.join(F.broadcast(wanted), label).filter(F.col("_place") <= F.col("_n"))  # two rows
    return kept.select(*state.columns)
