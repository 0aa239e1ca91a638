"""The two incremental passes as Structured Streaming jobs over a folder of Parquet files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from riskloom.operators.cleanse import drop_columns
from riskloom.operators.features import add_time_features
from riskloom.operators.prepare import add_hour, clean_text_columns, transform
from riskloom.operators.risk import all_hours, fraud_by
from riskloom.schema import DROPPED, ROW_ID
from riskloom.session import scratch_path


def file_stream(
    spark: SparkSession,
    folder: str,
    schema: StructType,
    pattern: str = "*.parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    """The Parquet files of a folder, old and new ones, as a stream."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def prepare_rows(rows: DataFrame) -> DataFrame:
    """Row-wise preparation; works the same on a batch and on a stream. The row id is kept."""
    prepared = transform(clean_text_columns(rows))
    return drop_columns(add_time_features(prepared), [c for c in DROPPED if c != ROW_ID])


def run_prepare(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Append prepared rows to ``target`` until all available input is read. A restart continues from
    the checkpoint, and the file sink commits each batch once."""
    query = (
        prepare_rows(stream)
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def run_report(counts: DataFrame, target: str, checkpoint: str, finish: Callable[[DataFrame], DataFrame] = lambda batch: batch) -> None:
    """Keep the running totals of ``counts`` in the state store and publish a report after every batch.

    Each report goes to a folder of its own, named by the batch, and none is ever replaced by another's
    content: readers see whole reports only, and a batch that runs again writes the same one.
    """
    def publish(batch: DataFrame, number: int) -> None:
        finish(batch).write.mode("overwrite").parquet(f"{target}/batch={number:012d}")

    query = (
        counts.writeStream.foreachBatch(publish)
        .option("checkpointLocation", checkpoint)
        .outputMode("complete")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def run_fraud_by_hour(stream: DataFrame, target: str, checkpoint: str) -> None:
    run_report(fraud_by(add_hour(stream), "trans_hour", "hour"), target, checkpoint, all_hours)


def run_fraud_by_category(stream: DataFrame, target: str, checkpoint: str) -> None:
    run_report(fraud_by(stream, "category"), target, checkpoint)


def latest_report(spark: SparkSession, target: str) -> DataFrame:
    """The report of the last batch."""
    reports = spark.read.parquet(target)
    last = reports.agg(F.max("batch")).scalar()
    return reports.filter(F.col("batch") == last).drop("batch")


def stream_prepare(spark: SparkSession, stream: DataFrame) -> DataFrame:
    target = scratch_path(spark, "stream-prepared")
    run_prepare(stream, target, scratch_path(spark, "stream-prepared-state"))
    return spark.read.parquet(target)


def stream_fraud_by_hour(spark: SparkSession, stream: DataFrame) -> DataFrame:
    target = scratch_path(spark, "stream-hours")
    run_fraud_by_hour(stream, target, scratch_path(spark, "stream-hours-state"))
    return latest_report(spark, target)


def stream_fraud_by_category(spark: SparkSession, stream: DataFrame) -> DataFrame:
    target = scratch_path(spark, "stream-categories")
    run_fraud_by_category(stream, target, scratch_path(spark, "stream-categories-state"))
    return latest_report(spark, target)
