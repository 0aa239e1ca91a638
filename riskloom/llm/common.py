"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import write_table

SLICE_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hash_fold(doc_id: str, folds: int, fold: int) -> Column:
    """True where crc32 of the id as text leaves `fold` modulo `folds`; a null id is in no fold."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds == fold, F.lit(False))


def per_text(
    rows: DataFrame,
    columns: list[str],
    schema: str,
    work: Callable[..., dict[str, list]],
    after: Callable[[], None] | None = None,
) -> DataFrame:
    """Applies `work` to slices of the named columns, given as lists; it returns the output columns as lists.

    Only the named columns leave the JVM, so that other columns of any name do not disturb. A task holds one
    Arrow batch and the results of one slice at a time. `after` runs at the end of each task, to free what `work`
    remembers: worker processes live on.
    """
    out = pa.schema([])
    fields = [x.strip().split(" ", 1) for x in _top_level(schema)]
    kinds = {
        "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
        "boolean": pa.bool_(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()),
        "array<int>": pa.list_(pa.int32()), "array<double>": pa.list_(pa.float64()),
        "array<binary>": pa.list_(pa.binary()),
    }
    out = pa.schema([(n, kinds[k.strip()]) for n, k in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in batches:
                for at in range(0, batch.num_rows, SLICE_ROWS):
                    part = batch.slice(at, SLICE_ROWS)
                    got = work(*(part.column(i).to_pylist() for i in range(len(columns))))
                    yield pa.record_batch([pa.array(got[f.name], f.type) for f in out], schema=out)
        finally:
            if after:
                after()

    return rows.select(*columns).mapInArrow(run, schema)


def _top_level(schema: str) -> list[str]:
    parts, depth, word = [], 0, ""
    for ch in schema:
        depth += (ch == "<") - (ch == ">")
        if ch == "," and depth == 0:
            parts.append(word)
            word = ""
        else:
            word += ch
    return [*parts, word]


def stored(df: DataFrame) -> DataFrame:
    """Writes `df` to the shared folder and reads it again: cuts the lineage and fixes the rows.

    The folder is the one in spark.checkpoint.dir; only a local session may go without.
    """
    return write_table(df, "text")
