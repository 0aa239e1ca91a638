"""Embedding near-duplicates by Euclidean p-stable hashing with exact cosine checks.

Vectors are scaled to length 1; a cosine of 0.9 is then a distance of sqrt(0.2). Each table has `k` random normal
projections, shifted at random and cut into cells of width `WIDTH`; vectors with equal cells share a bucket. Both
numbers follow the row count: `k` so that chance meets stay near `CHANCE_MATES` a bucket, the tables so that a pair
just at the threshold shares some bucket with probability `RECALL`.

Buckets hold the vectors, and all pairs in a bucket are compared by blocks. A pair counts in the first table where
it meets, so that link counts are exact without sending pairs; of the links only a spanning forest is sent on.
Large buckets are cut into chunks, and each pair of chunks is a block of its own, so nothing is left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import ceil, exp, log, pi, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import stored
from riskloom.llm.components import components

THRESHOLD = 0.9
WIDTH = 2.0
CHANCE_MATES = 40
RECALL = 0.98
SEED = 20240501
#: Rows in one block of comparisons; larger buckets become several blocks.
BLOCK_ROWS = 1500


def same_cell(distance: float, width: float = WIDTH) -> float:
    """Probability that two vectors at this distance share the cell of one projection."""
    r = width / distance
    below = 0.5 * (1 + _erf(-r / sqrt(2)))
    return 1 - 2 * below - 2 / (sqrt(2 * pi) * r) * (1 - exp(-r * r / 2))


def _erf(x: float) -> float:
    from math import erf

    return erf(x)


def plan(rows: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """Projections of a table and number of tables for so many rows."""
    near, chance = same_cell(sqrt(2 - 2 * threshold)), same_cell(sqrt(2))
    k = max(4, ceil(log(max(rows, 1) / CHANCE_MATES + 1) / -log(chance)))
    return k, ceil(log(1 - RECALL) / log(1 - near**k))


@lru_cache(maxsize=4)
def _projections(size: int, k: int, tables: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng([SEED, size, k, tables])
    return random.standard_normal((size, k * tables)), random.uniform(0, WIDTH, k * tables)


def buckets_of(x: np.ndarray, k: int, tables: int) -> np.ndarray:
    """The bucket of each row in each table, as 32-bit numbers. Numbers that fall together only join buckets."""
    a, b = _projections(x.shape[1], k, tables)
    cells = np.floor((x @ a + b) / WIDTH).astype(np.int16).reshape(len(x), tables, k)
    digest = xxhash.xxh32_intdigest
    return np.array([[digest(row[t].tobytes(), t) for t in range(tables)] for row in cells], np.uint32)


def _unit(raw: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), np.float32).reshape(len(raw), -1).astype(np.float64)
    x /= np.abs(x).max(1)[:, None]  # very large and very small vectors have a length, too
    return x / np.sqrt((x * x).sum(1))[:, None]


def _spread(k: int, tables: int):  # noqa: ANN202
    """(table, bucket, id, n, vector, buckets in all tables) for each vector and table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                batch = whole.slice(at, 64)
                ids, copies, lists = (c.to_pylist() for c in batch.columns)
                raw = [np.array(v, np.float32).tobytes() for v in lists]
                for size in sorted({len(r) for r in raw}):  # vectors of one length at a time
                    own = [i for i, r in enumerate(raw) if len(r) == size]
                    marks = buckets_of(_unit([raw[i] for i in own]), k, tables)
                    order = [i for i in own for _ in range(tables)]
                    packed = {i: m.tobytes() for i, m in zip(own, marks, strict=True)}
                    yield pa.record_batch(
                        [
                            pa.array(np.tile(np.arange(tables, dtype=np.int32), len(own))),
                            pa.array((marks.astype(np.int64) << 16 | (size >> 2) & 0xFFFF).ravel()),
                            pa.array([ids[i] for i in order], pa.int64()),
                            pa.array([copies[i] for i in order], pa.int64()),
                            pa.array([raw[i] for i in order], pa.binary()),
                            pa.array([packed[i] for i in order], pa.binary()),
                        ],
                        ["t", "bucket", "id", "copies", "vector", "marks"],
                    )

    return run


def block_links(t: int, chunk: np.ndarray, x: np.ndarray, marks: np.ndarray, threshold: float) -> np.ndarray:
    """Which rows of a block are linked and meet for the first time in table t; chunks other than one another if two."""
    linked = x @ x.T >= threshold
    np.fill_diagonal(linked, False)
    if len(np.unique(chunk)) > 1:
        linked &= chunk[:, None] != chunk[None]
    p, q = np.nonzero(np.triu(linked))
    for at in range(0, len(p), 50_000):
        a, b = p[at : at + 50_000], q[at : at + 50_000]
        before = (marks[a, :t] == marks[b, :t]).any(1)
        linked[a[before], b[before]] = linked[b[before], a[before]] = False
    return linked


def _forest(linked: np.ndarray) -> list[tuple[int, int]]:
    edges, new = [], linked.any(1)
    while new.any():
        queue = [int(new.argmax())]
        new[queue[0]] = False
        while queue:
            at = queue.pop()
            found = np.flatnonzero(linked[at] & new)
            new[found] = False
            edges += [(at, int(f)) for f in found]
            queue += found.tolist()
    return edges


def _compare(tables: int, threshold: float):  # noqa: ANN202
    """Link counts (a, null, n) and forest edges (a, b, 0) of the blocks of a sorted partition."""

    def block(rows: pa.RecordBatch) -> tuple[list, list, list]:
        t, chunk, ids = rows["t"][0].as_py(), np.asarray(rows["chunk"]), np.asarray(rows["id"])
        if len(np.unique(chunk)) == 1 and rows["i"][0].as_py() != rows["j"][0].as_py():
            return [], [], []
        marks = np.frombuffer(b"".join(rows["marks"].to_pylist()), np.uint32).reshape(len(ids), tables)
        linked = block_links(t, chunk, _unit(rows["vector"].to_pylist()), marks, threshold)
        if not linked.any():
            return [], [], []
        n = linked @ np.asarray(rows["copies"])
        some = np.flatnonzero(n)
        edges = _forest(linked)
        return (
            ids[some].tolist() + [int(ids[a]) for a, _ in edges],
            [None] * len(some) + [int(ids[b]) for _, b in edges],
            n[some].tolist() + [0] * len(edges),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            rows = pa.concat_tables([held, rows]) if held is not None else rows
            keys = np.stack([np.asarray(rows[c]) for c in ("t", "bucket", "i", "j")], 1)
            starts = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(1)]))
            yield _joined(block, rows, starts, np.append(starts[1:], starts[-1]))
            held = rows.slice(starts[-1])
        if held is not None:
            yield _joined(block, held, np.array([0]), np.array([len(held)]))

    return run


def _joined(block, rows: pa.Table, starts: np.ndarray, ends: np.ndarray) -> pa.RecordBatch:  # noqa: ANN001
    a, b, n = [], [], []
    whole = rows.combine_chunks()
    for start, end in zip(starts.tolist(), ends.tolist(), strict=True):
        if end - start > 1:
            for out, more in zip((a, b, n), block(whole.slice(start, end - start)), strict=True):
                out += more
    return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64())], ["a", "b", "n"])


def usable(vector: str) -> Column:
    """Neither null nor empty nor zero, and all components finite."""
    odd = "exists({0}, x -> x is null or isnan(x) or abs(x) = double('infinity'))"
    return F.expr(f"{vector} is not null and size({vector}) > 0 and not coalesce({odd.format(vector)}, true) and exists({vector}, x -> x <> 0)")


def near_duplicates(rows: DataFrame, threshold: float = THRESHOLD, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row with the columns vec_id and embedding.

    Copies of a vector are one class with a count; classes are hashed and compared. Vectors that are null, empty,
    zero or hold null or non-finite components link with nothing, nor do vectors of different lengths with each
    other. Rows without an id link with nothing and are their own component (null). Rows that repeat an id count as
    one node each with their vector. Other columns are not read.
    """
    rows = stored(rows.select("vec_id", "embedding", (usable("embedding") & F.col("vec_id").isNotNull()).alias("good")))
    good = rows.filter("good")
    distinct = stored(good.groupBy("embedding").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")))
    k, tables = plan(distinct.count(), threshold)
    schema = "t int, bucket long, id long, copies long, vector binary, marks binary"
    spread = distinct.select("id", "copies", "embedding").mapInArrow(_spread(k, tables), schema)
    sizes = spread.groupBy("t", "bucket").count().filter(F.col("count") > block_rows)
    hot = stored(sizes.select("t", "bucket", F.ceil(F.col("count") / block_rows).cast("int").alias("chunks")))
    own = spread.join(hot, ["t", "bucket"], "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    own = own.withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int"))
    own = own.withColumn("other", F.explode(F.expr("sequence(0, chunks - 1)")))
    own = own.withColumns({"i": F.least("chunk", "other"), "j": F.greatest("chunk", "other")})
    own = own.select("t", "bucket", "i", "j", "chunk", "id", "copies", "vector", "marks")
    own = own.repartition("t", "bucket", "i", "j").sortWithinPartitions("t", "bucket", "i", "j")
    found = stored(own.mapInArrow(_compare(tables, threshold), "a long, b long, n long"))
    counts = found.filter("b is null").groupBy("a").agg(F.sum("n").alias("n"))
    known = components(found.filter("b is not null").select("a", "b"))
    classes = distinct.join(counts, distinct.id == counts.a, "left").join(known, distinct.id == known.node, "left")
    classes = classes.select(
        F.col("embedding"),
        (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "id").alias("component_id"),
    )
    linked = good.select("vec_id", "embedding").join(classes, "embedding").select("vec_id", "n_links", "component_id")
    alone = rows.filter("not good").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
