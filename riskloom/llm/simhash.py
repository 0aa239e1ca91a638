"""SimHash near-duplicates by covering locality-sensitive hashing.

Each of the 64 bits gets a vector of r + 1 bits other than zero; each of the 2^(r+1) - 1 vectors other than zero is
a table, whose mask keeps the bits that are not orthogonal to it. The bits in which two fingerprints within radius
r differ have vectors that span r dimensions at most, so some table's vector is orthogonal to all of them: this
table keeps none of them, and the pair meets there. No pair within the radius is missed.

A bucket that is large is split further by the same construction over the bits that its table leaves out.
Within a bucket, links are found by breadth-first search and only the edges of a spanning forest are sent on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import per_text, stored
from riskloom.llm.components import components

SHINGLE_WORDS = 3
RADIUS = 3
SEED = 42
#: Fingerprints in one bucket beyond which it is split further; a matter of speed only.
LARGE_BUCKET = 2000
_AT_ONCE = 16_384


def fingerprint(text: bytes | None, shingle_words: int = SHINGLE_WORDS) -> bytes:
    """Eight bytes: a bit is 1 if it is set in over half the hashes of all shingles; zero without words."""
    words = text.lower().split() if text else []
    if not words:
        return bytes(8)
    n = max(1, len(words) - shingle_words + 1)
    total = np.zeros(64, np.int64)
    digest = xxhash.xxh64_digest
    for at in range(0, n, _AT_ONCE):
        runs = zip(*(words[at + i : min(at + _AT_ONCE, n) + i] for i in range(shingle_words)), strict=False)
        shingles = [b" ".join(words)] if len(words) < shingle_words else map(b" ".join, runs)
        hashes = np.frombuffer(b"".join([digest(s, SEED) for s in shingles]), np.uint8).reshape(-1, 8)
        total += np.unpackbits(hashes, axis=1).sum(0, dtype=np.int64)
    return np.packbits(2 * total > n).tobytes()


def covering_masks(bits: list[int], radius: int) -> list[int]:
    """Masks over the given bit places such that any `radius` of the places are left out together by some mask."""
    size = radius + 1
    vectors = [1 + i % ((1 << size) - 1) for i in range(len(bits))]
    return [
        sum(1 << bit for bit, v in zip(bits, vectors, strict=True) if (v & table).bit_count() % 2)
        for table in range(1, 1 << size)
    ]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, fp (a signed long) of every whole text; a null text has no words."""

    def work(doc_ids: list, texts: list) -> dict:
        return {"doc_id": doc_ids, "fp": [int.from_bytes(fingerprint(t, shingle_words), "big", signed=True) for t in texts]}

    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return per_text(rows, rows.columns, "doc_id long, fp long", work)


def forest(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Places of the edges of a spanning forest of the links between the fingerprints."""
    fps = fps.view(np.uint64)  # of signed numbers, numpy counts the bits of the absolute value
    left = np.arange(len(fps))
    edges = []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = np.bitwise_count(fps[left] ^ fps[at]) <= radius
            if near.any():
                found = left[near].tolist()
                edges += [(int(at), x) for x in found]
                queue += found
                left = left[~near]
    return edges


def _link_sorted(radius: int):  # noqa: ANN202
    """Edges within the buckets of a partition sorted by bucket; holds one Arrow batch and one bucket's rest."""

    def edges_of(bucket: np.ndarray, fps: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.concatenate([[True], (bucket[1:] != bucket[:-1]).any(1)])) if len(bucket) else np.empty(0, int)
        sizes = np.diff(np.concatenate([starts, [len(bucket)]]))
        twos = starts[sizes == 2]
        apart = (fps[twos] ^ fps[twos + 1]).view(np.uint64)
        twos = twos[np.bitwise_count(apart) <= radius]
        a, b = [ids[twos]], [ids[twos + 1]]
        for start, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
            if pairs := forest(fps[start : start + size], radius):
                at = np.array(pairs) + start
                a.append(ids[at[:, 0]])
                b.append(ids[at[:, 1]])
        return pa.record_batch([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = np.empty((0, 4), np.int64)
        for batch in batches:
            rows = np.concatenate([rest, np.stack([np.asarray(c) for c in batch.columns], 1)])
            if not len(rows):
                continue
            last = int((rows[:, :2] == rows[-1, :2]).all(1).argmax())  # where the last bucket starts
            rest, rows = rows[last:], rows[:last]
            yield edges_of(rows[:, :2], np.ascontiguousarray(rows[:, 2]), rows[:, 3])
        yield edges_of(rest[:, :2], np.ascontiguousarray(rest[:, 2]), rest[:, 3])

    return run


def links(distinct: DataFrame, radius: int = RADIUS, large: int = LARGE_BUCKET) -> DataFrame:
    """Edges a, b (ids) that connect all distinct fingerprints (columns fp, id) within the radius of each other."""
    masks = covering_masks(list(range(64)), radius)

    def spread(rows: DataFrame, tables: list[tuple[int, int]], source: str) -> DataFrame:
        table = F.explode(F.array(*[F.struct(F.lit(t).cast("long").alias("t"), F.lit(_signed(m)).alias("m")) for t, m in tables]))
        return rows.select("fp", "id", table.alias("x")).select(
            F.col("x.t").alias("t"), F.col("fp").bitwiseAND(F.col("x.m")).alias("key"), "fp", "id"
        )

    buckets = spread(distinct, list(enumerate(masks)), "all")
    hot = stored(buckets.groupBy("t", "key").count().filter(F.col("count") > large).select("t", "key"))
    cold = buckets.join(hot, ["t", "key"], "left_anti")
    if hot.isEmpty():
        split = [buckets]
    else:
        split = [cold]
        for t, mask in enumerate(masks):
            free = [bit for bit in range(64) if not mask >> bit & 1]
            finer = [((t + 1) * len(masks) + k, mask | more) for k, more in enumerate(covering_masks(free, radius))]
            rows = buckets.filter(F.col("t") == t).join(hot, ["t", "key"], "left_semi")
            split.append(spread(rows, finer, "hot"))
    rows = split[0]
    for more in split[1:]:
        rows = rows.union(more)
    rows = rows.select("t", "key", "fp", "id").repartition("t", "key").sortWithinPartitions("t", "key")
    return rows.mapInArrow(_link_sorted(radius), "a long, b long").distinct()


def classes(found: DataFrame, radius: int = RADIUS) -> DataFrame:
    """The rows of `found` (doc_id, fp) with component_id, the smallest doc_id that links reach.

    Copies share a fingerprint and are linked through its smallest id, never pair by pair. Rows without an id take
    the component of their fingerprint; it is null if no row of the component has an id.
    """
    distinct = stored(found.groupBy("fp").agg(F.min("doc_id").alias("id")))
    known = components(links(distinct.filter("id is not null"), radius))
    of_fp = distinct.join(known, distinct.id == known.node, "left").select("fp", F.coalesce("component", "id").alias("component_id"))
    return found.join(of_fp, "fp")


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every document; equal rows give equal rows."""
    found = classes(stored(fingerprints(docs, shingle_words)), radius)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """The documents, all columns as they are, that have the smallest id of their class; the others go.

    Rows that repeat an id are one document, of which one row stays. Rows without an id cannot be told apart and
    stay. The ids are as many as the documents, so they are never broadcast: rows and ids meet by one shuffle at
    every size.
    """
    found = stored(classes(stored(fingerprints(docs, shingle_words)), radius))
    ids = found.filter("doc_id = component_id").groupBy("doc_id").count()
    ids = stored(ids)
    kept = docs.join(ids.filter("count = 1").hint("shuffle_hash"), "doc_id", "left_semi").select(docs.columns)
    again = ids.filter("count > 1")
    if not again.isEmpty():
        kept = kept.union(docs.join(again.hint("shuffle_hash"), "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(docs.columns))
    return kept.union(docs.filter("doc_id is null"))
