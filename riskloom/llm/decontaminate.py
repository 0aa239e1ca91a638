"""Benchmark decontamination by a prefix-filtered set join.

A window is a run of words of a benchmark item; a document contains it where the same words follow each other.
All words of a window are needed, so by the prefix filter one of them is enough to find candidates: the rarest,
by counts over all documents. Document words are joined to these rarest words; the place of the word in the
window fixes where the window would start (positional bound) and end (length bound), and the words there are
compared.

The benchmark is the query set: it is read in blocks of bounded size, which are small enough for every worker.
Each block is one more narrow step over the documents, whose result is stored before the next. Nothing is shuffled but
the word counts and the benchmark, whose repeated items are dropped first.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import SLICE_ROWS, stored

WINDOW_WORDS = 10
#: Bytes of benchmark text in one block; the index of a block takes some fifty times as much in a worker.
BLOCK_BYTES = 2_000_000
_KEEP = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_TO_SPACE = bytes(b if b in _KEEP else 0x20 for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """Words after lower-casing A-Z: runs of digits, letters a-z and all characters beyond ASCII."""
    return text.lower().translate(_TO_SPACE).split() if text else []


class Windows:
    """The windows of one block of items, found by their rarest word."""

    def __init__(self, items: list[tuple[str, bytes]], counts: dict[bytes, int], size: int) -> None:
        self.items: dict[tuple[bytes, ...], set[str]] = defaultdict(set)
        self.places: dict[bytes, set[tuple[int, int]]] = defaultdict(set)
        for item_id, text in items:
            words = words_of(text)
            n = min(size, len(words))
            for at in range(len(words) - n + 1 if n else 0):
                self.items[tuple(words[at : at + n])].add(item_id)
        for window in self.items:
            rare = min(range(len(window)), key=lambda i: (counts.get(window[i], 0), window[i]))
            self.places[window[rare]].add((rare, len(window)))

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Word spans (end exclusive) of all occurrences, and the items they belong to."""
        spans, found, places, items = [], set(), self.places, self.items
        for i in [i for i, w in enumerate(words) if w in places]:
            for rare, n in places[words[i]]:
                start = i - rare
                if start >= 0 and start + n <= len(words):
                    owners = items.get(tuple(words[start : start + n]))
                    if owners:
                        spans.append((start, start + n))
                        found |= owners
        return spans, found


def merge(spans: list[tuple[int, int]]) -> list[int]:
    """Start, end, start, end ... of the union of the spans."""
    out: list[int] = []
    for start, end in sorted(spans):
        if out and start <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [start, end]
    return out


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[tuple[list[tuple[str, bytes]], bool]]:
    """Different items in blocks, and whether the block is the last one, which may be empty.

    A block ends with the item that brings it to `block_bytes`. The driver holds two blocks and one partition of items.
    """
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.col("text").cast("binary").alias("text")
    ).filter("text is not null")
    ready, block, held = None, [], 0
    for r in stored(items.distinct()).toLocalIterator():
        block.append((r.item_id, bytes(r.text)))
        held += len(r.text)
        if held >= block_bytes:
            if ready is not None:
                yield ready, False
            ready, block, held = block, [], 0
    if ready is not None and block:
        yield ready, False
        ready = None
    yield block if ready is None else ready, True


def word_counts(docs: DataFrame, words: frozenset[bytes]) -> dict[bytes, int]:
    """How often each of the given words stands in all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                counts.update([w for w in words_of(text.as_py()) if w in words])
        yield pa.record_batch([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    texts = docs.select(F.col("text").cast("binary").alias("text"))
    rows = texts.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {bytes(r.word): r.n for r in rows.collect()}  # at most the words of one block


def scan(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW_WORDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, spans (start, end ... of the hit words) and items (ids as strings) for every document.

    An item of fewer than `size` words is one window; null, empty and wordless texts have no words. Items without
    an id count under the empty id; repeated items count once. An empty benchmark hits nothing. Equal rows give
    equal rows; other columns are not read.
    """
    out = docs.select(
        "doc_id", F.col("text").cast("binary").alias("text"), F.lit(0).cast("long").alias("n_words"),
        F.expr("cast(array() as array<bigint>)").alias("spans"), F.expr("cast(array() as array<string>)").alias("items"),
    )
    for items, last in _blocks(benchmark, block_bytes):
        counts = word_counts(docs, frozenset(w for _, text in items for w in words_of(text)))
        out = out.mapInArrow(_finder(items, counts, size, last), out.schema)
        out = out if last else stored(out)  # so that the plan holds one block
    return out.drop("text")


def _finder(items: list[tuple[str, bytes]], counts: dict[bytes, int], size: int, last: bool):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(items, counts, size)
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(at, SLICE_ROWS)
                texts, spans, found, n_words = batch.column(1).to_pylist(), [], [], []
                before = zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True)
                for text, (old, owners) in zip(texts, before, strict=True):
                    words = words_of(text)
                    new, ids = windows.find(words)
                    n_words.append(len(words))
                    spans.append(merge(new + list(zip(old[::2], old[1::2], strict=True))) if new else old)
                    found.append(sorted(ids.union(owners)))
                yield pa.record_batch(
                    [
                        batch.column(0),
                        pa.nulls(len(texts), pa.binary()) if last else batch.column(1),  # the text is done with
                        pa.array(n_words, pa.int64()), pa.array(spans, pa.list_(pa.int64())), pa.array(found, pa.list_(pa.string())),
                    ],
                    ["doc_id", "text", "n_words", "spans", "items"],
                )

    return run


def report(found: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated from the rows of `scan`."""
    n_hit = "aggregate(spans, cast(0 as bigint), (a, x) -> x - a)"  # end - (start - sum so far)
    return found.select(
        "doc_id", "n_words", F.expr(n_hit).alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
        F.expr(f"{n_hit} > 0").alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW_WORDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents, all their columns as they are, that hold no window of the benchmark."""
    place = docs.columns.index("text")
    for items, last in _blocks(benchmark, block_bytes):
        counts = word_counts(docs, frozenset(w for _, text in items for w in words_of(text)))

        def run(batches: Iterator[pa.RecordBatch], items=items, counts=counts) -> Iterator[pa.RecordBatch]:
            windows = Windows(items, counts, size)
            for whole in batches:
                for at in range(0, whole.num_rows, SLICE_ROWS):
                    batch = whole.slice(at, SLICE_ROWS)
                    texts = batch.column(place).cast(pa.binary()).to_pylist()
                    yield batch.filter(pa.array([not windows.find(words_of(t))[0] for t in texts], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
        docs = docs if last else stored(docs)
    return docs
