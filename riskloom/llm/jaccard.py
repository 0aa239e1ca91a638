"""Near-duplicates by SimHash, confirmed by the exact Jaccard similarity of five-word shingles.

Texts with the same shingles are one class with a count. SimHash draws the first candidates, by the covering masks of
`simhash` over fingerprints of the same shingles. Pairs above the threshold of 0.8 differ by up to 17 of 64 bits, more than
masks can cover, so min-hash signatures find what the fingerprints leave apart: BANDS keys of BAND_ROWS minima each; a pair
at the threshold shares none of them in (1 - 0.8^4)^32 = 5e-8 of all cases, and less above. Every link is confirmed on
the whole sets; a shingle is known by 64 bits of hash. Before that, sizes and sketches drop pairs that
cannot reach the threshold: a sketch has a bit for the parity of the shingles that fall on it, so two sets differ in at
least as many shingles as their sketches in bits. This filter loses no pair.

Large groups are not compared pair by pair: for some rounds each member of a bucket meets one hub and its neighbour by
size, and buckets that have become one component are done with. What is left apart is compared in full, so that no
bucket is cut.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import simhash
from riskloom.llm.common import per_text, stored
from riskloom.llm.components import components

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BANDS, BAND_ROWS = 32, 4
SKETCH_BITS = 512
#: Rounds of hubs before what is left is compared pair by pair; a matter of speed only.
ROUNDS = 2
SEED = 42
_KEPT = 250_000
_AT_ONCE = 8192
_random = np.random.default_rng(SEED)
_PLACE = _random.integers(0, 1 << 63, SHINGLE_WORDS, np.uint64) * np.uint64(2) + np.uint64(1)
_TURN = _random.integers(0, 1 << 63, (BANDS * BAND_ROWS, 1), np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > _KEPT:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word, SEED)
        return h


_hashes = _Hashes()


def forget() -> None:
    """Frees what a worker remembers."""
    _hashes.clear()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * _MIX[0]
    x = (x ^ x >> np.uint64(27)) * _MIX[1]
    return x ^ x >> np.uint64(31)


def shingles(text: bytes | None) -> np.ndarray:
    """Sorted hashes of all different runs of five words; a shorter text is one run, a wordless one has none."""
    words = text.lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    hashed = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    n = max(1, len(words) - SHINGLE_WORDS + 1)
    total = np.zeros(n, np.uint64)
    for i in range(min(SHINGLE_WORDS, len(words))):
        total += hashed[i : i + n] * _PLACE[i]
    return np.unique(_mixed(total))


def node_of(own: np.ndarray) -> int:
    """The set of shingles as a signed long."""
    return int.from_bytes(xxhash.xxh64_digest(own.tobytes(), SEED), "big", signed=True)


def band_keys(own: np.ndarray) -> np.ndarray:
    """A key for each band: equal where all minima of the band are."""
    least = np.full(BANDS * BAND_ROWS, np.iinfo(np.uint64).max)
    for at in range(0, len(own), _AT_ONCE):
        np.minimum(least, (own[at : at + _AT_ONCE] * _TURN).min(1), out=least)
    keys = np.arange(BANDS, dtype=np.uint64)
    for row in least.reshape(BANDS, BAND_ROWS).T:
        keys = _mixed(keys * _PLACE[0] + row)
    return keys.view(np.int64)


def sketch(own: np.ndarray) -> np.ndarray:
    odd = np.bincount(own % np.uint64(SKETCH_BITS), minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def _signatures(rows: DataFrame) -> DataFrame:
    """doc_id, node, n (shingles), keys, bits, fp (SimHash) of every whole text."""

    def work(doc_ids: list, texts: list) -> dict:
        sets = [shingles(t) for t in texts]
        return {
            "doc_id": doc_ids, "node": [node_of(s) for s in sets], "n": [len(s) for s in sets],
            "keys": [band_keys(s) if len(s) else [] for s in sets], "bits": [sketch(s) for s in sets],
            "fp": [int.from_bytes(simhash.fingerprint(t, SHINGLE_WORDS), "big", signed=True) for t in texts],
        }

    schema = "doc_id long, node long, n long, keys array<long>, bits array<long>, fp long"
    return per_text(rows, ["doc_id", "text"], schema, work, forget)


def _sets(rows: DataFrame, first: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, own (hashes of the shingles) of the given nodes; `first` has a doc_id for each node."""

    def work(texts: list) -> dict:
        sets = [shingles(t) for t in texts]
        return {"node": [node_of(s) for s in sets], "own": [s.view(np.int64) for s in sets]}

    ids = first.join(nodes, "node", "left_semi").select("doc_id").distinct()
    wanted = rows.join(ids.hint("shuffle_hash"), "doc_id", "left_semi")
    sets = per_text(wanted, ["text"], "node long, own array<long>", work, forget)
    return stored(sets.join(nodes, "node", "left_semi").dropDuplicates(["node"]))


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs a, b of nodes whose whole sets reach the similarity."""
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("own").alias("x")), "a")
    both = both.join(sets.select(F.col("node").alias("b"), F.col("own").alias("y")), "b")
    shared = "cast(size(array_intersect(x, y)) as double)"
    return both.filter(f"{shared} >= {SIMILARITY}D * (size(x) + size(y) - {shared})").select("a", "b")


def _fingerprint_pairs(distinct: DataFrame) -> DataFrame:
    """Pairs a, b of nodes that connect all whose fingerprints link; equal fingerprints through their smallest node."""
    of_fp = stored(distinct.groupBy("fp").agg(F.min("node").alias("id")))
    same = distinct.join(of_fp, "fp").filter("node <> id").select(F.col("node").alias("a"), F.col("id").alias("b"))
    pairs = simhash.links(of_fp).union(same)
    return stored(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def _apart(groups: DataFrame, edges: DataFrame) -> DataFrame:
    """The buckets that still hold several components, with the component of each row."""
    rows = groups.drop("component").join(components(edges), "node", "left")
    rows = rows.withColumn("component", F.coalesce("component", "node"))
    rows = rows.withColumns({"lo": F.expr("min(component) over (partition by key)"), "hi": F.expr("max(component) over (partition by key)")})
    return stored(rows.filter("lo < hi").select(groups.columns))


def _may_link(x: str, y: str) -> str:
    """SQL: rows x and y (structs) are of two components, and neither size nor sketch forbids a link."""
    apart = " + ".join(f"bit_count({x}.bits[{i}] ^ {y}.bits[{i}])" for i in range(SKETCH_BITS // 64))
    return f"""{x}.component <> {y}.component and least({x}.n, {y}.n) >= {SIMILARITY}D * greatest({x}.n, {y}.n)
        and {1 + SIMILARITY}D * ({apart}) <= {1 - SIMILARITY}D * ({x}.n + {y}.n) + 1e-6D"""


def links(found: DataFrame, rows: DataFrame, first: DataFrame) -> DataFrame:
    """Edges a, b that connect all nodes within the similarity of each other, from the signatures of all texts."""
    distinct = found.filter("n > 0").dropDuplicates(["node"])
    groups = distinct.select("node", F.explode("keys").alias("key"))
    groups = groups.withColumn("members", F.expr("count(*) over (partition by key)")).filter("members > 1").drop("members")
    groups = stored(groups.join(distinct.select("node", "n", "bits"), "node").withColumn("component", F.col("node")))
    near = _fingerprint_pairs(distinct)
    wanted = groups.select("node").union(near.select("a")).union(near.select("b"))
    sets = _sets(rows, first, wanted.distinct())
    edges = stored(_confirmed(near, sets))
    left = _apart(groups, edges)
    row = "struct(node, n, component, bits)"
    ends = [F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")]
    for k in range(ROUNDS):
        if left.isEmpty():
            return edges
        each = left.select("key", "node", "n", F.expr(row).alias("x"))
        hub = each.withColumn("y", F.expr(f"first(x) over (partition by key order by xxhash64(node, {k}))"))
        beside = each.withColumn("y", F.expr("lag(x) over (partition by key order by n, node)"))
        pairs = hub.unionByName(beside).filter(_may_link("x", "y")).select(*ends).distinct()
        edges = stored(edges.union(_confirmed(pairs, sets)))
        left = _apart(groups, edges)
    each = left.select("key", F.expr(row).alias("x"))
    pairs = each.join(each.select("key", F.col("x").alias("y")), "key").filter("x.node < y.node and " + _may_link("x", "y"))
    return edges.union(_confirmed(pairs.select(*ends).distinct(), sets))


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents, all columns as they are, that have the smallest id of their class; the others go.

    Wordless texts are copies of each other. Rows that repeat an id are one document, of which one row stays. Rows
    without an id cannot be told apart and stay. Rows and ids meet by one shuffle at every size.
    """
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text")).filter("doc_id is not null")
    found = stored(_signatures(rows))
    first = stored(found.groupBy("node").agg(F.min("doc_id").alias("doc_id")))
    known = components(links(found, rows, first))
    of_node = first.join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))
    ids = of_node.groupBy("component").agg(F.min("doc_id").alias("doc_id")).select("doc_id").distinct()
    repeats = found.groupBy("doc_id").count().filter("count > 1").select("doc_id")
    ids = stored(ids.join(repeats.withColumn("again", F.lit(True)), "doc_id", "left"))
    kept = docs.join(ids.filter("again is null").hint("shuffle_hash"), "doc_id", "left_semi").select(docs.columns)
    again = ids.filter("again")
    if not again.isEmpty():
        kept = kept.union(docs.join(again.hint("shuffle_hash"), "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(docs.columns))
    return kept.union(docs.filter("doc_id is null"))
