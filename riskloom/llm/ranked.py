"""Ranked lexical search: many queries at once, with what they share computed once.

The terms of all items form a plan. Terms that occur in the same set of items are one leaf; a pair of partial sums that
several items need becomes a node of its own, again and again, so that the queries share a DAG of additions. A
document fills the leaves it holds terms of, and each node is added up once for all items above it.

The documents are read once: each row becomes its length and the counts of those terms that may occur in an item.
Items are taken in blocks of bounded size, as many as it takes; each block meets these short rows, in slices, and
each task sends its best documents of each item only.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import per_text, stored

TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
TOP = 10
#: Slots of the filter that keeps words of no item out of the stored rows. Two words in one slot do no harm.
SLOTS = 1 << 20
#: Pairs of item and term in a block, about: what a task holds of the plan.
BLOCK_PAIRS = 1 << 18
#: Partial sums that a task holds at a time, about: documents of a slice times nodes of the plan.
CELLS = 1 << 22
#: Partners that mining looks at for a node. Fewer mean fewer shared sums, never other scores.
PARTNERS = 64
#: Words whose slot a task remembers.
REMEMBERED = 200_000


def terms_of(text: str | None) -> list[bytes]:
    """Maximal runs of letters, digits and all beyond ASCII, A-Z lower-cased. UTF-8 keeps the classes apart byte by byte."""
    return TERM.findall((text or "").encode().lower())


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term), each once. Rows that share an item_id are one item; a null id is an item as well."""

    def work(ids, texts):
        pairs = [(i, t) for i, x in zip(ids, texts) for t in set(terms_of(x))]
        return {"item_id": [i for i, _ in pairs], "term": [t for _, t in pairs]}

    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    return per_text(rows, ["item_id", "text"], "item_id long, term binary", work).distinct()


def _slots(terms: DataFrame) -> np.ndarray:
    """Which slots the terms take. At most SLOTS numbers reach the driver, whatever the number of items."""
    used = terms.select(F.pmod(F.xxhash64("term"), F.lit(SLOTS)).cast("int").alias("slot")).distinct()
    got = used.toArrow().column(0).to_numpy()
    filled = np.zeros(SLOTS, bool)
    filled[got] = True
    return filled


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """doc_id, n (terms with repeats) and the counts of those terms that may be an item's, for rows with any term.

    A repeated doc_id is a document for each of its rows.
    """
    packed = np.packbits(_slots(terms))

    def work(ids, texts):
        filled = np.unpackbits(packed).astype(bool)
        out = {"doc_id": [], "n": [], "terms": [], "tf": []}
        for i, text in zip(ids, texts):
            found = terms_of(text)
            if not found:
                continue
            own = {t: c for t, c in Counter(found).items() if _kept(t, filled)}
            out["doc_id"].append(i)
            out["n"].append(len(found))
            out["terms"].append(list(own))
            out["tf"].append(list(own.values()))
        return out

    seen: dict[bytes, bool] = {}

    def _kept(term: bytes, filled: np.ndarray) -> bool:
        got = seen.get(term)
        if got is None:
            if len(seen) >= REMEMBERED:
                seen.clear()
            # Spark's xxhash64 has seed 42, and its pmod by a power of two takes the last bits
            got = seen[term] = bool(filled[xxhash.xxh64_intdigest(term, 42) & (SLOTS - 1)])
        return got

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, n long, terms array<binary>, tf array<long>"
    return per_text(rows, ["doc_id", "text"], schema, work, seen.clear)


def weigh(terms: DataFrame, posted: DataFrame, totals: tuple[int, int]) -> DataFrame:
    """(item_id, term, w) for the terms that occur in a document; others add nothing to a score."""
    df = posted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    w = F.floor(F.lit(1000.0) * F.log((2 * F.lit(totals[0]) + 2).cast("double") / (2 * F.col("df") + 1).cast("double")))
    return terms.join(df, "term").select("item_id", "term", w.cast("long").alias("w"))


def mine(sets: list[frozenset[int]]) -> tuple[list[tuple[int, int]], list[list[int]]]:
    """Shared sums among items: ``sets`` are the items of each leaf.

    Returns the additions (each makes the node after the leaves and the ones before it) and, by item, the nodes whose
    sum is its score. The node that most items need meets the partner that most of them need as well, until no two items
    share a pair.
    """
    of_item: dict[int, set[int]] = defaultdict(set)
    for leaf, items in enumerate(sets):
        for i in items:
            of_item[i].add(leaf)
    users: dict[int, set[int]] = {leaf: set(items) for leaf, items in enumerate(sets)}
    adds: list[tuple[int, int]] = []
    # nodes with many users first: a pair cannot be shared by more items than either of its nodes
    live = sorted((n for n in users if len(users[n]) > 1), key=lambda n: (-len(users[n]), n))
    while len(live) > 1:
        a = live[0]
        best, at = 1, None
        for b in live[1 : PARTNERS + 1]:
            if len(users[b]) <= best:
                break
            both = len(users[a] & users[b])
            if both > best:
                best, at = both, b
        if at is None:
            live.pop(0)  # nothing is shared with what is left of this node
            continue
        made = len(sets) + len(adds)
        adds.append((a, at))
        shared = users[a] & users[at]
        users[made] = shared
        for old in (a, at):
            users[old] = users[old] - shared
            live.remove(old)
            if len(users[old]) > 1:
                _place(live, old, users)
        for i in shared:
            of_item[i] -= {a, at}
            of_item[i].add(made)
        _place(live, made, users)
    n_items = max(of_item, default=-1) + 1
    return adds, [sorted(of_item[i]) for i in range(n_items)]


def _place(live: list[int], node: int, users: dict[int, set[int]]) -> None:
    size = len(users[node])
    low, high = 0, len(live)
    while low < high:
        mid = (low + high) // 2
        if (-len(users[live[mid]]), live[mid]) < (-size, node):
            low = mid + 1
        else:
            high = mid
    live.insert(low, node)


def _plan(rows: pa.Table) -> dict:
    """The plan of a block from its (item_id, term, w) rows."""
    ids = rows.column("item_id").to_pylist()
    items = sorted(set(ids), key=lambda i: (i is not None, i or 0))
    number = {i: k for k, i in enumerate(items)}
    inside: dict[bytes, set[int]] = defaultdict(set)
    weight: dict[bytes, int] = {}
    for i, term, w in zip(ids, rows.column("term").to_pylist(), rows.column("w").to_pylist()):
        inside[term].add(number[i])
        weight[term] = w
    leaves: dict[frozenset[int], int] = {}
    terms = sorted(inside)
    leaf_of = [leaves.setdefault(frozenset(inside[t]), len(leaves)) for t in terms]
    adds, outputs = mine(list(leaves))
    return {
        "items": items, "terms": terms, "leaf": leaf_of, "w": [weight[t] for t in terms],
        "adds": adds, "outputs": outputs, "leaves": len(leaves),
    }


class Best:
    """The ``top`` highest-scoring documents of each item so far, equal scores by ascending doc_id, null ids first."""

    def __init__(self, n_items: int, top: int):
        self.top = top
        self.rows: list[list[tuple[int, tuple[bool, int]]]] = [[] for _ in range(n_items)]
        self.least = np.ones(n_items, np.int64)

    def add(self, scores: np.ndarray, ids: list[int | None]) -> None:
        """``scores``: items by documents."""
        for item in np.flatnonzero((scores >= self.least[:, None]).any(axis=1)):
            row = scores[item]
            at = np.flatnonzero(row >= self.least[item])
            own = self.rows[item]
            own += [(-int(row[k]), (ids[k] is not None, ids[k] or 0)) for k in at]
            own.sort()
            del own[self.top :]
            if len(own) == self.top:
                self.least[item] = -own[-1][0]

    def table(self) -> dict[str, list]:
        flat = [(i, -s, k[1] if k[0] else None) for i, own in enumerate(self.rows) for s, k in own]
        return {"item": [x[0] for x in flat], "score": [x[1] for x in flat], "doc_id": [x[2] for x in flat]}


def search_block(posted: DataFrame, plan: dict, totals: tuple[int, int], top: int) -> DataFrame:
    """(item, doc_id, score): the best documents of each task for each item of the plan."""
    n_docs, n_terms = totals

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = pa.array(plan["terms"], pa.binary())
        leaf, w = np.array(plan["leaf"], np.int64), np.array(plan["w"], np.int64)
        n_leaves, adds = plan["leaves"], plan["adds"]
        best = Best(len(plan["items"]), top)
        step = max(1, min(512, CELLS // max(n_leaves + len(adds), len(plan["items"]))))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                lists = part.column(2)
                place = pc.index_in(lists.flatten(), value_set=terms).to_numpy(zero_copy_only=False)
                doc = np.repeat(np.arange(part.num_rows), np.diff(lists.offsets.to_numpy()))
                known = ~np.isnan(place) if place.dtype.kind == "f" else np.ones(len(place), bool)
                place, doc = place[known].astype(np.int64), doc[known]
                tf = part.column(3).flatten().to_numpy()[known]
                n = part.column(1).to_numpy()
                m = 10 + (90 * n * n_docs) // n_terms
                value = w[place] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
                sums = np.zeros((n_leaves + len(adds), part.num_rows), np.int64)
                np.add.at(sums, (leaf[place], doc), value)
                for k, (a, b) in enumerate(adds):
                    np.add(sums[a], sums[b], out=sums[n_leaves + k])
                scores = np.empty((len(plan["items"]), part.num_rows), np.int64)
                for i, nodes in enumerate(plan["outputs"]):
                    sums[nodes].sum(axis=0, out=scores[i])
                best.add(scores, part.column(0).to_pylist())
        got = best.table()
        yield pa.record_batch(
            [pa.array(got["item"], pa.int32()), pa.array(got["doc_id"], pa.int64()), pa.array(got["score"], pa.int64())],
            ["item", "doc_id", "score"],
        )

    return posted.mapInArrow(run, "item int, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` documents of each item with a score above 0.

    Null texts and texts without terms are no documents; an item without terms, or one whose terms occur nowhere,
    has no row. Rows that share an item_id are one item, rows that share a doc_id are documents of their own. Equal scores are ranked by
    ascending doc_id. Other columns are not read.
    """
    spark = docs.sparkSession
    terms = stored(item_terms(items))
    posted = stored(postings(docs, terms))
    n_docs, n_terms = posted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    kind = "item_id long, rank int, doc_id long, score long"
    if not n_docs:
        return spark.createDataFrame([], kind)
    weighed = weigh(terms, posted, (n_docs, n_terms))
    blocks = max(1, -(-terms.count() // BLOCK_PAIRS))
    weighed = stored(weighed.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int")))
    found = None
    for block in range(blocks):
        plan = _plan(weighed.filter(F.col("block") == block).drop("block").toArrow())  # one block, of bounded size
        if not plan["items"]:
            continue
        rows = search_block(posted, plan, (n_docs, n_terms), top)
        names = spark.createDataFrame(list(enumerate(plan["items"])), "item int, item_id long")
        rows = rows.join(F.broadcast(names), "item").select("item_id", "doc_id", "score")  # items of one block
        rows = stored(rows) if blocks > 1 else rows
        found = rows if found is None else found.unionByName(rows)
    if found is None:
        return spark.createDataFrame([], kind)
    place = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_first("doc_id")))
    return found.withColumn("rank", place).filter(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")
