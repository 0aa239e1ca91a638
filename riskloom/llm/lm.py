"""Language-model scoring by a hierarchical Pitman-Yor model.

The restaurants are contexts: each of the most frequent words (and the start of a text) is a context of its own,
and all other words share contexts by their last bytes. Their number is fixed, so that what all tasks must know of
the contexts has a fixed size. All contexts share one parent, the restaurant of single words, whose base is even.

Tokens are counted by word and context, dealt out by word (frequent words by context, too). Gibbs sampling redraws
the seating of one word in one restaurant at a time given all others: the number of tables of c customers has
probability proportional to S(c, t) a^t, where S are generalised Stirling numbers and a is the weight of a new
table. Small groups are drawn exactly, large ones by seating the customers in turn, in blocks. Within a sweep the
totals over all words (tables of a context, customers and tables of the parent) are those of the sweep before; after
each sweep Spark adds them up. Draws are seeded by part and sweep, so that a task that runs again draws the same.

A text's score is the sum of the log10 of the predictive probabilities, averaged over the sweeps after the burn-in.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import SLICE_ROWS, stored

#: Contexts of one word each, and contexts shared by last bytes.
OWN_CONTEXTS, SHARED_CONTEXTS = 8192, 4096
START = OWN_CONTEXTS + SHARED_CONTEXTS
CONTEXTS = START + 1
DISCOUNT, STRENGTH = 0.8, 1.0
PARENT_DISCOUNT, PARENT_STRENGTH = 0.7, 10.0
SWEEPS, BURN_IN = 4, 1
SEED = 11
#: Tokens that one part of the counts holds on average, at most; tokens that a task gathers before it sends them.
PART_TOKENS, CHUNK_TOKENS = 1_500_000, 2_000_000
LEAST_PARTS = 48
#: Different words that a task counts before it sends their counts.
COUNTED_WORDS = 1_000_000
_END = b" "
_SMALL = 64
_KEPT = 250_000


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > _KEPT:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


class _Contexts(dict):
    def __init__(self, own: dict[int, int]) -> None:
        self.own = own

    def __missing__(self, word: bytes) -> int:
        if len(self) > _KEPT:
            self.clear()
        at = self.own.get(xxhash.xxh64_intdigest(word))
        self[word] = at = OWN_CONTEXTS + xxhash.xxh32_intdigest(word[-3:]) % SHARED_CONTEXTS if at is None else at
        return at


def tokens_of(text: bytes | None) -> list[bytes]:
    """Words after lower-casing A-Z, and the end."""
    return [*text.lower().split(), _END] if text else [_END]


def _pack(values: np.ndarray) -> bytes:
    """Bytes by place, compressed."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T.tobytes()
    return zstandard.compress(planes, 1)


def _unpack(packed: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    raw = np.frombuffer(zstandard.decompress(packed), np.uint8)
    return np.ascontiguousarray(raw.reshape(size, -1).T).reshape(-1).view(kind)


def word_counts(docs: DataFrame) -> DataFrame:
    """word (hash), n over the training rows (column train) for every word; and the total over all rows.

    A task adds up what it reads and sends its counts whenever it holds `COUNTED_WORDS`; Spark sums them. Nothing is
    left out, so the counts are the same however the rows are split into tasks.
    """

    def rows(words: Counter, total: int) -> pa.RecordBatch:
        words.pop(_END, None)
        hashed = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)).view(np.int64)
        n = pa.array([*words.values(), total], pa.int64())
        return pa.record_batch([pa.array(np.append(hashed, 0)), n, pa.array([True] * len(words) + [False])], ["word", "n", "is_word"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        total = 0
        for batch in batches:
            for text, train in zip(batch.column("text"), batch.column("train").to_pylist(), strict=True):
                words = tokens_of(text.as_py())
                total += len(words)
                if train:
                    counts.update(words)
                if len(counts) >= COUNTED_WORDS:
                    yield rows(counts, total)
                    counts, total = Counter(), 0
        yield rows(counts, total)

    return docs.mapInArrow(run, "word long, n long, is_word boolean").groupBy("is_word", "word").agg(F.sum("n").alias("n"))


@dataclass
class Layout:
    """What all tasks know: contexts of one word, frequent words that are dealt out by context, number of parts."""

    own: dict[int, int]
    hot: np.ndarray
    parts: int


def _layout(docs: DataFrame) -> Layout:
    counts = stored(word_counts(docs))
    total = counts.filter("not is_word").agg(F.sum("n")).first()[0] or 0
    parts = max(LEAST_PARTS, -(-total // PART_TOKENS))
    top = counts.filter("is_word").orderBy(F.desc("n"), "word").limit(OWN_CONTEXTS).collect()
    hot = counts.filter("is_word").filter(F.col("n") > total / (4 * parts)).select("word").collect()  # under 4 * parts
    as_hash = lambda x: x & (1 << 64) - 1
    hot = np.array(sorted({as_hash(r.word) for r in hot} | {xxhash.xxh64_intdigest(_END)}), np.uint64)
    return Layout({as_hash(r.word): i for i, r in enumerate(top)}, hot, parts)


_BLOBS = ["words", "pairs_of_word", "contexts", "counts", "rows_of_pair", "rows", "repeats"]


def _deal(layout: Layout):  # noqa: ANN202
    """Rows of (part, chunk, arrays) for the word counts of each text, and for the texts themselves beyond the parts."""

    def chunk_rows(chunk: int, words: np.ndarray, contexts: np.ndarray, texts: np.ndarray, info: list[tuple]) -> Iterator[pa.RecordBatch]:
        hot = layout.hot[np.minimum(np.searchsorted(layout.hot, words), len(layout.hot) - 1)] == words
        mixed = (words >> np.uint64(17)) + np.where(hot, contexts.astype(np.uint64) * np.uint64(2654435761), np.uint64(0))
        part = (mixed % np.uint64(layout.parts)).astype(np.int32)
        order = np.lexsort((texts, contexts, words, part))
        part, words, contexts, texts = part[order], words[order], contexts[order], texts[order]
        new = np.flatnonzero(
            np.concatenate([[True], (texts[1:] != texts[:-1]) | (contexts[1:] != contexts[:-1]) | (words[1:] != words[:-1]) | (part[1:] != part[:-1])])
        )
        repeats = np.diff(np.append(new, len(words))).astype(np.uint32)
        part, words, contexts, texts = part[new], words[new], contexts[new], texts[new]
        cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(part)], strict=True):
            yield _row(int(part[a]), chunk, [_pack(words[a:b]), b"", _pack(contexts[a:b].astype(np.uint16)), b"", b"", _pack(texts[a:b]), _pack(repeats[a:b])])
        ids, trains, sizes = zip(*info, strict=True)
        known = np.array([i is not None for i in ids])
        about = [np.array([i or 0 for i in ids], np.int64), known, np.array(trains, bool), np.array(sizes, np.uint32)]
        yield _row(layout.parts + chunk % layout.parts, chunk, [*map(_pack, about), b"", b"", b""])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, context_of = _Hashes(), _Contexts(layout.own)
        chunk = TaskContext.get().partitionId() << 20
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        info: list[tuple] = []
        n = 0
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(at, SLICE_ROWS)
                lists = [tokens_of(t) for t in batch.column("text").to_pylist()]
                sizes = np.array([len(x) for x in lists])
                words = [w for x in lists for w in x]
                context = np.empty(len(words), np.int32)
                context[1:] = np.fromiter(map(context_of.__getitem__, words[:-1]), np.int32, len(words) - 1)
                context[np.cumsum(sizes) - sizes] = START
                hashed = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
                trains = batch.column("train").to_pylist()
                code = (np.arange(len(lists), dtype=np.uint32) + len(info)) << 1 | np.array(trains, np.uint32)
                held.append((hashed, context, np.repeat(code, sizes)))
                info += zip(batch.column("doc_id").to_pylist(), trains, sizes.tolist(), strict=True)
                n += len(words)
                if n >= CHUNK_TOKENS:
                    yield from chunk_rows(chunk, *(np.concatenate(x) for x in zip(*held, strict=True)), info)
                    chunk, held, info, n = chunk + 1, [], [], 0
        if info:
            yield from chunk_rows(chunk, *(np.concatenate(x) for x in zip(*held, strict=True)), info)

    return run


_SCHEMA = "part int, chunk long, " + ", ".join(f"{b} binary" for b in _BLOBS)


def _row(part: int, chunk: int, blobs: list[bytes]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64()] + [pa.binary()] * len(_BLOBS)
    return pa.record_batch([pa.array([x], k) for x, k in zip([part, chunk, *blobs], kinds, strict=True)], ["part", "chunk", *_BLOBS])


def _merge(parts: int):  # noqa: ANN202
    """One row for each part: words, contexts by word, and texts by context, each sorted; other rows as they are."""

    def run(table: pa.Table) -> pa.Table:
        part = table["part"][0].as_py()
        if part >= parts:
            return table
        chunks = table["chunk"].to_pylist()
        get = lambda name, kind: [_unpack(x, kind) for x in table[name].to_pylist()]
        texts = get("rows", np.uint32)
        rows = np.concatenate([t.astype(np.int64) | c << 24 for t, c in zip(texts, chunks, strict=True)])
        words, contexts = np.concatenate(get("words", np.uint64)), np.concatenate(get("contexts", np.uint16))
        repeats = np.concatenate(get("repeats", np.uint32))
        order = np.lexsort((rows, contexts, words))
        words, contexts, rows, repeats = words[order], contexts[order], rows[order], repeats[order]
        pair = np.flatnonzero(np.concatenate([[True], (words[1:] != words[:-1]) | (contexts[1:] != contexts[:-1])]))
        of_pair = words[pair]
        word = np.flatnonzero(np.concatenate([[True], of_pair[1:] != of_pair[:-1]]))
        sizes = [np.diff(np.append(x, n)).astype(np.uint32) for x, n in ((word, len(pair)), (pair, len(rows)))]
        counts = np.add.reduceat(repeats * (rows & 1).astype(np.uint32), pair).astype(np.uint32)
        blobs = [of_pair[word], sizes[0], contexts[pair], counts, sizes[1], rows, repeats]
        return pa.Table.from_batches([_row(part, 0, [_pack(x) for x in blobs])])

    return run


def _stirling(discount: float, size: int = _SMALL) -> np.ndarray:
    """Logarithms of the generalised Stirling numbers S(c, t), rows c, columns t."""
    out = np.full((size + 1, size + 1), -np.inf)
    out[1, 1] = 0
    for c in range(1, size):
        t = np.arange(1, c + 1)
        out[c + 1, 1 : c + 1] = out[c, 1 : c + 1] + np.log(c - discount * t)
        out[c + 1, 1 : c + 2] = np.logaddexp(out[c + 1, 1 : c + 2], out[c, 0 : c + 1])
    return out


_LOG_S = {d: _stirling(d) for d in (DISCOUNT, PARENT_DISCOUNT)}


def seat(customers: np.ndarray, weight: np.ndarray, discount: float, random: np.random.Generator) -> np.ndarray:
    """Numbers of tables for groups of customers, given the weight of a new table for each group."""
    tables = np.minimum(customers, 1)
    for c in range(2, _SMALL + 1):
        at = np.flatnonzero(customers == c)
        for k in range(0, len(at), 20_000):
            own = at[k : k + 20_000]
            chance = _LOG_S[discount][c, 1 : c + 1] + np.arange(1, c + 1) * np.log(weight[own])[:, None]
            tables[own] = 1 + (chance + random.gumbel(size=chance.shape)).argmax(1)
    at = np.flatnonzero(customers > _SMALL)
    if len(at):
        c, w = customers[at], weight[at]
        seated, t = np.ones(len(at), np.int64), np.ones(len(at), np.int64)
        while (open_ := seated < c).any():
            block = np.where(open_, np.minimum(c - seated, np.maximum(seated // 8, 1)), 0)
            t += random.binomial(block, w / (w + seated - discount * t))
            seated += block
        tables[at] = t
    return tables


@dataclass
class Corpus:
    """Training customers of each context and of each hot word, all training tokens, distinct training words."""

    contexts: np.ndarray
    hot: np.ndarray
    n: int
    v: int


@dataclass
class Totals:
    """Sums over all words after a sweep: tables of each context; customers and tables of each hot word in the
    parent; customers and tables of the whole parent."""

    tables: np.ndarray
    hot: np.ndarray
    hot_tables: np.ndarray
    customers: float
    parent_tables: float


def _new_in_parent(corpus: Corpus, parent_tables: float) -> float:
    return (PARENT_STRENGTH + PARENT_DISCOUNT * parent_tables) / (corpus.v + 1)


class Part:
    """The words of one part, and the chain of their seatings."""

    def __init__(self, row: dict, hot: np.ndarray) -> None:
        words, sizes = _unpack(row["words"], np.uint64), _unpack(row["pairs_of_word"], np.uint32)
        self.part = row["part"]
        self.contexts = _unpack(row["contexts"], np.uint16).astype(np.int64)
        self.counts = _unpack(row["counts"], np.uint32).astype(np.int64)
        self.word = np.repeat(np.arange(len(words)), sizes)
        place = np.minimum(np.searchsorted(hot, words), len(hot) - 1)
        self.hot = np.where(hot[place] == words, place, -1)
        self.is_hot = self.hot >= 0
        self.train = np.bincount(self.word, self.counts, len(words)).astype(np.int64)

    def unigrams(self, corpus: Corpus) -> np.ndarray:
        """Training counts of the words over all parts."""
        return np.where(self.is_hot, corpus.hot[self.hot], self.train)

    def draw(self, corpus: Corpus, parent: np.ndarray, totals: Totals | None, sweep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A sweep: tables of each pair; customers in the parent by word; tables in the parent, of words that are not hot."""
        random = np.random.default_rng([SEED, self.part, sweep])
        of_context = totals.tables if totals else 0.5 * corpus.contexts
        seen = np.flatnonzero(self.counts)
        tables = np.zeros(len(self.counts), np.int64)
        weight = (STRENGTH + DISCOUNT * of_context[self.contexts[seen]]) * parent[self.word[seen]]
        tables[seen] = seat(self.counts[seen], weight, DISCOUNT, random)
        customers = np.bincount(self.word, tables, len(self.train)).astype(np.int64)
        above = np.zeros(len(customers), np.int64)
        own = np.flatnonzero((customers > 0) & ~self.is_hot)
        new = _new_in_parent(corpus, totals.parent_tables if totals else 0.5 * corpus.v)
        above[own] = seat(customers[own], np.full(len(own), new), PARENT_DISCOUNT, random)
        return tables, customers, above

    def chain(self, corpus: Corpus, history: list[Totals]) -> Iterator[tuple[np.ndarray, np.ndarray, Totals | None, int]]:
        """Before the first sweep and after each sweep of the history: tables of the pairs, parent probabilities of
        the words, totals, and the number of the next sweep."""
        parent = (self.unigrams(corpus) + 0.5) / (corpus.n + 0.5 * (corpus.v + 1))
        tables, totals = np.zeros(len(self.counts), np.int64), None
        yield tables, parent, totals, 0
        for sweep, after in enumerate(history):
            tables, customers, above = self.draw(corpus, parent, totals, sweep)
            totals = after
            customers = np.where(self.is_hot, after.hot[self.hot], customers)
            above = np.where(self.is_hot, after.hot_tables[self.hot], above)
            mass = customers - PARENT_DISCOUNT * above + _new_in_parent(corpus, after.parent_tables)
            parent = mass / (PARENT_STRENGTH + after.customers)
            yield tables, parent, totals, sweep + 1


def _gathered(parts: DataFrame, size: int, add) -> np.ndarray:  # noqa: ANN001
    """Adds up arrays of a fixed size over all parts, within tasks and then by Spark; one array reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for i in range(batch.num_rows):
                total += add(batch.slice(i, 1).to_pylist()[0])
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at), pa.array(total[at])], ["place", "value"])

    out = np.zeros(size)
    sums = parts.select("part", "words", "pairs_of_word", "contexts", "counts").mapInArrow(run, "place long, value double")
    for row in sums.groupBy("place").agg(F.sum("value").alias("value")).collect():
        out[row.place] = row.value
    return out


def fit(parts: DataFrame, layout: Layout) -> tuple[Corpus, list[Totals]]:
    """Counts the corpus, then runs the sweeps; what is kept of each has a fixed size."""
    hot = layout.hot
    sums_at = CONTEXTS + len(hot)

    def count(row: dict) -> np.ndarray:
        part = Part(row, hot)
        by_hot = np.bincount(part.hot[part.is_hot], part.train[part.is_hot], len(hot))
        plain = np.count_nonzero(part.train[~part.is_hot])
        return np.concatenate([np.bincount(part.contexts, part.counts, CONTEXTS), by_hot, [part.train.sum(), plain]])

    got = _gathered(parts, sums_at + 2, count)
    of_hot = got[CONTEXTS:sums_at].astype(np.int64)
    corpus = Corpus(got[:CONTEXTS], of_hot, int(got[-2]), int(got[-1]) + int(np.count_nonzero(of_hot)))
    history: list[Totals] = []
    for sweep in range(SWEEPS):

        def one(row: dict, history: list[Totals] = tuple(history)) -> np.ndarray:
            part = Part(row, hot)
            for _, parent, totals, at in part.chain(corpus, history):
                pass
            tables, customers, above = part.draw(corpus, parent, totals, at)
            by_hot = np.bincount(part.hot[part.is_hot], customers[part.is_hot], len(hot))
            return np.concatenate([np.bincount(part.contexts, tables, CONTEXTS), by_hot, [customers.sum(), above.sum()]])

        got = _gathered(parts, sums_at + 2, one)
        customers = got[CONTEXTS:sums_at].astype(np.int64)
        new = _new_in_parent(corpus, history[-1].parent_tables if history else 0.5 * corpus.v)
        above = seat(customers, np.full(len(hot), new), PARENT_DISCOUNT, np.random.default_rng([SEED, sweep]))
        history.append(Totals(got[:CONTEXTS], customers, above, got[-2], got[-1] + above.sum()))
    return corpus, history


def _score(layout: Layout, corpus: Corpus, history: list[Totals]):  # noqa: ANN202
    """(chunk, part, texts, known, base, more): what the tokens of a part add to each text, by chunk of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["part"] >= layout.parts:
                    blobs = [row[b] for b in _BLOBS[:4]]
                    yield _scores(row["chunk"], -1, blobs)
                    continue
                part = Part(row, layout.hot)
                chance = np.zeros(len(part.counts))
                for tables, parent, totals, after in part.chain(corpus, history):
                    if after > BURN_IN or not history:
                        u = part.contexts
                        new = (STRENGTH + DISCOUNT * totals.tables[u]) * parent[part.word]
                        chance += (part.counts - DISCOUNT * tables + new) / (STRENGTH + corpus.contexts[u])
                n = part.unigrams(corpus)
                base = np.log10((n + 0.5) / (corpus.n + 0.5 * (corpus.v + 1)))[part.word]
                more = np.log10(chance / (len(history) - BURN_IN)) - base
                rows, repeats = _unpack(row["rows"], np.int64), _unpack(row["repeats"], np.uint32)
                pair = np.repeat(np.arange(len(base)), _unpack(row["rows_of_pair"], np.uint32))
                texts, place = np.unique(rows >> 1, return_inverse=True)
                add = lambda x: np.bincount(place, x[pair] * repeats, len(texts))
                sums = [add((n > 0)[part.word]).astype(np.uint32), add(base), add(more).astype(np.float32)]
                chunk = texts >> 23
                cuts = np.flatnonzero(np.concatenate([[True], chunk[1:] != chunk[:-1]]))
                for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(texts)], strict=True):
                    own = (texts[a:b] & (1 << 23) - 1).astype(np.uint32)
                    yield _scores(int(chunk[a]), part.part, [_pack(own), *(_pack(x[a:b]) for x in sums)])

    return run


_SCORES = "chunk long, part int, texts binary, known binary, base binary, more binary"


def _scores(chunk: int, part: int, blobs: list[bytes]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32()] + [pa.binary()] * 4
    names = ["chunk", "part", "texts", "known", "base", "more"]
    return pa.record_batch([pa.array([x], k) for x, k in zip([chunk, part, *blobs], kinds, strict=True)], names)


def _texts(n: int):  # noqa: ANN202
    """The rows of one chunk of texts, from what each part adds."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.sort_by("part").to_pylist()
        ids, known_id, train, sizes = (_unpack(rows[0][c], k) for c, k in zip(("texts", "known", "base", "more"), (np.int64, bool, bool, np.uint32), strict=True))
        known, base, more = np.zeros(len(ids), np.int64), np.zeros(len(ids)), np.zeros(len(ids))
        for row in rows[1:]:
            at = _unpack(row["texts"], np.uint32)
            known[at] += _unpack(row["known"], np.uint32)
            base[at] += _unpack(row["base"], np.float64)
            more[at] += _unpack(row["more"], np.float32)
        columns = {
            "doc_id": pa.array(ids, mask=~known_id), "held_out": pa.array(~train), "n_tokens": pa.array(sizes.astype(np.int64)),
            "n_known": pa.array(known), "train_tokens": pa.array(np.full(len(ids), n, np.int64)), "base_score": pa.array(base),
            "score": pa.array(base + more),
        }
        return pa.table(columns)

    return run


def score(docs: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every whole text.

    Learns from the texts that are not held out. A null text counts as empty: it has one token, the end. Equal rows
    give equal rows. With nothing to learn from, every token has the same probability. Other columns are not read.
    """
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"), (~held_out).alias("train"))
    layout = _layout(texts)
    dealt = texts.mapInArrow(_deal(layout), _SCHEMA)
    counts = stored(dealt.groupBy("part").applyInArrow(_merge(layout.parts), _SCHEMA))
    corpus, history = fit(counts.filter(F.col("part") < layout.parts), layout)
    added = counts.mapInArrow(_score(layout, corpus, history), _SCORES)
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return added.groupBy("chunk").applyInArrow(_texts(corpus.n), schema)
