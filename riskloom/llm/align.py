"""Alignment of two tokenizers: which token of one stands for which of the other, over a whole corpus.

Both tokenizers cut the same bytes. Every stretch between two neighbouring cuts of either lies in exactly one token of each,
so the stretches are the links, and the cuts that both share bound the groups.

How often a pair of ids is linked comes from inverted bitmaps: for each pair the documents that hold it, one plane for
each bit of the number of times they do, in ranges of documents. Planes of the same pair and range are OR-merged; the
union of a pair's planes counts documents, and the planes counted by their weight count links. Then the same postings
hand the scores of the pairs back to the documents.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain, pairwise

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskloom.llm.common import stored


@dataclass(frozen=True)
class Layout:
    """How postings are cut. Results do not depend on it."""

    #: 2 to this power documents are a range: one posting never covers more, however many documents hold a pair.
    range_bits: int = 13
    #: Parts that the pairs are dealt into. Two vocabularies have a fixed number of pairs, so the parts need not grow
    #: with the documents.
    parts: int = 32
    #: 2 to this power ranges have their postings of a part scored together.
    group_bits: int = 6

    @property
    def size(self) -> int:
        return 1 << self.range_bits

    @property
    def sparse(self) -> int:
        """A posting with more documents is a bitmap of the range, one with fewer a list of places."""
        return self.size // 16

    def part_of(self, pair: np.ndarray) -> np.ndarray:
        """Neighbouring ids of A are about as frequent, so they are dealt to different parts."""
        return (pair >> B_BITS) % self.parts


#: Bytes of text that a task aligns at a time.
STEP_BYTES = 1 << 20
STEP_DOCS = 256
B_BITS = 16  # an id of B takes the lower bits of a pair

_DOCS = "ord long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>"


class Vocabulary:
    """A tokenizer, the bytes of its entries, and how a text is handed to it."""

    def __init__(self, encode, entries: list[bytes]):
        self.encode = encode
        self.entries = entries
        self.lengths = np.array([len(e) for e in entries], np.int64)
        self.words = np.array(entries, dtype=object)


def _byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: itself if printable, else the next free one from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    free = 256
    for b in range(256):
        if b not in plain:
            letters[chr(free)] = b
            free += 1
    return letters


@cache
def byte_vocabulary(path: str) -> Vocabulary:
    """A byte-level vocabulary of the tokenizers library; texts get a space in front, special strings are plain text.

    Where the merges stand in the order of the ids they make, as in the public vocabularies, ranks say the same as merges, and
    the faster library encodes by ranks. Otherwise the file's own library does.
    """
    file = json.loads(open(path, encoding="utf-8").read())
    vocab, merges = file["model"]["vocab"], [tuple(m.split(" ") if isinstance(m, str) else m) for m in file["model"]["merges"]]
    letters = _byte_letters()
    for token in file["added_tokens"]:
        vocab.pop(token["content"], None)  # special strings are plain text here, so their ids never come
    entries = [b""] * (max(vocab.values()) + 1)
    for entry, i in vocab.items():
        entries[i] = bytes(letters[c] for c in entry)
    made = [vocab[x + y] for x, y in merges]
    plain = file["pre_tokenizer"].get("type") == "ByteLevel" and not file["normalizer"] and file["model"].get("dropout") is None
    if plain and all(x < y for x, y in pairwise(made)) and len(made) + 256 == len(vocab):
        ranks = {entries[i]: i for i in vocab.values()}
        own = tiktoken.Encoding("align", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        return Vocabulary(lambda texts: [own.encode_ordinary(" " + t) for t in texts], entries)
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    slow = Tokenizer.from_file(path)
    slow.encode_special_tokens = True
    return Vocabulary(
        lambda texts: [e.ids for e in slow.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)], entries
    )


@cache
def piece_vocabulary(path: str) -> Vocabulary:
    """A vocabulary of sentencepiece, which puts the space in front itself; <0xHH> is a byte, U+2581 a space."""
    own = sentencepiece.SentencePieceProcessor(model_file=path)
    entries = []
    for i in range(own.get_piece_size()):
        piece = own.id_to_piece(i)
        entries.append(bytes([int(piece[3:5], 16)]) if own.is_byte(i) else piece.replace("▁", " ").encode())
    return Vocabulary(lambda texts: own.encode(texts, num_threads=1), entries)


@cache
def _labels(size: int, mark: bytes) -> np.ndarray:
    return np.array([b"%d%s" % (i, mark) for i in range(size)], dtype=object)


@dataclass
class Aligned:
    """Texts side by side: whether each is given back, its tokens of A and B, groups and links, its groups as text, and its linked
    pairs, ``first`` to the next one's, with the times each is linked."""

    good: np.ndarray
    facts: np.ndarray
    written: list[bytes]
    first: np.ndarray
    pairs: np.ndarray
    times: np.ndarray


def _given_back(texts: list[bytes], ids: np.ndarray, counts: np.ndarray, v: Vocabulary) -> np.ndarray:
    """Which texts the bytes of their tokens make up. All at once where all do."""
    lengths = np.array([len(t) for t in texts], np.int64)
    ends = np.r_[0, np.cumsum(v.lengths[ids])]
    at = np.r_[0, np.cumsum(counts)]
    same = np.diff(ends[at]) == lengths
    joined = b"".join(v.words[ids].tolist())
    if same.all() and joined == b"".join(texts):
        return same
    low, high = ends[at[:-1]].tolist(), ends[at[1:]].tolist()
    return np.array([joined[x:y] == t for x, y, t in zip(low, high, texts)])


def align(texts: list[str], a: Vocabulary, b: Vocabulary) -> Aligned:
    """Each text on its own, with a space in front. One that a tokenizer does not give back byte by byte has no tokens."""
    size = len(texts)
    raw = [b" " + t.encode() for t in texts]
    flat, counts, good = [], [], np.ones(size, bool)
    for v in (a, b):
        lists = v.encode(texts)
        counts.append(np.array([len(x) for x in lists], np.int64))
        flat.append(np.fromiter(chain.from_iterable(lists), np.int64, counts[-1].sum()))
        good &= _given_back(raw, flat[-1], counts[-1], v)
    if not good.all():
        for k in (0, 1):
            flat[k] = flat[k][np.repeat(good, counts[k])]
            counts[k] = np.where(good, counts[k], 0)
    (flat_a, flat_b), (n_a, n_b) = flat, counts
    ends_a, ends_b = np.cumsum(a.lengths[flat_a]), np.cumsum(b.lengths[flat_b])
    cuts = np.union1d(ends_a, ends_b)
    shared = np.intersect1d(ends_a, ends_b, assume_unique=True)
    token_a, token_b = np.searchsorted(ends_a, cuts), np.searchsorted(ends_b, cuts)
    text_ends = np.r_[0, ends_a][np.cumsum(n_a)]  # those without tokens end where the one before does
    owner = np.searchsorted(text_ends, cuts)
    links = np.bincount(owner, minlength=size)
    groups = np.bincount(np.searchsorted(text_ends, shared), minlength=size)
    owner, pairs, times = _summed(owner, flat_a[token_a] << B_BITS | flat_b[token_b], np.ones(len(cuts), np.int64))
    pieces = _write_groups(flat_a, ends_a, flat_b, ends_b, shared, len(a.entries), len(b.entries))
    at = [0, *np.cumsum(n_a + n_b).tolist()]
    written = [b"".join(pieces[x:y])[:-1] for x, y in pairwise(at)]
    return Aligned(good, np.stack((n_a, n_b, groups, links), axis=1), written, np.searchsorted(owner, np.arange(size + 1)), pairs, times)


def _summed(owner: np.ndarray, pairs: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owners and pairs in order, each once, with the sum of their times."""
    key = owner << 32 | pairs
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.r_[len(key) > 0, key[1:] != key[:-1]]) if len(key) else np.zeros(0, int)
    total = np.add.reduceat(times[order], first) if len(first) else np.zeros(0, np.int64)
    return key[first] >> 32, key[first] & 0xFFFFFFFF, total


_TWO_BLANKS, _BETWEEN = re.compile(r"\s\s"), re.compile(r"(?<=\S) (?=\S)")


def words_of(text: str) -> list[str]:
    """``text`` cut at single spaces between other characters. Both tokenizers start a token at each such space whatever
    stands around it, so that a word aligns alike wherever it is found."""
    if _TWO_BLANKS.search(text) or text[0].isspace() or text[-1].isspace():
        return _BETWEEN.split(text)
    return text.split(" ")


class Aligner:
    """Aligns whole texts by aligning each different word of a slice of texts once."""

    def __init__(self, a: Vocabulary, b: Vocabulary):
        self.a, self.b = a, b
        # A is split before its merges; pieces of B must not reach over a word's end. Otherwise texts stay whole
        self.cuts = not any(re.search(b"[^ ] ", e) for e in b.entries)

    def documents(self, texts: list[str | None]) -> dict[str, list]:
        """For each text its numbers of tokens, groups and links, the digest of its groups, and its linked pairs with the
        times each is linked. A text that is null, empty or not given back byte by byte by both has none."""
        size = len(texts)
        out = {
            "n_a": np.zeros(size, np.int64), "n_b": np.zeros(size, np.int64), "n_groups": np.zeros(size, np.int64),
            "n_links": np.zeros(size, np.int64), "groups_sha256": [""] * size, "pairs": [[]] * size, "times": [[]] * size,
        }
        asked = [i for i, t in enumerate(texts) if t]
        if not asked:
            return out
        number: dict[str, int] = {}
        parts = [
            np.array([number.setdefault(w, len(number)) for w in (words_of(texts[i]) if self.cuts else [texts[i]])]) for i in asked
        ]
        made = align(list(number), self.a, self.b)
        failed = [k for k, own in enumerate(parts) if not made.good[own].all()]
        if failed:  # what fails word by word is tried as a whole, apart from the others
            if self.cuts:
                whole = Aligner(self.a, self.b)
                whole.cuts = False
                for k in failed:
                    for name, value in whole.documents([texts[asked[k]]]).items():
                        out[name][asked[k]] = value[0]
            failed = set(failed)
            asked = [i for k, i in enumerate(asked) if k not in failed]
            parts = [own for k, own in enumerate(parts) if k not in failed]
            if not asked:
                return out
        lengths = np.array([len(own) for own in parts])
        flat = np.concatenate(parts)
        sums = np.add.reduceat(made.facts[flat], np.cumsum(lengths) - lengths, axis=0)
        for k, name in enumerate(("n_a", "n_b", "n_groups", "n_links")):
            out[name][asked] = sums[:, k]
        # each word of a text once, with its number there; then the pairs of the words
        key, count = np.unique(np.repeat(np.arange(len(asked)), lengths) << 32 | flat, return_counts=True)
        owner, word = key >> 32, key & 0xFFFFFFFF
        per = np.diff(made.first)[word]
        at = np.arange(per.sum()) + np.repeat(made.first[word] - (np.cumsum(per) - per), per)
        owner, pairs, times = _summed(np.repeat(owner, per), made.pairs[at], made.times[at] * np.repeat(count, per))
        bounds = np.searchsorted(owner, np.arange(len(asked) + 1))
        for k, (i, own) in enumerate(zip(asked, parts)):
            out["groups_sha256"][i] = hashlib.sha256(b";".join([made.written[w] for w in own.tolist()])).hexdigest()
            out["pairs"][i], out["times"][i] = pairs[bounds[k] : bounds[k + 1]], times[bounds[k] : bounds[k + 1]].astype(np.int32)
        return out


def _write_groups(flat_a, ends_a, flat_b, ends_b, shared, size_a, size_b) -> list[bytes]:
    """Decimal ids with the mark that follows each: those of A before those of B, group by group."""
    group_a, group_b = np.searchsorted(shared, ends_a), np.searchsorted(shared, ends_b)
    last_a, last_b = np.r_[group_a[1:] != group_a[:-1], True], np.r_[group_b[1:] != group_b[:-1], True]
    words = np.empty(len(flat_a) + len(flat_b), dtype=object)
    place = np.argsort(np.concatenate((group_a * 2, group_b * 2 + 1)), kind="stable")
    words_a = np.where(last_a, _labels(size_a, b"|")[flat_a], _labels(size_a, b",")[flat_a])
    words_b = np.where(last_b, _labels(size_b, b";")[flat_b], _labels(size_b, b",")[flat_b])
    words[:] = np.concatenate((words_a, words_b))[place]
    return words.tolist()


def encode_documents(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row for each document, numbered by ``ord``, with its counts, digest and linked pairs."""
    names = [part.split(" ")[0] for part in _DOCS.split(", ")]
    kinds = {"groups_sha256": pa.string(), "pairs": pa.list_(pa.int64()), "times": pa.list_(pa.int32())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Aligner(byte_vocabulary(a_path), piece_vocabulary(b_path))
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy()
            at = 0
            while at < batch.num_rows:
                # whole texts, as many as fit, one at least
                fit = int(np.searchsorted(np.cumsum(sizes[at : at + STEP_DOCS]), STEP_BYTES, "right"))
                part = batch.slice(at, max(1, fit))
                at += part.num_rows
                got = own.documents(part.column(2).to_pylist())
                got |= {"ord": part.column(0), "doc_id": part.column(1)}
                columns = [
                    got[n] if n in ("ord", "doc_id") else pa.array(got[n], kinds.get(n, pa.int64())) for n in names
                ]
                yield pa.record_batch(columns, names)

    rows = docs.select(
        F.monotonically_increasing_id().alias("ord"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    return rows.mapInArrow(run, _DOCS)


# ---- compressed bitmaps


def pack(keys: np.ndarray, places: np.ndarray, layout: Layout) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Bitmaps of the places of each key: the keys in order, how many places each has, and the containers one after the
    other. A container is a list of 16-bit places, or a bitmap of the range once that is shorter."""
    order = np.lexsort((places, keys))
    keys, places = keys[order], places[order]
    first = np.flatnonzero(np.r_[len(keys) > 0, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, int)
    counts = np.diff(np.r_[first, len(keys)])
    dense = np.repeat(counts > layout.sparse, counts)
    lists = places[~dense].astype("<u2").tobytes()
    maps = np.zeros((int((counts > layout.sparse).sum()), layout.size), bool)
    maps[np.repeat(np.arange(len(maps)), counts[counts > layout.sparse]), places[dense]] = True
    return keys[first], counts.astype(np.int32), lists + np.packbits(maps, axis=1).tobytes()


def unpack(keys: np.ndarray, counts: np.ndarray, blob: bytes, layout: Layout) -> tuple[np.ndarray, np.ndarray]:
    """The keys and places that ``pack`` was given, those of lists before those of bitmaps."""
    dense = counts > layout.sparse
    split = 2 * int(counts[~dense].sum())
    lists = np.frombuffer(blob, "<u2", count=split // 2).astype(np.int64)
    maps = np.unpackbits(np.frombuffer(blob, np.uint8, offset=split).reshape(-1, layout.size // 8), axis=1)
    row, place = np.nonzero(maps)
    return np.concatenate((np.repeat(keys[~dense], counts[~dense]), keys[dense][row])), np.concatenate((lists, place))


PLANES = 5  # bits of a key that name the plane

_POSTINGS = "part int, range long, keys array<long>, counts array<int>, blob binary"


def invert(rows: DataFrame, layout: Layout) -> DataFrame:
    """Postings of each batch of documents, by part of the pairs and range of documents.

    A key is a pair and a plane: plane k holds the documents that link the pair a number of times with bit k.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = batch.column(0).to_numpy()
            lists = batch.column(1)
            pair = lists.flatten().to_numpy()
            times = batch.column(2).flatten().to_numpy().astype(np.int64)
            owner = np.repeat(number, np.diff(lists.offsets.to_numpy()))
            cell = (owner >> layout.range_bits) * layout.parts + layout.part_of(pair)
            order = np.argsort(cell, kind="stable")
            pair, times, owner, cell = pair[order], times[order], owner[order], cell[order]
            starts = np.flatnonzero(np.r_[len(cell) > 0, cell[1:] != cell[:-1]]) if len(cell) else []
            for low, high in zip(starts, [*starts[1:], len(cell)]):
                keys, counts, blob = pack(*_planes(pair[low:high], times[low:high], owner[low:high] & (layout.size - 1)), layout)
                yield _posting(int(cell[low] % layout.parts), int(cell[low] // layout.parts), keys, counts, blob)

    return rows.select("ord", "pairs", "times").mapInArrow(run, _POSTINGS)


def _planes(pair: np.ndarray, times: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, places = [], []
    for k in range(int(times.max()).bit_length()):
        on = times >> k & 1 == 1
        keys.append(pair[on] << PLANES | k)
        places.append(place[on])
    return np.concatenate(keys), np.concatenate(places)


def _posting(part: int, at: int, keys, counts, blob) -> pa.RecordBatch:
    columns = [
        pa.array([part], pa.int32()), pa.array([at], pa.int64()), pa.array([keys], pa.list_(pa.int64())),
        pa.array([counts], pa.list_(pa.int32())), pa.array([blob], pa.binary()),
    ]
    return pa.record_batch(columns, ["part", "range", "keys", "counts", "blob"])


def _each(table: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray, bytes]]:
    keys, counts = table.column("keys").combine_chunks(), table.column("counts").combine_chunks()
    for i in range(table.num_rows):
        yield table.column("range")[i].as_py(), keys[i].values.to_numpy(), counts[i].values.to_numpy(), table.column("blob")[i].as_py()


_MERGED = f"{_POSTINGS}, pairs array<long>, docs array<long>, links array<long>"


def merge(posted: DataFrame, layout: Layout) -> DataFrame:
    """OR of the postings of the same part and range, with the documents and links of each pair in it.

    A group holds at most ``layout.size`` documents, so the most frequent pair is as small here as any range can make it.
    """

    def run(key: tuple, table: pa.Table) -> pa.Table:
        both = [unpack(k, c, blob, layout) for _, k, c, blob in _each(table)]
        keys, places = np.concatenate([k for k, _ in both]), np.concatenate([p for _, p in both])
        out_keys, counts, blob = pack(keys, places, layout)
        pairs, at = np.unique(out_keys >> PLANES, return_inverse=True)
        links = np.zeros(len(pairs), np.int64)
        np.add.at(links, at, counts.astype(np.int64) << (out_keys & (1 << PLANES) - 1))
        # the union of a pair's planes: each document once
        union = np.unique((keys >> PLANES) << layout.range_bits | places) >> layout.range_bits
        docs = np.diff(np.r_[np.searchsorted(union, pairs), len(union)])
        one = _posting(key[0].as_py(), key[1].as_py(), out_keys, counts, blob)
        more = {"pairs": pairs, "docs": docs.astype(np.int64), "links": links}
        for name, values in more.items():
            one = one.append_column(name, pa.array([values], pa.list_(pa.int64())))
        return pa.Table.from_batches([one])

    return posted.groupBy("part", "range").applyInArrow(run, _MERGED)


def pair_counts(merged: DataFrame) -> DataFrame:
    """pair, a, b, docs, links, best (docs is the highest of all pairs of a)."""
    rows = merged.select(F.explode(F.arrays_zip("pairs", "docs", "links")).alias("x")).select("x.*")
    pairs = rows.groupBy(F.col("pairs").alias("pair")).agg(F.sum("docs").alias("docs"), F.sum("links").alias("links"))
    pairs = stored(pairs.select(F.shiftright("pair", B_BITS).alias("a"), F.col("pair").bitwiseAND((1 << B_BITS) - 1).alias("b"), "*"))
    most = pairs.groupBy("a").agg(F.max("docs").alias("most"))
    return pairs.join(most, "a").select("pair", "a", "b", "docs", "links", (F.col("docs") == F.col("most")).alias("best"))


def scores(merged: DataFrame, counted: DataFrame, layout: Layout) -> DataFrame:
    """ord, count_sum, n_best: the postings hand the counts of their pairs to the documents they hold.

    The counts of a part meet its postings in groups of ranges, so that neither side of a group grows with the corpus.
    """
    part = (F.col("a") % layout.parts).cast("int")
    tables = counted.groupBy(part.alias("part")).agg(F.array_sort(F.collect_list(F.struct("pair", "docs", "best"))).alias("own"))
    tables = tables.select(
        "part", F.col("own.pair").alias("pair"), F.col("own.docs").alias("docs"), F.col("own.best").alias("best")
    )
    group = F.shiftright("range", layout.group_bits).alias("group")
    posted = merged.select("part", group, "range", "keys", "counts", "blob")
    wanted = merged.select("part", group).distinct()
    tables = tables.join(wanted, "part")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        ranges, sums = [], []
        if left.num_rows and right.num_rows:
            pair = right.column("pair").combine_chunks()[0].values.to_numpy()
            docs = right.column("docs").combine_chunks()[0].values.to_numpy()
            best = right.column("best").combine_chunks()[0].values.to_numpy(zero_copy_only=False).astype(np.int64)
            found: dict[int, np.ndarray] = {}
            for at, keys, counts, blob in _each(left):
                key, place = unpack(keys, counts, blob, layout)
                row = np.searchsorted(pair, key >> PLANES)
                weight = np.int64(1) << (key & (1 << PLANES) - 1)
                own = found.setdefault(at, np.zeros((2, layout.size), np.int64))
                np.add.at(own[0], place, docs[row] * weight)
                np.add.at(own[1], place, best[row] * weight)
            ranges, sums = list(found), [s.astype("<i8").tobytes() for s in found.values()]
        return pa.table({"range": pa.array(ranges, pa.int64()), "sums": pa.array(sums, pa.binary())})

    partial = posted.groupBy("part", "group").cogroup(tables.groupBy("part", "group")).applyInArrow(run, "range long, sums binary")

    def total(key: tuple, table: pa.Table) -> pa.Table:
        own = np.zeros((2, layout.size), np.int64)
        for blob in table.column("sums").to_pylist():  # one for each part
            own += np.frombuffer(blob, "<i8").reshape(2, layout.size)
        place = np.flatnonzero(own[0])
        number = (key[0].as_py() << layout.range_bits) + place
        return pa.table({"ord": number, "count_sum": own[0][place], "n_best": own[1][place]})

    return partial.groupBy("range").applyInArrow(total, "ord long, count_sum long, n_best long")


def alignment(docs: DataFrame, a_path: str, b_path: str, layout: Layout = Layout()) -> tuple[DataFrame, DataFrame]:
    """The documents with their alignment, and the linked pairs of the corpus (a, b, docs, links, best).

    Documents: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256; one row for each row of `docs`, also
    where the doc_id repeats or is null. Null and empty texts, and texts that one of the tokenizers does not give back
    byte by byte, have zeros and ''. Other columns are not read. An empty table gives no rows.
    """
    rows = stored(encode_documents(docs, a_path, b_path))
    merged = stored(merge(invert(rows, layout), layout))
    counted = stored(pair_counts(merged))
    own = rows.drop("pairs", "times").join(scores(merged, counted, layout), "ord", "left")
    nothing = F.lit(0).cast("long")
    return own.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", nothing).alias("n_best"),
        F.coalesce("count_sum", nothing).alias("count_sum"), "groups_sha256",
    ), counted.drop("pair")
