"""Byte-level BPE by prefix dynamic programming.

For every byte prefix of a piece there is exactly one token that can end its encoding. These last tokens are
found from left to right: of the tokens that end at the prefix, the valid one is the one whose neighbour to the
left (the last token of the remaining prefix) cannot merge with it into another token on the way. Following the
last tokens backwards gives the encoding. A table of last tokens never changes when bytes are appended, so that
`Prefixes.append` is exact, and `Prefixes.replace` re-encodes only from the edit on.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Sequence
from functools import lru_cache
from itertools import chain

import ahocorasick
import regex
from pyspark.sql import DataFrame

from riskloom.llm.common import per_text

#: Chunks, and pairs of tokens, that a worker remembers; some 300 bytes each, twice over.
CACHE_CHUNKS = 120_000
_BITS = 20
#: In chunks between spaces: where white space meets white space, here or at the next space.
_MEETS = re.compile(r"\A\Z|\A\s|\s\Z|\s\s|[\x1c-\x1f]")
#: Chunks of letters, and marks behind them: a piece each. Only blocks in which every character is a letter or a mark.
_WORD = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([!-/:-@\[-`{-~]*)")


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of lines `base64 rank`."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


class Prefixes:
    """The last tokens of every prefix of a growing byte string."""

    def __init__(self, coder: Coder, data: bytes = b"") -> None:
        self.coder, self.data, self.last = coder, b"", []
        self.append(data)

    def append(self, more: bytes) -> None:
        start = len(self.data)
        self.data += more
        self.coder.extend(self.data, self.last, start)

    def replace(self, start: int, end: int, new: bytes) -> None:
        """Puts `new` for the bytes from start to end; prefixes that end before `start` keep their tokens."""
        tail = self.data[end:]
        self.data, self.last = self.data[:start], self.last[:start]
        self.append(new + tail)

    def tokens(self) -> list[int]:
        return self.coder.trace(self.last)


class _Meets(Exception):
    """The chunk's pieces may depend on what stands around it."""


class _Known(dict):
    """Remembers answers. When it is full, the older half goes, but for what is asked for again."""

    def __init__(self, find: Callable, size: int) -> None:
        self.find, self.size, self.old = find, size, {}

    def __missing__(self, key):  # noqa: ANN001, ANN204
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        known = self.old.get(key)
        self[key] = known = self.find(key) if known is None else known
        return known


class Coder:
    """Encodes and decodes by rank tables; `pattern` cuts a text into pieces that are encoded apart."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, remember: int = CACHE_CHUNKS) -> None:
        self.ranks, self.remember = ranks, remember
        self.pieces = regex.compile(pattern)
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.suffixes = ahocorasick.Automaton()
        self.single = {}
        for token, rank in ranks.items():
            if len(token) > 1:
                self.suffixes.add_word(token.decode("latin-1"), (len(token), rank))
            else:
                self.single[token.decode("latin-1")] = rank
        self.suffixes.make_automaton()
        self.sizes = {i: len(b) for b, i in ranks.items()}
        self.longest = max(map(len, ranks), default=0)
        self.halves: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        self.apart: dict[int, bool] = {}
        # what is remembered are tuples of plain values: unlike lists, the garbage collector need not visit them again
        self.chunks = _Known(self._after_space, remember)
        self.written = _Known(self._write_after_space, remember)
        self.known = _Known(lambda x: tuple(self.piece(x.encode())), remember)
        self.names = {i: str(i) for i in self.bytes_of}
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            if len(token) > 1:
                for cut in range(1, len(token)):
                    a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                    if a is not None and b is not None and a < rank and b < rank and self._pair(a, b):
                        self.halves[rank], self.merged[a, b] = (a, b), rank
                        break
                else:
                    raise ValueError(f"token {rank} cannot be reached by merges")

    def _pair(self, left: int, right: int) -> bool:
        """Whether the two tokens stay apart when their bytes are encoded together."""
        merged, halves = self.merged, self.halves
        limit = 1 << 60
        while True:
            both = merged.get((left, right))
            if both is not None and both < limit:
                return False
            if left > right:
                limit = left
                parts = halves.get(left)
                if parts is not None:
                    left = parts[1]
                    continue
                limit = right + 1
                parts = halves.get(right)
                if parts is None:
                    return True
                right = parts[0]
            else:
                limit = right + 1
                parts = halves.get(right)
                if parts is not None:
                    right = parts[0]
                    continue
                limit = left
                parts = halves.get(left)
                if parts is None:
                    return True
                left = parts[1]

    def extend(self, data: bytes, last: list[int], start: int) -> None:
        """Appends to `last` the last token of each prefix of `data` that ends after `start`."""
        base = max(0, start - self.longest + 1) if start else 0
        text = data[base:].decode("latin-1") if base else data.decode("latin-1")
        known, single, add, done = self.apart.get, self.single, last.append, start - base
        for end, (size, token) in self.suffixes.iter(text):
            if end >= done:
                while done < end:  # no longer token ends here
                    add(single[text[done]])
                    done += 1
                before = base + end - size
                if before >= 0:
                    left = last[before]
                    apart = known(left << _BITS | token)
                    if apart is None:
                        apart = self._learn(left, token)
                    if not apart:
                        continue
                add(token)
                done += 1
        for x in text[done:]:
            add(single[x])

    def _learn(self, left: int, right: int) -> bool:
        if len(self.apart) > self.remember:
            self.apart.clear()
        known = self.apart[left << _BITS | right] = self._pair(left, right)
        return known

    def trace(self, last: list[int]) -> list[int]:
        out, at, sizes = [], len(last) - 1, self.sizes
        while at >= 0:
            token = last[at]
            out.append(token)
            at -= sizes[token]
        out.reverse()
        return out

    def piece(self, data: bytes) -> list[int]:
        if not data:
            return []
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        last: list[int] = []
        self.extend(data, last, 0)
        return self.trace(last)

    def chunk(self, text: str) -> list[int]:
        """Ids of a text, piece by piece."""
        return list(chain.from_iterable(map(self.known.__getitem__, self.pieces.findall(text))))

    def _after_space(self, text: str) -> tuple[int, ...]:
        word = _WORD.fullmatch(text)
        if word:
            letters, marks = word.groups()
            if not marks:
                return tuple(self.piece((" " + letters).encode()))
            return self.chunks[letters] + self.known[marks]
        if _MEETS.search(text):
            raise _Meets
        return tuple(self.chunk(" " + text))

    def _write(self, ids: Sequence[int]) -> tuple[str, bytes]:
        return self.named(ids), self.decode(ids)

    def _write_after_space(self, text: str) -> tuple[str, bytes]:
        word = _WORD.fullmatch(text)
        if word:
            letters, marks = word.groups()
            if not marks:
                return self._write(self.piece((" " + letters).encode()))
            (names, data), ids = self.written[letters], self.known[marks]
            return f"{names},{self.named(ids)}", data + self.decode(ids)
        return self._write(self._after_space(text))

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text.

        A piece that holds a space holds it in front, or is white space only. So where no two white space
        characters meet, the text falls into chunks before each space, and repeated chunks are encoded once.
        """
        first, *rest = text.split(" ")
        try:
            return [*self.chunk(first), *chain.from_iterable(map(self.chunks.__getitem__, rest))]
        except _Meets:
            return self.chunk(text)

    def write(self, text: str) -> tuple[str, bytes]:
        """The ids of a whole text, as `named`, and what they decode to.

        Both follow chunk by chunk, so that a repeated chunk is encoded, named and decoded once.
        """
        first, *rest = text.split(" ")
        try:
            parts = [*map(self.written.__getitem__, rest)]
        except _Meets:
            return self._write(self.chunk(text))
        if first:
            parts.insert(0, self._write(self.chunk(first)))
        if not parts:
            return "", b""
        names, data = zip(*parts, strict=True)
        return ",".join(names), b"".join(data)

    def forget(self) -> None:
        """Frees what was remembered of texts."""
        for known in (self.chunks, self.written, self.known):
            known.clear()
            known.old = {}
        self.apart.clear()

    def named(self, ids: Sequence[int]) -> str:
        return ",".join(map(self.names.__getitem__, ids))

    def decode(self, ids: Sequence[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=2)
def coder(path: str, pattern: str, remember: int = CACHE_CHUNKS) -> Coder:
    """One coder per worker process and vocabulary file."""
    return Coder(read_ranks(path), pattern, remember)


def encode_texts(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids (array of token ids) and round_trip (the ids give back the text) of every whole text.

    A null text counts as empty and has no ids. Equal rows give equal rows. Columns other than doc_id and text
    are not read. `path` must be readable on the executors, as a library's own files are.
    """

    def work(doc_ids: list, texts: list) -> dict:
        tool = coder(path, pattern)
        ids = [tool.encode(t or "") for t in texts]
        same = [tool.decode(x) == (t or "").encode() for t, x in zip(texts, ids, strict=True)]
        return {"doc_id": doc_ids, "n_tokens": [len(x) for x in ids], "ids": ids, "round_trip": same}

    return per_text(docs, ["doc_id", "text"], "doc_id long, n_tokens long, ids array<int>, round_trip boolean", work, lambda: coder(path, pattern).forget())


def digest_texts(docs: DataFrame, path: str, pattern: str, remember: int = 400_000) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encodes, decodes the ids again and returns digests only.

    As a job of its own it may remember more than a stage among others, and from one task to the next.
    """

    def work(doc_ids: list, texts: list) -> dict:
        tool = coder(path, pattern, remember)
        out: dict[str, list] = {"doc_id": doc_ids, "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        for text in texts:
            names, data = tool.write(text or "")
            out["n_tokens"].append(names.count(",") + 1 if names else 0)
            out["ids_sha256"].append(hashlib.sha256(names.encode()).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(data).hexdigest())
        return out

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return per_text(docs, ["doc_id", "text"], schema, work)
