"""Language identification by rank-order profiles.

A profile lists the most frequent character n-grams (one to three characters, padded at word ends) by rank. A
document gets the language whose profile its own ranking fits best: the out-of-place distance sums the
differences of ranks, with the profile's size for n-grams that it lacks.

N-grams are numbers of 21 bits a character, so that ties in frequency always have the same order.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import SLICE_ROWS, per_text

PROFILE_SIZE = 400
UNKNOWN = "und"
_BITS = 21
_BLANK = 1


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def ngrams(text: str) -> np.ndarray:
    """Codes of all n-grams of a text, with repeats. Every run of other characters counts as one blank."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    letter = _letters()[codes]
    if not letter.any():
        return np.empty(0, np.int64)
    codes[~letter] = _BLANK
    kept = letter.copy()
    kept[1:] |= letter[:-1]  # the first blank after a word
    codes = np.concatenate([[_BLANK], codes[kept], [_BLANK]])
    if codes[-2] == _BLANK:
        codes = codes[:-1]
    two = codes[:-1] << _BITS | codes[1:]
    three = (two[:-1] << _BITS | codes[2:])[codes[1:-1] != _BLANK]
    return np.concatenate([codes[codes != _BLANK], two, three])


def ranked(text: str, size: int = PROFILE_SIZE) -> np.ndarray:
    """The codes of the most frequent n-grams of a text, most frequent first, ties by code."""
    codes = np.sort(ngrams(text))
    if not len(codes):
        return codes
    starts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    counts = np.diff(np.concatenate([starts, [len(codes)]]))
    codes = codes[starts]
    if len(codes) > size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        codes, counts = codes[counts >= least], counts[counts >= least]
    return codes[np.lexsort((codes, -counts))][:size]


class Profiles:
    """Rank tables of all languages; equal distances go to the first language by name."""

    def __init__(self, rows: list[tuple[str, int, int]], size: int = PROFILE_SIZE) -> None:
        self.size = size
        self.langs = sorted({r[0] for r in rows})
        self.codes = np.array(sorted({r[1] for r in rows}), np.int64)
        self.ranks = np.full((len(self.codes) + 1, len(self.langs)), -1, np.int64)  # the last row: in no profile
        for lang, code, rank in rows:
            self.ranks[np.searchsorted(self.codes, code), self.langs.index(lang)] = rank

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and score: the best language's share of the nearness to all languages."""
        top = ranked(text, self.size) if text and self.langs else ()
        if not len(top):
            return UNKNOWN, 0.0
        at = np.searchsorted(self.codes, top)
        at[at == len(self.codes)] = 0
        at[self.codes[at] != top] = len(self.codes)
        ranks = self.ranks[at]
        away = np.where(ranks < 0, self.size, np.abs(ranks - np.arange(len(top))[:, None])).sum(0)
        near = 1 - away / (self.size * len(top))
        best = int(near.argmax())
        total = float(near.sum())
        return self.langs[best], float(near[best]) / total if total > 0 else 1 / len(self.langs)


def count_ngrams(docs: DataFrame) -> DataFrame:
    """lang, code, n over all documents with a language and a text; each task sends its sums only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def pack(lang: str) -> tuple[np.ndarray, np.ndarray]:
            codes, back = np.unique(np.concatenate([c for c, _ in held[lang]]), return_inverse=True)
            n = np.bincount(back, np.concatenate([n for _, n in held[lang]]), len(codes)).astype(np.int64)
            held[lang] = [(codes, n)]
            return codes, n

        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                texts: dict[str, list[str]] = {}
                part = batch.slice(at, SLICE_ROWS)
                for text, lang in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    texts.setdefault(lang, []).append(text)
                for lang, own in texts.items():
                    codes, n = np.unique(np.concatenate([ngrams(t) for t in own]), return_counts=True)
                    held.setdefault(lang, []).append((codes, n))
                    if sum(len(c) for c, _ in held[lang]) > 500_000:
                        pack(lang)
        for lang in held:
            codes, n = pack(lang)
            yield pa.record_batch([pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(n)], ["lang", "code", "n"])

    texts = docs.filter("text is not null and lang is not null").select("text", "lang")
    return texts.mapInArrow(run, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, size: int = PROFILE_SIZE) -> Profiles:
    """Profiles from the columns text and lang; languages times `size` rows reach the driver."""
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))
    rows = count_ngrams(docs).withColumn("rank", place).filter(F.col("rank") <= size)
    return Profiles([(r.lang, r.code, r.rank - 1) for r in rows.select("lang", "code", "rank").collect()], size)


def identify(docs: DataFrame, profiles: Profiles, held_out: Column) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every whole text.

    A text that is null or has no letter is `und` with score 0, as is every text when nothing was learned. Equal
    texts get equal answers. Other columns are not read.
    """

    def work(doc_ids: list, texts: list, held: list) -> dict:
        got = [profiles.predict(t) for t in texts]
        return {"doc_id": doc_ids, "held_out": held, "lang_pred": [g[0] for g in got], "score": [g[1] for g in got]}

    rows = docs.select("doc_id", "text", held_out.alias("held_out"))
    return per_text(rows, rows.columns, "doc_id long, held_out boolean, lang_pred string, score double", work)
