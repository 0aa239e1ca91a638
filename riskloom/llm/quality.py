"""Quality classification by a regularised quadratic discriminant over document statistics.

Statistics of a text are transformed (logarithms of sizes, log-odds of shares) so that each class is roughly
normal. Each class has a mean and a covariance; the covariance is shrunk towards the pooled one and towards a
multiple of the unit matrix. The score is the posterior from the difference of the two log-densities, with
Mahalanobis distances by Cholesky factors that are computed once.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import SLICE_ROWS, per_text, stored

TO_POOLED = 0.1
TO_UNIT = 0.02
#: Documents at or above this score are kept.
THRESHOLD = 0.3

STATISTICS = (
    "words", "word length", "words a line", "capitals", "digits", "marks", "other symbols", "bars",
    "distinct words", "most frequent word", "word as before", "words ending in marks", "capital words",
    "repeated lines", "line ends", "longest word",
)
_SIZE = len(STATISTICS)
_UPPER, _DIGIT = slice(0x41, 0x5B), slice(0x30, 0x3A)
_COMMON = np.array([ord(c) for c in ".,;:'\"-()?!"])
_BAR = ord("|")
_ASCII_MARK = np.array([i for i in range(0x21, 0x7F) if not chr(i).isalnum()])


def _odds(part: float, n: int, usual: float, weight: float = 8.0) -> float:
    """Log-odds of `part` cases of n, after adding `weight` cases with the usual share: few words prove little."""
    return float(np.log((part + weight * usual) / (n - part + weight * (1 - usual))))


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of a whole text; null and empty texts are texts without words."""
    text = text or ""
    words = text.split()
    n = len(words)
    bytes_ = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256)
    size = int(bytes_[:0x80].sum() + bytes_[0xC0:].sum())  # characters
    inside = sum(map(len, words))
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x]
    marks, common = int(bytes_[_ASCII_MARK].sum()), int(bytes_[_COMMON].sum())
    again = sum(a == b for a, b in zip(words, words[1:], strict=False))
    return [
        float(np.log1p(n)),
        float(np.log((inside + 40) / (n + 8))),
        float(np.log((n + 16) / (len(lines) + 1))),
        _odds(int(bytes_[_UPPER].sum()), size, 0.03, 40),
        _odds(int(bytes_[_DIGIT].sum()), size, 0.005, 40),
        _odds(common, size, 0.02, 40),
        _odds(marks - common - int(bytes_[_BAR]), size, 0.005, 40),
        _odds(int(bytes_[_BAR]), size, 0.005, 40),
        _odds(len(counts), n, 0.8),
        _odds(max(counts.values(), default=0), n, 0.08),
        _odds(again, max(n - 1, 0), 0.02),
        _odds(sum(not w[-1].isalnum() and w[-1] not in ".,;:?" for w in words), n, 0.02),
        _odds(sum(map(str.isupper, words)), n, 0.02),
        _odds(len(lines) - len(set(lines)), len(lines), 0.05),
        _odds(sum(x[-1] in ".?!:" for x in lines), len(lines), 0.9),
        float(np.log(max(map(len, words), default=0) + 8)),
    ]


class Discriminant:
    """Two normal densities with shrunken covariances. Without examples of both classes the score is the prior."""

    def __init__(self, n: np.ndarray, sums: np.ndarray, products: np.ndarray) -> None:
        self.prior = float(n[1] / n.sum()) if n.sum() else 0.5
        self.fitted = bool((n > 1).all())
        if not self.fitted:
            return
        means = sums / n[:, None]
        spreads = products / n[:, None, None] - means[:, :, None] * means[:, None, :]
        pooled = (spreads * n[:, None, None]).sum(0) / n.sum()
        scale = np.sqrt(np.maximum(np.diag(pooled), 1e-6))
        self.scale, self.means = scale, means / scale
        unit = scale[:, None] * scale[None]
        pooled, spreads = pooled / unit, spreads / unit
        self.inverse, self.log_det = [], []
        for spread in spreads:
            mixed = (1 - TO_POOLED) * spread + TO_POOLED * pooled
            mixed = (1 - TO_UNIT) * mixed + TO_UNIT * max(np.trace(mixed) / len(mixed), 1e-3) * np.eye(len(mixed))
            factor = np.linalg.cholesky(mixed)
            self.inverse.append(np.linalg.inv(factor))
            self.log_det.append(2 * float(np.log(np.diag(factor)).sum()))

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Posterior probability of label 1 for each row of statistics."""
        if not self.fitted:
            return np.full(len(rows), self.prior)
        logs = []
        for mean, inverse, log_det in zip(self.means, self.inverse, self.log_det, strict=True):
            away = (rows / self.scale - mean) @ inverse.T
            logs.append(-0.5 * ((away**2).sum(1) + log_det))
        lead = logs[1] - logs[0] + np.log(self.prior / (1 - self.prior))
        return 1 / (1 + np.exp(-np.clip(lead, -500, 500)))


def describe(docs: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out and the statistics of every whole text."""

    def work(doc_ids: list, texts: list, held: list) -> dict:
        return {"doc_id": doc_ids, "held_out": held, "stats": [statistics(t) for t in texts]}

    rows = docs.select("doc_id", "text", held_out.alias("held_out"))
    return per_text(rows, rows.columns, "doc_id long, held_out boolean, stats array<double>", work)


def fit(described: DataFrame, labels: DataFrame) -> Discriminant:
    """Class moments of the rows that are not held out and have a label 0 or 1; other labels teach nothing.

    Each pair of a document row and a label row with its id is an example. Tasks send sums only, and the sums of
    all tasks are added by Spark, so that two small matrices reach the driver.
    """
    wanted = labels.select("doc_id", F.col("quality").alias("label")).filter("label in (0, 1) and doc_id is not null")
    known = described.filter("not held_out").join(wanted, "doc_id").select("label", "stats")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 + _SIZE + _SIZE * _SIZE))
        for batch in batches:
            label = np.asarray(batch.column(0))
            x = np.asarray(batch.column(1).flatten()).reshape(-1, _SIZE)
            for k in (0, 1):
                own = x[label == k]
                total[k] += np.concatenate([[len(own)], own.sum(0), (own.T @ own).ravel()])
        at = np.arange(total.size)
        yield pa.record_batch([pa.array(at), pa.array(total.ravel())], ["place", "value"])

    sums = known.mapInArrow(run, "place long, value double").groupBy("place").agg(F.sum("value").alias("value"))
    total = np.zeros(2 * (1 + _SIZE + _SIZE * _SIZE))
    for row in sums.collect():
        total[row.place] = row.value
    total = total.reshape(2, -1)
    return Discriminant(total[:, 0], total[:, 1 : 1 + _SIZE], total[:, 1 + _SIZE :].reshape(2, _SIZE, _SIZE))


def score(described: DataFrame, model: Discriminant, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of `describe`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = model.scores(np.asarray(batch.column(2).flatten()).reshape(-1, _SIZE))
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(got), pa.array((got >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    return described.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, score, predicted for every document, learned from those that are not held out.

    The statistics are stored once, as a narrow table in the shared folder. Null and empty texts are scored like
    any other; equal texts get equal scores; other columns are not read. Without labels of both classes every
    score is the share of label 1 (0.5 without any).
    """
    described = stored(describe(docs, held_out))
    return score(described, fit(described, labels))


def keep_good(docs: DataFrame, labels: DataFrame, held_out: Column, threshold: float = THRESHOLD) -> DataFrame:
    """The documents, all columns as they are, whose score reaches the threshold."""
    model = fit(describe(docs, held_out), labels)
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(at, SLICE_ROWS)
                rows = np.array([statistics(t) for t in batch.column(place).to_pylist()])
                yield batch.filter(pa.array(model.scores(rows) >= threshold))

    return docs.mapInArrow(run, docs.schema)
