"""Personal data: base patterns, and a linear-chain conditional random field over word shapes that adds to them.

The field labels each word O or with a kind. A word's score for a label is the sum of the weights of its own
shape features and of its neighbours' shapes; a pair of labels has a weight too. The weights are fitted on
`LABELLED` by the exact gradient (forward-backward). A plain word, without a digit and without an @, starts with a
fixed lead for O (`PLAIN_LEAD`). `Field.margin` shows for the fitted weights that O therefore wins at every plain
word among plain words; so the best path splits there, and Viterbi is run on the stretches between them, in numpy
batches of equal length. The result is that of Viterbi over whole lines.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import SLICE_ROWS, per_text

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *KINDS)

#: The small labelled table: personal data stands in brackets after its kind. The lines are written by hand. The plain
#: numbers of 16 digits that fail the Luhn check, and the card in a table row, are drawn at random, not taken from documents.
LABELLED = (
    "Write to [email anna.berg@example.org] or come by at 12:30 on 4 May 2021.",
    "Contact: [email j_doe77@mail.example.com], phone [phone +1 (415) 555-0134].",
    "Her address is [email maría.lópez@correo.example.es] and his is unknown.",
    "The server [ip 192.168.10.24] answered 17 of 20 calls in 3.5 seconds.",
    "Login from [ip 10.0.0.7] at 08:15, then from [ip 172.16.254.1] at 09:02.",
    "Pay with card [card 4539 1488 0343 6467] before 31.12.2024 please.",
    "Card number [card 4716-1080-9971-6531] expires 08/27 and costs 12.50 a year.",
    "Charge [card 5500005555555559] for order 10442 of last week.",
    "Call [phone +44 20 7946 0958] between 9 and 17 on weekdays.",
    "Appelez le [phone +33 1 70 18 99 00] ou écrivez à [email service@exemple.fr] avant 18 h.",
    "Telefon [phone +49 30 901820-0], Fax [phone +49 30 901820-1], Zimmer 214.",
    "Llame al [phone +34 912 345 678] o al [phone +34 600 123 456] hoy.",
    "Reach me on [phone (212) 555-0187] or [phone 212-555-0142] after 6 pm.",
    "Our office: [phone 020-7946-0991], room 12, floor 3.",
    "Mail [email first.last+tag@sub.example.co.uk]; the old one was [email old@host.example.net].",
    "Host [ip 203.0.113.99] and host [ip 198.51.100.23] were blocked in 2019.",
    "Version 2.0.1 replaced version 1.9.12 on 2020-03-15 at 23:59:59.",
    "In 1999 some 12,500 people paid 3.50 each, 7% more than in 1998.",
    "See section 4.2 and figure 12.1 on page 118 of volume 3.",
    "Licensed under CC BY-NC 4.0. All rights reserved 2015.",
    "The Apache License, Version 2.0. and the General Public License, version 3.",
    "token = \"9f86d081884c7d659a2feaa0c55ad015a3bf4f1b\" was found in file 7",
    "commit 3c4226790fc3f8022bcc4434e93601b2005f1325 changed 14 files",
    "id 550e8400-e29b-41d4-a716-446655440000 and build 20210304.1122",
    "Follow @news and @weather for more, they say.",
    "Meet @ 5 pm @ the station, platform 9.",
    "Python 3.11.4 and Java 17.0.8 run on 64 bit machines.",
    "The score was 3-1 after 90 minutes, then 5-4.",
    "ISBN 978-3-16-148410-0 costs 29.95 and weighs 480 g.",
    "It has 6.02e23 parts, 1/3 of them at 20.5 degrees.",
    "The quick brown fox jumps over the lazy dog and runs away.",
    "La casa de la abuela está en la calle mayor del pueblo.",
    "Die Kinder spielen heute im Garten und singen ein Lied.",
    "Le chat dort sur la chaise près de la fenêtre ouverte.",
    "THIS IS ALL IN CAPITALS!! AND VERY LOUD!! [ip 192.0.2.44]!! SO IT IS!!",
    "some*** odd### marks$$$ here%%% [email bob@example.com]### then%%% more&&&",
    "marks&&& again*** [card 4111111111111111]$$$ and### [phone +1 (303) 555-0199]%%% end***",
    "| name | [email kim@mail2.example.com] | [phone +1 (206) 555-0111] | 42 | [ip 8.8.4.4] |",
    "| total | 1234 | 5678 | 90 | 12 | 7 | 2019 | 2020 | 2021 |",
    "Serial 4539148803436468 and lot 0234513818277658 are not for sale.",
    "The count was 6852540263509614 then 1450619226046364 and at last 0858300233815576.",
    "item*** 4303731028839919$$$ and### 5402017358924986!! are parts",
    "| 5810705190877014 | 7123441136492641 | words | [card 4782351444059144] |",
    "Numbers 1234 5678 and 2345 are lottery picks of 2018, 2019 and 2020.",
)

PLAIN_LEAD = 40.0

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_MARK = re.compile(r"[0-9@]")
_WORD = re.compile(r"\S+")
_EDGE = ".,;:!?|()[]{}<>\"'*#$%&"


def luhn(digits: str) -> bool:
    twice = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (twice + sum(int(d) for d in digits[-1::-2])) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, by start and kind; each kind is leftmost and non-overlapping."""
    out = []
    if "@" in text:
        free = 0
        for m in _DOMAIN.finditer(text):
            start = at = m.start()
            while start > free and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                out.append((start, 0, m.end()))
                free = m.end()
    if _MARK.search(text):
        for m in _IP.finditer(text):
            if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or "0") <= 255 for x in m.group().split(".")):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = _NOT_DIGIT.sub("", m.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                    out.append((m.start(), 3, m.end()))
    out.sort()
    return out


def shape(word: str) -> str:
    """Letters as a, digits as 9, runs as one character; at most 24 characters of it."""
    out = []
    for ch in word.strip(_EDGE):
        s = "a" if ch.isalpha() else "9" if "0" <= ch <= "9" else ch
        if not out or out[-1] != s:
            out.append(s)
            if len(out) == 24:
                break
    return "".join(out)


def features(word: str) -> tuple[list[str], str]:
    """A word's own features, and how it looks to its neighbours."""
    if not _MARK.search(word):
        return ["plain", "plain:mark" if word[-1] in ":=" else "plain:none"], "plain"
    s = shape(word)
    digits = sum("0" <= c <= "9" for c in word)
    size = str(digits) if digits < 6 else "6-8" if digits < 9 else "9-11" if digits < 12 else "12-19" if digits < 20 else "20+"
    own = ["odd", f"digits:{size}", f"shape:{s}"]
    if "@" in s[1:-1]:
        own.append("at inside, dot behind" if "." in s.split("@", 1)[1][1:-1] else "at inside")
    if word[0] == "+":
        own.append("plus in front")
    if 12 <= digits <= 19:
        own.append("sum holds" if luhn(_NOT_DIGIT.sub("", word)) else "sum fails")
    if "a" not in s:
        own += [f"no letter, digits:{size}", f"no letter, parts:{s.count('9')}"]
    else:
        own.append("letters")
    return own, f"{s if len(s) < 8 else 'long'}/{size if digits < 6 else 'many'}"


class Field:
    """Weights by feature (a row of label scores each) and by pair of labels."""

    def __init__(self, weights: dict[str, np.ndarray], pairs: np.ndarray) -> None:
        self.weights, self.pairs = weights, pairs
        self.zero = np.zeros(len(LABELS))
        self.known: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def parts(self, word: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What a word adds to its own scores, to those of the word after it and of the word before it."""
        got = self.known.get(word)
        if got is None:
            if len(self.known) > 20_000:
                self.known.clear()
            own, seen = features(word)
            get = lambda f: self.weights.get(f, self.zero)
            got = self.known[word] = (sum(map(get, own), self.zero), get(f"before:{seen}"), get(f"after:{seen}"))
        return got

    def margin(self) -> float:
        """By how much O beats the other labels at plain words among plain words, less what pairs can give back."""
        get = lambda f: self.weights.get(f, self.zero)
        around = get("plain") + get("before:plain") + get("after:plain")
        rows = [around + get(f) + e for f in ("plain:none", "plain:mark") for e in self._edges()]
        lead = min(row[0] - row[1:].max() for row in rows)
        p = self.pairs
        gain = max(
            p[a, y] + p[y, b] - p[a, 0] - p[0, b]
            for a in range(len(LABELS)) for b in range(len(LABELS)) for y in range(1, len(LABELS))
        )
        return lead - gain

    def _edges(self) -> list[np.ndarray]:
        """A line's first and last word lack a neighbour."""
        before, after = self.weights.get("before:plain", self.zero), self.weights.get("after:plain", self.zero)
        return [self.zero, -before, -after, -before - after]

    def emissions(self, words: list[str]) -> np.ndarray:
        parts = [self.parts(w) for w in words]
        out = np.array([p[0] for p in parts])
        if len(words) > 1:
            out[1:] += [p[1] for p in parts[:-1]]
            out[:-1] += [p[2] for p in parts[1:]]
        return out

    def viterbi(self, scores: np.ndarray) -> np.ndarray:
        """Best labels of a batch of sequences of equal length (batch, words, labels), each between two O."""
        n, length, _ = scores.shape
        best = scores[:, 0] + self.pairs[0]
        back = np.zeros((length, n, len(LABELS)), np.int8)
        for t in range(1, length):
            ways = best[:, :, None] + self.pairs[None]
            back[t] = ways.argmax(1)
            best = ways.max(1) + scores[:, t]
        path = np.zeros((n, length), np.int8)
        path[:, -1] = (best + self.pairs[:, 0]).argmax(1)
        for t in range(length - 1, 0, -1):
            path[:, t - 1] = back[t][np.arange(n), path[:, t]]
        return path


def labelled_words(line: str) -> tuple[list[str], list[int]]:
    """Words and labels of one line of `LABELLED`; marks behind a closing bracket belong to its last word."""
    words, labels, label = [], [], 0
    for part in line.split(" "):
        if part.startswith("[") and part[1:] in KINDS:
            label = LABELS.index(part[1:])
            continue
        words.append(part.replace("]", "", 1) if label else part)
        labels.append(label)
        if "]" in part:
            label = 0
    return words, labels


def train(lines: tuple[str, ...] = LABELLED, steps: int = 150, rate: float = 0.15, shrink: float = 0.02) -> Field:
    """Maximises the log-likelihood less an L2 term by Adam with exact gradients."""
    k = len(LABELS)
    data, index = [], {"plain": 0}
    for line in lines:
        words, labels = labelled_words(line)
        looks = [features(w) for w in words]
        rows = []
        for i, (own, _) in enumerate(looks):
            names = list(own)
            if i:
                names.append(f"before:{looks[i - 1][1]}")
            if i + 1 < len(looks):
                names.append(f"after:{looks[i + 1][1]}")
            rows.append([index.setdefault(f, len(index)) for f in names])
        data.append((rows, np.array(labels)))
    params = np.zeros(len(index) * k + k * k)
    fixed = np.zeros((len(index), k))
    fixed[0, 0] = PLAIN_LEAD
    mean, square = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, steps + 1):
        w, pairs = params[: len(index) * k].reshape(-1, k), params[len(index) * k :].reshape(k, k)
        gw, gp = np.zeros_like(w), np.zeros_like(pairs)
        for rows, labels in data:
            score = np.array([w[r].sum(0) + fixed[r].sum(0) for r in rows])
            n = len(rows)
            alpha, beta = np.zeros((n, k)), np.zeros((n, k))
            alpha[0] = score[0] + pairs[0]
            for t in range(1, n):
                alpha[t] = np.logaddexp.reduce(alpha[t - 1][:, None] + pairs, 0) + score[t]
            beta[-1] = pairs[:, 0]
            for t in range(n - 2, -1, -1):
                beta[t] = np.logaddexp.reduce(pairs + score[t + 1] + beta[t + 1], 1)
            total = np.logaddexp.reduce(alpha[-1] + beta[-1])
            p = np.exp(alpha + beta - total)
            p[np.arange(n), labels] -= 1
            for r, row in zip(rows, p, strict=True):
                gw[r] += row
            gp[0] += p[0]
            gp[:, 0] += p[-1]
            for t in range(1, n):
                gp += np.exp(alpha[t - 1][:, None] + pairs + score[t] + beta[t] - total)
                gp[labels[t - 1], labels[t]] -= 1
        grad = np.concatenate([gw.ravel(), gp.ravel()]) / len(data) + shrink / len(data) * params
        mean = 0.9 * mean + 0.1 * grad
        square = 0.999 * square + 0.001 * grad**2
        params -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    w, pairs = params[: len(index) * k].reshape(-1, k), params[len(index) * k :].reshape(k, k)
    return Field({f: w[i] + fixed[i] for f, i in index.items()}, pairs)


@lru_cache(maxsize=1)
def trained() -> Field:
    """The field fitted on LABELLED; small and the same everywhere, so each worker process fits its own."""
    return train()


def stretches(text: str, cut: bool) -> Iterator[list[tuple[int, int]]]:
    """Places of the words to decode together: two words around each word with a digit or an @; with `cut` off, lines.

    The outermost word of a stretch has plain neighbours only (or ends its line), so that O is certain there.
    """
    done = 0
    for mark in _MARK.finditer(text) if cut else re.finditer(r"[^\n]+", text):
        if mark.start() < done:
            continue
        at = text.rfind("\n", 0, mark.start()) + 1
        end = text.find("\n", mark.start())
        done = len(text) if end < 0 else end
        words = [(m.start(), m.end()) for m in _WORD.finditer(text, at, done)]
        if not cut:
            if words:
                yield words
            continue
        run: list[tuple[int, int]] = []
        until = -1  # words up to here are in the run
        for i, (a, b) in enumerate(words):
            if _MARK.search(text, a, b):
                if i - 2 > until + 1 and run:
                    yield run
                    run = []
                run += words[max(until + 1, i - 2, 0) : i + 3]
                until = min(i + 2, len(words) - 1)
        if run:
            yield run


def added_spans(field: Field, texts: list[str], base: list[list[tuple[int, int, int]]]) -> list[list[tuple[int, int, int]]]:
    """Spans that the field finds beside the base ones, in each text."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    by_length: dict[int, list[tuple[int, list[tuple[int, int]], np.ndarray]]] = {}
    cut = field.margin() > 0

    def decode(length: int) -> None:
        batch = by_length.pop(length)
        for (at, words, _), path in zip(batch, field.viterbi(np.array([b[2] for b in batch])), strict=True):
            for (first, last), kind in _runs(path.tolist()):
                start, end = words[first][0], words[last][1]
                text = texts[at]
                while start < end and text[start] in _EDGE and text[start] != "(":
                    start += 1
                while start < end and text[end - 1] in _EDGE:
                    end -= 1
                if start < end and all(e <= start or s >= end for s, _, e in base[at]):
                    out[at].append((start, kind - 1, end))

    for at, text in enumerate(texts):
        for words in stretches(text, cut):
            shown = [text[a:b] for a, b in words]
            by_length.setdefault(len(words), []).append((at, words, field.emissions(shown)))
            if len(by_length[len(words)]) * len(words) > 50_000:
                decode(len(words))
    for length in list(by_length):
        decode(length)
    return out


def _runs(path: list[int]) -> Iterator[tuple[tuple[int, int], int]]:
    at = 0
    while at < len(path):
        end = at
        while end + 1 < len(path) and path[end + 1] == path[at]:
            end += 1
        if path[at]:
            yield (at, end), path[at]
        at = end + 1


def find(texts: list[str]) -> tuple[list[list[tuple[int, int, int]]], list[list[tuple[int, int, int]]]]:
    """Base spans and all spans of each text, each (start, kind, end) by start and kind."""
    base = [base_spans(t) for t in texts]
    more = added_spans(trained(), texts, base)
    return base, [sorted(a + b) for a, b in zip(base, more, strict=True)]


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of every whole text.

    The counts and the digest are of the base spans; `spans` lists these and the added ones. A null text counts as
    empty. Equal rows give equal rows. Other columns are not read.
    """

    def work(doc_ids: list, texts: list) -> dict:
        base, spans = find([t or "" for t in texts])
        out = {"doc_id": doc_ids, "spans": [joined(s) for s in spans]}
        for k, kind in enumerate(KINDS):
            out[f"n_{kind}"] = [sum(s[1] == k for s in b) for b in base]
        out["base_sha256"] = [hashlib.sha256(joined(b).encode()).hexdigest() for b in base]
        return out

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return per_text(docs, ["doc_id", "text"], schema, work)


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span replaced by its kind in angle brackets; overlapping spans become one, of the first kind."""
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], f"<{KINDS[kind].upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def mask(docs: DataFrame, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """The documents with personal data masked and `n_chars` (where there is such a column) set to the new length.

    All rows and columns stay. A null text stays null and keeps its `n_chars`.
    """
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(at, SLICE_ROWS)
                texts = batch.column(place).to_pylist()
                _, spans = find([t or "" for t in texts])
                new = [t if t is None else masked(t, s) for t, s in zip(texts, spans, strict=True)]
                columns = list(batch.columns)
                columns[place] = pa.array(new, batch.schema.field(place).type)
                yield pa.record_batch(columns, schema=batch.schema)

    out = docs.mapInArrow(run, docs.schema)
    if n_chars in docs.columns:
        length = F.coalesce(F.length(text).cast(docs.schema[n_chars].dataType), F.col(n_chars))
        out = out.withColumn(n_chars, length)
    return out
