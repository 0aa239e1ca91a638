"""Operators on single texts: against brute force, exact round trips or held-out accuracy, and on odd rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from riskloom.llm import bpe, decontaminate, html_extract, langid, pii, quality
from riskloom.llm.common import hash_fold
from riskloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
BPE_PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ODD_TEXTS = [
    None, "", " ", "\n\n", "a", "ÄÖ ß é 中文 🙂", "the of and", "the of and", "x" * 50_000, "word " * 30_000, "12 ​34",
    "a\x00b", "1.2.3.4 a@b.c", "'s don't  two  spaces \t\x1c tab", "I" * 3, "İstanbul ² ½ ª",
]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd rows with columns that clash with every result's, and a repeated and a null id."""
    rows = [(i, t, "en", 1, 2.0, True, "s", [1]) for i, t in enumerate(ODD_TEXTS)]
    rows += [(3, ODD_TEXTS[3], None, None, None, None, None, None), (None, "null id", "de", 0, 0.0, False, "s", [])]
    names = "doc_id long, text string, lang string, n_tokens int, score double, held_out boolean, fp string, spans array<int>"
    return spark.createDataFrame(rows, names).repartition(3)


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is None, str(r)))


# ---- byte-level BPE


@pytest.fixture(scope="module")
def coders():
    own = bpe.coder(BPE_PATH, public_tokenizers.PATTERN)
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    return own, theirs


def test_bpe_equals_library_on_odd_and_random_texts(coders):
    own, theirs = coders
    rng = random.Random(5)
    letters = "ab \n\t\r '’sé中文🙂\x1c\x85\xa0 ²½ªº0१Ⅷ́İ_-.,|​﻿\x0b日llveAB"
    texts = [t or "" for t in ODD_TEXTS] + ["".join(rng.choices(letters, k=rng.randint(0, 14))) for _ in range(3000)]
    for text in texts:
        ids = own.encode(text)
        assert ids == theirs.encode_ordinary(text), text[:50]
        assert own.decode(ids) == text.encode()


def test_bpe_appends_and_edits_equal_a_new_encoding(coders):
    own, _ = coders
    rng = random.Random(6)
    data = b"thedition of reading"
    table = bpe.Prefixes(own, data)
    for _ in range(200):
        if rng.random() < 0.5:
            more = bytes(rng.choices(b"aeinorst ", k=3))
            data += more
            table.append(more)
        else:
            a = rng.randrange(len(data))
            b = min(len(data), a + rng.randrange(4))
            new = bytes(rng.choices(b"aeinorst ", k=2))
            data = data[:a] + new + data[b:]
            table.replace(a, b, new)
        assert table.data == data
        assert table.tokens() == bpe.Prefixes(own, data).tokens() == own.piece(data)


def test_bpe_query_digests(spark, coders):
    _, theirs = coders
    texts = {r.doc_id: r.text for r in documents(spark).collect()}
    rows = QUERIES["op2_bpe"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = theirs.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_bpe_odd_rows(odd):
    got = bpe.encode_texts(odd, BPE_PATH, public_tokenizers.PATTERN).collect()
    assert len(got) == odd.count() and all(r.round_trip for r in got)
    assert bpe.encode_texts(odd.limit(0), BPE_PATH, public_tokenizers.PATTERN).count() == 0


# ---- personal data

KIND_PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def plain_spans(text):
    out = []
    for k, pattern in enumerate(KIND_PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
            fits = (
                True,
                k == 1 and all(int(x) <= 255 for x in m.group().split(".")),
                12 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0,
                9 <= len(digits) <= 15,
            )[k]
            if fits:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_pii_base_equals_plain_patterns(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choices("a@.b@.c-+ 1 2 345 .9.()é\n", k=rng.randint(0, 40))) for _ in range(20_000)]
    texts += [r.text for r in documents(spark).collect()]
    for text in texts:
        assert pii.base_spans(text) == plain_spans(text), text[:200]


def test_field_learns_its_table_and_whole_lines_change_nothing(spark, monkeypatch):
    field = pii.trained()
    assert field.margin() > 0
    for line in pii.LABELLED:
        words, labels = pii.labelled_words(line)
        assert field.viterbi(field.emissions(words)[None])[0].tolist() == labels
    texts = [r.text for r in documents(spark).collect()]
    base = [pii.base_spans(t) for t in texts]
    cut = [sorted(s) for s in pii.added_spans(field, texts, base)]
    monkeypatch.setattr(pii.Field, "margin", lambda self: -1.0)
    assert cut == [sorted(s) for s in pii.added_spans(field, texts, base)]


def test_labelled_numbers_are_not_those_of_the_documents(spark):
    numbers = set(re.findall("[0-9]{16}", " ".join(pii.LABELLED))) - {"4111111111111111"}
    texts = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    assert not [n for n in sorted(numbers) if not texts.filter(texts.text.contains(n)).isEmpty()]


def test_viterbi_equals_all_paths():
    field, rng = pii.trained(), np.random.default_rng(1)
    k = len(pii.LABELS)
    for _ in range(20):
        scores = rng.normal(size=(1, 4, k)) * 3
        paths = np.stack(np.meshgrid(*[range(k)] * 4, indexing="ij"), -1).reshape(-1, 4)
        total = scores[0, range(4), paths].sum(1) + field.pairs[0, paths[:, 0]] + field.pairs[paths[:, -1], 0]
        total += field.pairs[paths[:, :-1], paths[:, 1:]].sum(1)
        assert field.viterbi(scores)[0].tolist() == paths[total.argmax()].tolist()


def test_pii_adds_what_the_patterns_miss():
    text = "Reach me on 212-555-0142 or ask maría.lópez@correo.example.es today."
    base, both = pii.find([text])
    assert set(base[0]) <= set(both[0])
    assert "phone" in pii.joined(both[0])


def test_pii_odd_rows_and_mask(spark, odd):
    got = pii.scan(odd).collect()
    assert len(got) == odd.count()
    assert sum(r.n_ip + r.n_email for r in got) == 2
    assert pii.scan(odd.limit(0)).count() == 0
    docs = documents(spark)
    masked = {r.doc_id: r for r in pii.mask(docs).collect()}
    assert pii.mask(docs).columns == docs.columns and len(masked) == docs.count()
    for r in docs.collect():
        assert plain_spans(masked[r.doc_id].text) == [] or plain_spans(r.text)
        assert masked[r.doc_id].n_chars == len(masked[r.doc_id].text)
        if not pii.find([r.text])[1][0]:
            assert masked[r.doc_id].text == r.text


# ---- benchmark decontamination


def plain_leaks(texts, items, size):
    split = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    out = {}
    for doc_id, text in texts:
        words, hit, owners = split(text), set(), set()
        for item_id, item in items:
            own = split(item)
            n = min(size, len(own))
            for a in range(len(own) - n + 1 if n else 0):
                for b in range(len(words) - n + 1):
                    if words[b : b + n] == own[a : a + n]:
                        hit |= set(range(b, b + n))
                        owners.add(str(item_id))
        out[doc_id] = (len(words), len(hit), len(owners), hashlib.sha256(",".join(sorted(owners)).encode()).hexdigest(), bool(hit))
    return out


@pytest.mark.parametrize("block_bytes", [2_000_000, 60])
def test_decontamination_equals_brute_force(spark, block_bytes):
    rng = random.Random(4)
    words = ["a", "B", "c", "dé", "e9", "F!"]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([0, 2, 3, 5, 8])))) for i in range(12)] + [(12, None), (3, "a b c dé")]
    texts = [(i, " ".join(rng.choices(words, k=rng.randint(0, 40)))) for i in range(60)] + [(60, None), (61, ""), (62, "?!")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in texts], "doc_id long, text string, n_words int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = plain_leaks(texts, items, 4)
    got = decontaminate.report(decontaminate.scan(docs, bench, size=4, block_bytes=block_bytes))
    assert {r.doc_id: tuple(r)[1:] for r in got.collect()} == want
    kept = decontaminate.drop_contaminated(docs, bench, size=4, block_bytes=block_bytes)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, w in want.items() if not w[-1])
    assert kept.columns == docs.columns


def test_benchmark_blocks_are_bounded_and_drop_repeats(spark):
    items = [(1, "same words here")] * 50 + [(i, f"item number {i:03d} of many") for i in range(2, 42)]
    blocks = list(decontaminate._blocks(spark.createDataFrame(items, "item_id long, text string"), 200))
    assert sorted(x for b, _ in blocks for x in b) == sorted({(str(i), t.encode()) for i, t in items})
    assert all(sum(len(t) for _, t in b) < 200 + 24 for b, _ in blocks)
    assert [last for _, last in blocks] == [False] * (len(blocks) - 1) + [True] and len(blocks) > 3


def test_decontamination_query_and_empty_tables(spark, odd):
    docs, bench = documents(spark), spark.read.parquet(f"{SF}/benchmark.parquet")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    want = plain_leaks([t for t in texts if len(t[1]) < 1500], [(r.item_id, r.text) for r in bench.collect()], 10)
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op8_decontaminate"](spark, SF).collect()}
    assert len(got) == len(texts) and all(got[i] == w for i, w in want.items())
    assert decontaminate.scan(odd, bench.limit(0)).filter("size(items) > 0").count() == 0
    assert decontaminate.scan(odd.limit(0), bench).count() == 0


# ---- language, quality


def test_language_of_held_out_texts(spark):
    truth = {r.doc_id: r.lang for r in documents(spark).collect()}
    got = QUERIES["op3_langid"](spark, SF).collect()
    assert len(got) == len(truth)
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_rank_distance_equals_plain_code():
    texts = {"en": "the cat and the dog", "de": "der hund und die katze"}

    def plain(text):
        grams = {}
        for word in re.findall("[a-z]+", text):
            padded = f"_{word}_"
            for g in [*word, *(padded[i : i + 2] for i in range(len(padded) - 1)), *(padded[i : i + 3] for i in range(len(padded) - 2))]:
                grams[g] = grams.get(g, 0) + 1
        code = lambda g: sum((1 if c == "_" else ord(c)) << 21 * (len(g) - 1 - i) for i, c in enumerate(g))
        return [code(g) for g in sorted(grams, key=lambda g: (-grams[g], code(g)))]

    rows = [(lang, c, r) for lang, t in texts.items() for r, c in enumerate(plain(t)[:30])]
    model = langid.Profiles(rows, 30)
    for text in ("the hat", "der hut und", "and"):
        top = plain(text)[:30]
        assert langid.ranked(text, 30).tolist() == top
        away = {}
        for lang, t in texts.items():
            ranks = {c: r for r, c in enumerate(plain(t)[:30])}
            away[lang] = sum(abs(ranks[c] - i) if c in ranks else 30 for i, c in enumerate(top))
        near = {k: 1 - v / (30 * len(top)) for k, v in away.items()}
        lang, score = model.predict(text)
        assert lang == min(sorted(away), key=away.get)
        assert score == pytest.approx(near[lang] / sum(near.values()))


def test_language_odd_rows(spark, odd):
    never = hash_fold("doc_id", 4, 9)
    got = {(r.doc_id, r.lang_pred) for r in langid.identify(odd, langid.fit(odd), never).collect()}
    assert (0, "und") in got and (2, "und") in got and (4, "und") not in got
    empty = langid.fit(odd.limit(0))
    assert {r.lang_pred for r in langid.identify(odd, empty, never).collect()} == {"und"}


def test_quality_of_held_out_texts(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = [r for r in QUERIES["op7_quality"](spark, sf).collect()]
    assert len(got) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    held = [(r.predicted, truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth]
    assert np.mean([p == t for p, t in held]) > 0.95


def test_discriminant_equals_plain_densities():
    rng = np.random.default_rng(2)
    size = len(quality.STATISTICS)
    x = [rng.normal(size=(200, size)) @ rng.normal(size=(size, size)), rng.normal(size=(300, size)) + 0.5]
    n = np.array([len(a) for a in x], float)
    model = quality.Discriminant(n, np.array([a.sum(0) for a in x]), np.array([a.T @ a for a in x]))
    covs = [np.cov(a.T, bias=True) for a in x]
    pooled = sum(c * k for c, k in zip(covs, n, strict=True)) / n.sum()
    d = np.sqrt(np.diag(pooled))
    rows, logs = rng.normal(size=(20, size)), []
    for a, c in zip(x, covs, strict=True):
        mixed = (1 - quality.TO_POOLED) * c / np.outer(d, d) + quality.TO_POOLED * pooled / np.outer(d, d)
        mixed = (1 - quality.TO_UNIT) * mixed + quality.TO_UNIT * np.trace(mixed) / size * np.eye(size)
        away = rows / d - a.mean(0) / d
        logs.append(-0.5 * (np.einsum("ij,jk,ik->i", away, np.linalg.inv(mixed), away) + np.linalg.slogdet(mixed)[1]))
    lead = logs[1] - logs[0] + np.log(n[1] / n[0])
    assert model.scores(rows) == pytest.approx(1 / (1 + np.exp(-lead)), abs=1e-9)


def test_quality_odd_rows(spark, odd):
    labels = spark.createDataFrame([(0, 1), (1, 0), (4, 1), (5, 0), (None, 1), (6, 7), (7, None)], "doc_id long, quality int")
    never = hash_fold("doc_id", 5, 9)
    assert quality.classify(odd, labels, never).count() == odd.count()
    assert {r.score for r in quality.classify(odd, labels.limit(0), never).collect()} == {0.5}
    assert quality.classify(odd.limit(0), labels, never).count() == 0
    assert quality.keep_good(odd, labels.limit(0), never).columns == odd.columns


# ---- web pages

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var x="<p>no</p>";</script></head><body>
<header><p>Site name</p></header><nav><ul><li><a href=/a>Menu</a></li></ul></nav><div class="ad">Buy now.</div>
%s<div class="cookie-notice">We use cookies</div><aside>Side</aside><form>Name <input></form>
<div id="comments"><p>A reader writes a rather long comment here.</p></div><footer>&copy; me</footer></body></html>"""


def test_html_keeps_the_article_only():
    article = "<article><h1>Head</h1><p>One &amp; two<br>three\n four</p><p>B <b>bold</b>.</p><p>Ti.</p></article>"
    want = "Head\nOne & two three four\nB bold.\nTi."
    assert html_extract.extract(PAGE % article) == want
    unmarked = "<div><p>" + "A first sentence that is long enough. " * 4 + "</p><p>Short.</p><p>" + "More text follows. " * 6 + "</p></div>"
    assert html_extract.extract(PAGE % unmarked).split("\n")[1] == "Short."


def test_html_finds_the_article_of_every_page(spark):
    from html import unescape

    rows = spark.read.parquet(f"{SF}/pages.parquet").collect()
    got = {r.page_id: r.text for r in QUERIES["op1_html"](spark, SF).collect()}
    for r in rows:
        inner = re.search(r"<article>(.*?)(</article>|\Z)", r.html, re.S).group(1)
        blocks = [re.sub(r"\s+", " ", unescape(re.sub(r"<[^>]+>", "", b))).strip() for b in re.split(r"</?(?:h1|p)>", inner)]
        assert got[r.page_id] == "\n".join(b for b in blocks if b)


LONG = ["A sentence of the article that is long enough to count as text. " * 2 + str(i) for i in range(4)]
SHORT = "Note."


def test_html_misleading_articles_and_marked_pages():
    text = "".join(f"<p>{x}</p>" for x in LONG)
    want = "\n".join(x.strip() for x in LONG)
    comments = '<div id="comments"><p>Hm.</p><article class="comment-body"><p>' + "I have an opinion on this, too. " * 5 + "</p></article></div>"
    assert html_extract.extract(PAGE % f'<div class="entry-content">{text}</div>{comments}') == want
    alone = '<article class="comment-body"><p>' + "I have an opinion on this, too. " * 5 + "</p></article>"
    assert html_extract.extract(PAGE % f"<div>{text}</div>{alone}") == want
    assert html_extract.extract(PAGE % f"<div>{text}</div><article><p>{SHORT}</p></article>") == want
    assert html_extract.extract(PAGE % f"<p>{SHORT}</p><article>{text}</article><p>{SHORT}</p>") == want
    assert html_extract.extract(PAGE % f'<div class="login"><article>{text}</article></div>') == want


def test_html_blocks_of_unmarked_pages():
    head = "<div><div><h2>Head</h2></div></div>"
    rows = "<table><tbody><tr><td>1990</td></tr><tr><td>1991</td></tr></tbody></table>"
    page = f"<div><div><p>{LONG[0]}</p></div>{head}<div><div><p>{SHORT}</p></div></div>{rows}<div><p>{LONG[1]}</p></div></div>"
    want = "\n".join([LONG[0], "Head", SHORT, "1990", "1991", LONG[1]])
    assert html_extract.extract(PAGE % page) == want
    assert html_extract.extract(f"<html><body><form>{page}</form></body></html>") == want
    assert html_extract.extract(f"<body><form class='login'>{page}<svg>no</svg></form></body>") == want


@pytest.mark.parametrize("html", [None, "", "plain", "<", "<p", "<p>a<!-- b", "</p></p>", '<a "' * 5000, "<nav>x", "<script>x", "&#0;&#xFFFFFFF;"])
def test_html_odd_pages(html):
    text = html_extract.extract(html)
    assert isinstance(text, str)
    assert text == ("plain" if html == "plain" else text)
