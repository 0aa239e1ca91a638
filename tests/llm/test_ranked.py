"""Ranked search: brute force on odd tables, the plan of shared sums, blocks."""

import random
import re
from collections import Counter
from math import floor, log

import pytest
from riskloom.llm import ranked

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def plain_terms(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", low)


def plain_search(docs, items, top=10):
    counts = [(i, Counter(plain_terms(t))) for i, t in docs]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    if not counts:
        return []
    n_docs, n_terms = len(counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    w = {t: floor(1000 * log((2 * n_docs + 2) / (2 * k + 1))) for t, k in df.items()}
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(plain_terms(t))
    out = []
    for item, terms in asked.items():
        found = []
        for i, c, n in counts:
            m = 100 - 90 + (90 * n * n_docs) // n_terms
            score = sum(w[t] * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms if t in c)
            if score > 0:
                found.append((-score, i is not None, i or 0))
        out += [(item, k + 1, i if known else None, -s) for k, (s, known, i) in enumerate(sorted(found)[:top])]
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("pairs", [None, 8])
def test_equals_brute_force_with_odd_rows(spark, monkeypatch, pairs):
    if pairs:
        monkeypatch.setattr(ranked, "BLOCK_PAIRS", pairs)
        monkeypatch.setattr(ranked, "CELLS", 40)
    rng = random.Random(5)
    words = ["the", "of", "A", "Ünï", "x9", "ÀB", "naïve", "日本", "k", "zz", "Q", "1"]
    docs = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 30)))) for i in range(300)]
    docs += [(i, "the of copy") for i in range(1000, 1400)]  # ties, by id
    docs += [(5, docs[5][1]), (5, "the zz zz"), (None, "the k k k"), (2000, None), (2001, ""), (2002, "!? \x7f"), (2003, "zz " * 20000)]
    items = [(i, " ".join(rng.sample(words, rng.randrange(1, 9)))) for i in range(25)]
    items += [(100, None), (101, ""), (102, "-- nowhere"), (103, "the the THE"), (1, "k zz"), (None, "naïve copy"), (104, items[3][1])]
    a, b = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    want = plain_search(docs, items)
    assert rows_of(ranked.search(a.repartition(5), b)) == want
    clash = a.selectExpr("*", "1 AS n", "2 AS terms", "3 AS tf", "4 AS item_id", "5 AS score")
    assert rows_of(ranked.search(clash, b.selectExpr("*", "1 AS term", "2 AS w", "3 AS block"))) == want
    assert ranked.search(a.limit(0), b).count() == 0 and ranked.search(a, b.limit(0)).count() == 0
    assert ranked.search(spark.createDataFrame([(1, None)], DOCS), b).count() == 0


def test_a_word_in_every_document_has_no_negative_weight(spark):
    docs = [(i, "all") for i in range(50)]
    assert rows_of(ranked.search(spark.createDataFrame(docs, DOCS), spark.createDataFrame([(1, "all")], ITEMS))) == plain_search(docs, [(1, "all")])


def test_plan_adds_up_to_each_item_and_shares_work():
    rng = random.Random(2)
    common = [rng.sample(range(60), 12) for _ in range(4)]
    items = [set(rng.choice(common)) | set(rng.sample(range(60), 6)) for _ in range(40)]
    sets = [frozenset(i for i, own in enumerate(items) if t in own) for t in range(60)]
    sets = list(dict.fromkeys(s for s in sets if s))
    adds, outputs = ranked.mine(sets)
    below = [{k} for k in range(len(sets))]
    for a, b in adds:
        assert not below[a] & below[b]
        below.append(below[a] | below[b])
    for i, nodes in enumerate(outputs):
        parts = [below[n] for n in nodes]
        assert sorted(x for p in parts for x in p) == [k for k, s in enumerate(sets) if i in s]
    alone = sum(len(s) for s in sets)
    assert len(adds) + sum(len(o) for o in outputs) < 0.8 * alone
    assert ranked.mine([]) == ([], [])
