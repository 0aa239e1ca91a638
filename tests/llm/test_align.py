"""Tokenizer alignment: everything by brute force, odd rows, bitmaps, hot pairs."""

import hashlib
import json
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from riskloom.llm import align
from riskloom.llm.queries import QUERIES
from tokenizers import Tokenizer

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string"


def plain_tokens():
    own = Tokenizer.from_file(A_PATH)
    own.encode_special_tokens = True
    vocab = json.load(open(A_PATH, encoding="utf-8"))["model"]["vocab"]
    spare = iter(range(256, 512))
    letter = {chr(b) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174 else chr(next(spare)): b for b in range(256)}
    names = {i: e for e, i in vocab.items()}
    pieces = sentencepiece.SentencePieceProcessor(model_file=B_PATH)

    def a_of(text):
        return [(i, bytes(letter[c] for c in names[i])) for i in own.encode(" " + text, add_special_tokens=False).ids]

    def b_of(text):
        out = []
        for i in pieces.encode(text):
            p = pieces.id_to_piece(i)
            raw = bytes.fromhex(p[3:5]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()
            out.append((i, raw))
        return out

    return a_of, b_of


def plain_alignment(rows):
    a_of, b_of = plain_tokens()
    found, held, linked = [], defaultdict(set), Counter()
    for k, (doc, text) in enumerate(rows):
        a, b = (a_of(text), b_of(text)) if text else ([], [])
        want = b" " + (text or "").encode()
        if not text or b"".join(x for _, x in a) != want or b"".join(x for _, x in b) != want:
            found.append((doc, 0, 0, 0, [], ""))
            continue
        spans = []
        for tokens in (a, b):
            at, own = 0, []
            for i, raw in tokens:
                own.append((i, at, at + len(raw)))
                at += len(raw)
            spans.append(own)
        links = []
        j0 = 0
        for i, s, e in spans[0]:
            while spans[1][j0][2] <= s:
                j0 += 1
            j = j0
            while j < len(spans[1]) and spans[1][j][1] < e:
                links.append((i, spans[1][j][0]))
                j += 1
        shared = sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]})
        groups, low = [], 0
        cut_a, cut_b = iter(spans[0]), iter(spans[1])
        for high in shared:
            side = []
            for it in (cut_a, cut_b):
                own = []
                for i, _, e in it:
                    own.append(str(i))
                    if e == high:
                        break
                side.append(",".join(own))
            groups.append("|".join(side))
            low = high
        for p in set(links):
            held[p].add(k)
        linked.update(links)
        found.append((doc, len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    count = {p: len(d) for p, d in held.items()}
    top = {}
    for (a, _), n in count.items():
        top[a] = max(n, top.get(a, 0))
    out = [
        (doc, a, b, g, len(ls), sum(count[p] == top[p[0]] for p in ls), sum(count[p] for p in ls), sha)
        for doc, a, b, g, ls, sha in found
    ]
    return sorted(out, key=str), {p: (n, linked[p], n == top[p[0]]) for p, n in count.items()}


def rows_of(df):
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def pairs_of(df):
    return {(r.a, r.b): (r.docs, r.links, r.best) for r in df.collect()}


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want, _ = plain_alignment(rows)
    assert rows_of(QUERIES["op11_align"](spark, sf)) == want


@pytest.mark.parametrize("small", [False, True])
def test_odd_rows_in_any_partitions(spark, small):
    # small: several ranges, groups of ranges and bitmaps in place of lists
    layout = align.Layout(range_bits=5, parts=3, group_bits=1) if small else align.Layout()
    texts = [None, "", " ", "  ", "\n", "a", "<|endoftext|> x", "<s></s><unk>", "▁x", "日本語 ünï 🙂", "�\x00\t", "a" * 30000, "½ ﬁ ① ㎏"]
    texts += ["the same words again and again"] * 60 + ["the the the the the"]
    rng = random.Random(4)
    texts += [" ".join(rng.choices(["the", "naïve", "Zürich", "x1", "tokenization", "…"], k=rng.randrange(1, 20))) for _ in range(40)]
    rows = [(i if i % 7 else None, t) for i, t in enumerate(texts)] + [(3, "the"), (3, "the")]
    want, want_pairs = plain_alignment(rows)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS ord", "2 AS pairs", "3 AS part", "4 AS n_a", "'x' AS best")
    for parts in (1, 5):
        got, pairs = align.alignment(df.repartition(parts), A_PATH, B_PATH, layout)
        assert rows_of(got) == want
        assert pairs_of(pairs) == want_pairs
    got, pairs = align.alignment(df.limit(0), A_PATH, B_PATH)
    assert got.count() == 0 and pairs.count() == 0
    got, _ = align.alignment(spark.createDataFrame([(1, None), (None, "")], SCHEMA), A_PATH, B_PATH)
    assert rows_of(got) == sorted([(1, 0, 0, 0, 0, 0, 0, ""), (None, 0, 0, 0, 0, 0, 0, "")], key=str)


def test_words_align_as_in_their_text():
    own = align.Aligner(align.byte_vocabulary(A_PATH), align.piece_vocabulary(B_PATH))
    assert own.cuts
    rng = random.Random(9)
    parts = ["the", " ", "  ", "\n", "\t", "\u00a0", "don't", "x's", "42", "--", "日本", "\u0301e", "é", "\x1c", "\u2028", "<s>", "ab" * 30, "🙂", "1,000.5", "\r\n", "</s>", "'"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(1, 14))) for _ in range(3000)] + [" ".join(rng.choices(parts, k=9)) for _ in range(1500)]
    for at in range(0, len(texts), 500):
        some = texts[at : at + 500]
        got = own.documents(some)
        whole = align.align(some, own.a, own.b)
        for i in range(len(some)):
            if not whole.good[i]:
                assert got["n_a"][i] == 0 and got["groups_sha256"][i] == ""
                continue
            assert tuple(got[n][i] for n in ("n_a", "n_b", "n_groups", "n_links")) == tuple(whole.facts[i])
            assert got["groups_sha256"][i] == hashlib.sha256(whole.written[i]).hexdigest()
            own_pairs = slice(whole.first[i], whole.first[i + 1])
            assert list(got["pairs"][i]) == list(whole.pairs[own_pairs]) and list(got["times"][i]) == list(whole.times[own_pairs])


def test_ranks_encode_as_the_file_does_for_every_character():
    fast, slow = align.byte_vocabulary(A_PATH), Tokenizer.from_file(A_PATH)
    slow.encode_special_tokens = True
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"{c}{c}a {c}1 b{c}" for c in every[at : at + 40]) for at in range(0, len(every), 40)]
    texts += ["it's I'LL 'd 's  \n\n x<|endoftext|>y"]
    for at in range(0, len(texts), 2000):
        some = texts[at : at + 2000]
        assert fast.encode(some) == [e.ids for e in slow.encode_batch([" " + t for t in some], add_special_tokens=False)]


def test_bitmaps_give_back_what_they_hold():
    rng, layout = np.random.default_rng(1), align.Layout()
    for n in (0, 1, 50, 3000):
        keys = rng.integers(0, 4, n) ** 6
        places = rng.integers(0, layout.size, n)
        both = np.unique(np.stack((keys, places), 1), axis=0)
        packed = align.pack(both[:, 0], both[:, 1], layout)
        k, p = align.unpack(*packed, layout)
        assert sorted(zip(k.tolist(), p.tolist())) == sorted(map(tuple, both.tolist()))
        assert packed[1].sum() == len(both) and (n < 3000 or len(packed[2]) < 2 * len(both))
