"""Operators on whole tables: near-duplicates, language model, secrets, pipeline."""

import random
import zlib
from collections import Counter
from math import log10

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from riskloom.llm import components, jaccard, lm, secrets, simhash, vectors
from riskloom.llm.common import hash_fold
from riskloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def classes_of(nodes, edges):
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in edges:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


# ---- components


@pytest.mark.parametrize("kind", ["path", "star", "random", "none"])
def test_components_equal_union_find(spark, kind):
    rng = random.Random(kind)
    order = rng.sample(range(1000), 200)
    edges = {
        "path": list(zip(order, order[1:], strict=False)), "star": [(order[0], x) for x in order],
        "random": [(rng.randrange(150), rng.randrange(150)) for _ in range(110)], "none": [],
    }[kind]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    real = [(a, b) for a, b in edges if a != b]
    assert got == classes_of({x for e in real for x in e}, real)


# ---- SimHash


def plain_fingerprint(text):
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


@pytest.mark.parametrize(("bits", "radius"), [(64, 3), (64, 1), (32, 3), (10, 3)])
def test_masks_leave_out_any_few_bits_together(bits, radius):
    rng = random.Random(1)
    masks = simhash.covering_masks(list(range(bits)), radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    for _ in range(3000):
        some = rng.sample(range(bits), radius)
        assert any(not any(m >> b & 1 for b in some) for m in masks)


def test_simhash_query_equals_all_pairs(spark):
    texts = {r.doc_id: r.text for r in documents(spark).collect()}
    fps = {i: plain_fingerprint(t) for i, t in texts.items()}
    ids = sorted(fps)
    near = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if (fps[a] ^ fps[b]).bit_count() <= 3]
    want = classes_of(ids, near)
    got = QUERIES["op6_simhash"](spark, SF).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {i: (f"{fps[i]:016x}", want[i]) for i in ids}


@pytest.mark.parametrize("large", [2000, 3])
def test_links_miss_no_pair_in_dense_groups(spark, large):
    rng = random.Random(2)
    centre = rng.getrandbits(64)
    fps = {centre}
    while len(fps) < 300:
        fps.add(rng.choice(sorted(fps)) ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4))))
    fps |= {rng.getrandbits(64) for _ in range(300)}
    ids = dict(enumerate(sorted(fps)))
    signed = [(f - (1 << 64) if f >> 63 else f, i) for i, f in ids.items()]
    edges = simhash.links(spark.createDataFrame(signed, "fp long, id long").repartition(4), large=large).collect()
    near = [(a, b) for a in ids for b in ids if a < b and (ids[a] ^ ids[b]).bit_count() <= 3]
    assert {frozenset(e) for e in edges} <= {frozenset(p) for p in near}
    assert classes_of(ids, [tuple(e) for e in edges]) == classes_of(ids, near)


def test_simhash_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(40_000))
    rows = [(5, None, 1), (3, "", 2), (9, " \n", 3), (7, "One two", 4), (8, "one TWO", 5), (8, "one TWO", 5), (None, "one two", 6), (1, long, 7), (2, long, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    got = sorted((r.doc_id or -1, r.component_id) for r in simhash.near_duplicates(docs).collect())
    assert got == [(-1, 7), (1, 1), (2, 1), (3, 3), (5, 3), (7, 7), (8, 7), (8, 7), (9, 3)]
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 1, 3, 7]
    assert simhash.fingerprint(long.encode()) == plain_fingerprint(long).to_bytes(8, "big")
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


# ---- vectors


def clusters(rng, size=64):
    rows = []
    for _ in range(40):
        centre = rng.normal(size=size)
        rows += [centre + rng.normal(size=size) * rng.choice([0.02, 0.2, 0.3]) for _ in range(rng.integers(1, 30))]
    rows += [rng.normal(size=size) for _ in range(600)]
    return [r.astype(np.float32) for r in rows]


@pytest.mark.parametrize("block_rows", [1500, 7])
def test_vector_links_against_all_pairs(spark, block_rows):
    rng = np.random.default_rng(3)
    x = clusters(rng)
    x += [x[0], x[0], x[5] * 2]
    rows = [(i * 3 + 1, [float(v) for v in e], i) for i, e in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, n_links int")
    got = {r.vec_id: r for r in vectors.near_duplicates(df, block_rows=block_rows).collect()}
    unit = np.array(x, float)
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    linked = unit @ unit.T >= 0.9
    np.fill_diagonal(linked, False)
    n = linked.sum(1)
    mine = np.array([got[i * 3 + 1].n_links for i in range(len(x))])
    assert (mine <= n).all() and mine.sum() >= 0.9 * n.sum()
    want = classes_of([i * 3 + 1 for i in range(len(x))], [(a * 3 + 1, b * 3 + 1) for a, b in zip(*np.nonzero(linked), strict=True)])
    assert np.mean([got[i].component_id == c for i, c in want.items()]) > 0.97
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_vector_recall_just_above_the_threshold(spark):
    """Planted partners at cosines of 0.90 to 0.93 among vectors without links."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(9000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    other = rng.normal(size=(3000, 64))
    other -= (other * x[:3000]).sum(1)[:, None] * x[:3000]
    other /= np.linalg.norm(other, axis=1)[:, None]
    cosine = rng.uniform(0.9001, 0.93, 3000)[:, None]
    x = np.concatenate((x, cosine * x[:3000] + np.sqrt(1 - cosine**2) * other)).astype(np.float32)
    rows = [(i, [float(v) for v in e]) for i, e in enumerate(x)]
    got = vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    n = sum(int((unit[at : at + 1000] @ unit.T >= 0.9).sum()) for at in range(0, len(x), 1000)) - len(x)
    assert n >= 6000
    assert 0.98 * n <= sum(r.n_links for r in got) <= n


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0, 0.0]), (8, [1.0, 0.0]), (None, [1.0, 0.0])]
    rows += [(9, [1e30, 0.0]), (10, [1.0, 0.0, 0.0]), (11, [1e-30, 1e-31])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted((r.vec_id or -1, r.n_links, r.component_id, r.kept) for r in vectors.near_duplicates(df).collect())
    alone = [(i, 0, i, True) for i in (1, 2, 3, 4, 5, 6, 10)]
    assert got == sorted([(-1, 0, None, False), (7, 3, 7, True), (8, 3, 7, False), (9, 3, 7, False), (11, 3, 7, False), *alone])
    assert vectors.near_duplicates(df.limit(0)).count() == 0


# ---- language model


def test_model_counts_and_base_score_equal_brute_force(spark):
    texts = {r.doc_id: r.text for r in documents(spark).collect()}
    tokens = {i: [*(w for w in lm.tokens_of(t.encode()))] for i, t in texts.items()}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in texts}
    counts = Counter(w for i, own in tokens.items() if not held[i] for w in own)
    n, v = sum(counts.values()), len(counts)
    rows = QUERIES["op4_lm"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        own = tokens[r.doc_id]
        base = sum(log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(own), sum(counts[w] > 0 for w in own), n)
        assert r.base_score == pytest.approx(base, rel=1e-9)
    fresh = [r for r in rows if r.held_out]
    assert sum(r.score for r in fresh) > sum(r.base_score for r in fresh)


def test_predictive_probabilities_sum_to_one(spark):
    docs = documents(spark).selectExpr("doc_id", "cast(text as binary) text", "true train")
    layout = lm._layout(docs)
    counts = docs.mapInArrow(lm._deal(layout), lm._SCHEMA).groupBy("part").applyInArrow(lm._merge(layout.parts), lm._SCHEMA)
    parts = lm.stored(counts).filter(f"part < {layout.parts}")
    corpus, history = lm.fit(parts, layout)
    total, unseen_tables = Counter(), Counter()
    seen_parent, words = 0.0, set()
    for row in parts.collect():
        part = lm.Part(row.asDict(), layout.hot)
        *_, (tables, parent, totals, _) = part.chain(corpus, history)
        hashed = lm._unpack(row.words, np.uint64)
        for h, p in zip(hashed.tolist(), parent, strict=True):
            if h not in words:
                words.add(h)
                seen_parent += p
        for u, c, t in zip(part.contexts, part.counts, tables, strict=True):
            assert 0 <= t <= c and (t > 0) == (c > 0)
            total[u] += c - lm.DISCOUNT * t
            unseen_tables[u] += t
    unknown = lm._new_in_parent(corpus, history[-1].parent_tables) / (lm.PARENT_STRENGTH + history[-1].customers)
    assert seen_parent + unknown == pytest.approx(1)
    for u in list(total)[:50]:
        assert unseen_tables[u] == history[-1].tables[u]
        mass = total[u] + lm.STRENGTH + lm.DISCOUNT * history[-1].tables[u]
        assert mass / (lm.STRENGTH + corpus.contexts[u]) == pytest.approx(1)


def test_seating_follows_the_exact_distribution():
    rng = np.random.default_rng(4)
    drawn = lm.seat(np.full(40_000, 5), np.full(40_000, 0.7), lm.DISCOUNT, rng)
    chance = np.exp(lm._LOG_S[lm.DISCOUNT][5, 1:6]) * 0.7 ** np.arange(1, 6)
    assert np.bincount(drawn, minlength=6)[1:] / 40_000 == pytest.approx(chance / chance.sum(), abs=0.012)
    many = lm.seat(np.full(200, 5000), np.full(200, 3.0), lm.DISCOUNT, rng)
    assert (many >= 1).all() and (many <= 5000).all()


def test_model_odd_rows(spark):
    rows = [(1, None, 1), (2, "", 1), (3, "a " * 30_000, 1), (4, "A a é\x00", 1), (4, "A a é\x00", 1), (None, "b", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int").repartition(2)
    never = hash_fold("doc_id", 5, 9)
    got = {(r.doc_id, r.n_tokens, r.n_known) for r in lm.score(docs, never).collect()}
    assert got == {(1, 1, 1), (2, 1, 1), (3, 30_001, 30_001), (4, 4, 4), (None, 2, 2)}
    assert lm.score(docs, never).count() == 6
    assert {r.n_known for r in lm.score(docs, ~never).collect()} == {0}
    assert all(np.isfinite(r.score) for r in lm.score(docs, ~never).collect())
    assert lm.score(docs.limit(0), never).count() == 0


def test_model_scores_do_not_follow_the_partitions(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    held = hash_fold("doc_id", 5, 1)
    first = {r.doc_id: (r.score, r.base_score) for r in lm.score(docs.repartition(1), held).collect()}
    monkeypatch.setattr(lm, "COUNTED_WORDS", 500)  # counts are sent in many pieces
    for n in (4, 40):
        again = {r.doc_id: (r.score, r.base_score) for r in lm.score(docs.repartition(n), held).collect()}
        assert again.keys() == first.keys()
        assert all(again[i] == pytest.approx(first[i], rel=1e-5) for i in first)


def test_model_counts_words_exactly(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").selectExpr("doc_id", "cast(text as binary) text")
    docs = docs.withColumn("train", ~hash_fold("doc_id", 5, 1)).repartition(7)
    got = {r.word: r.n for r in lm.word_counts(docs).filter("is_word").collect()}
    want = Counter(w for r in docs.filter("train").collect() for w in lm.tokens_of(r.text)[:-1])
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    assert got == {signed(xxhash.xxh64_intdigest(w)): n for w, n in want.items()}


# ---- secrets


@pytest.mark.parametrize("fold", range(4))
def test_forest_on_unseen_templates(spark, fold):
    findings = secrets.labelled_findings(spark)
    unseen = f"crc32(concat(before, after)) % 4 = {fold}"
    scored = secrets.fit(findings.filter(f"not {unseen}")).transform(secrets.featured(findings.filter(unseen)))
    scored = scored.selectExpr("label", "cast(prediction as int) p").collect()
    assert len(scored) > 900 and np.mean([r.label == r.p for r in scored]) > 0.88


#: Text, and what of it is a secret.
SECRETS = (
    ('password = "hunter2024"', ["hunter2024"]),
    ("secret_key=correcthorsebatterystaple", ["correcthorsebatterystaple"]),
    ("ghp_abcdefghijklmnopqrstuvwxyzABCDEFGHIJ", ["ghp_abcdefghijklmnopqrstuvwxyzABCDEFGHIJ"]),
    ("use ghp_abcdefghijklmnopqrstuvwxyzABCDEFGHIJ.", ["ghp_abcdefghijklmnopqrstuvwxyzABCDEFGHIJ"]),
    ("pwd: s3cr3t!pass#word$99", ["s3cr3t!pass#word$99"]),
    ('note: "our token = "0123456789abcdef0123456789abcdef01234567" x', ["0123456789abcdef0123456789abcdef01234567"]),
    ("see https://joe:pa55w0rd@host/x", ["pa55w0rd"]),
    ("two: password='aB3!x y z9' and api_key: qwhzkdmxvbnrtypsfglj\n", ["aB3!x y z9", "qwhzkdmxvbnrtypsfglj"]),
    ("author: Smith wrote about a token of thanks, width: 300px", []),
    ("password: ${DB_PASSWORD}\ntoken=null", []),
    ("commit 0123456789abcdef0123456789abcdef01234567 at src/app/model/view2.py", []),
)


def test_secrets_of_any_length_and_alphabet(spark):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(SECRETS)], "doc_id long, text string")
    got = secrets.scan(docs, secrets.labelled_findings(spark)).filter("secret").collect()
    want = {(i, t.index(v), t.index(v) + len(v)) for i, (t, values) in enumerate(SECRETS) for v in values}
    assert {(r.doc_id, r.start, r.end) for r in got} == want


def test_secrets_of_the_documents(spark):
    import re

    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op10_secrets"](spark, sf).collect()
    pattern = re.compile(secrets.CANDIDATE, re.ASCII)
    spans = [(i, m.end(1) if m[1] else m.start(), m.end()) for i, t in texts.items() for m in pattern.finditer(t)]
    assert sorted((r.doc_id, r.start, r.end) for r in got) == sorted(spans)
    found = {(r.doc_id, r.start) for r in got if r.secret}
    planted = {(i, m.start(1)) for i, t in texts.items() for m in re.finditer('(?i:token) = "([0-9a-fA-F]{40})"', t)}
    assert planted and planted <= found
    assert len(found - planted) <= 0.1 * len(planted)


def test_secrets_odd_rows_stay_in_the_jvm(spark):
    value = "a1b2c3d4e5f6a7b8c9d0"
    rows = [(1, None, 1.0), (2, "", 1.0), (3, f"🙂 token={value} {value}", 1.0), (3, f"🙂 token={value} {value}", 1.0), (4, f"x {value}\n" * 3000, 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    out = secrets.scan(docs, secrets.labelled_findings(spark))
    got = out.collect()
    assert len(got) == 4 + 3000
    assert sorted(r.start for r in got if r.doc_id == 4) == [2 + 23 * i for i in range(3000)]
    assert sorted((r.start, r.end - r.start) for r in got if r.doc_id == 3) == [(2, 26), (2, 26), (29, 20), (29, 20)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
    assert secrets.scan(docs.limit(0), secrets.labelled_findings(spark)).count() == 0


# ---- pipeline


def test_pipeline_equals_its_parts_by_brute_force(spark):
    from test_text_operators import BPE_PATH, plain_leaks

    import public_tokenizers
    from riskloom.llm import bpe, pii

    docs = documents(spark)
    rows = {r.doc_id: r for r in docs.collect()}
    good = {r.doc_id for r in QUERIES["op7_quality"](spark, SF).collect() if r.predicted == 1}
    ids = sorted(good)
    first = [i for i, c in classes_of(ids, plain_near({i: plain_shingles(rows[i].text) for i in ids})).items() if i == c]
    leaks = {r.doc_id for r in QUERIES["op8_decontaminate"](spark, SF).collect() if r.contaminated}
    own = bpe.coder(BPE_PATH, public_tokenizers.PATTERN)
    want = {}
    for i in first:
        if i not in leaks:
            text = rows[i].text
            want[i] = own.encode(pii.masked(text, pii.find([text])[1][0]))
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id: r.ids for r in got} == want and len(got) == len(want)
    assert all(r.round_trip for r in got)
    assert plain_leaks  # the brute force behind the leaks is compared in its own test


def test_stages_return_the_columns_of_documents(spark):
    docs = documents(spark)
    assert len(corpus_pipeline.STAGES) == 5
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in docs.schema]
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0


def plain_shingles(text):
    words = (text or "").encode().lower().split()
    runs = [words[i : i + 5] for i in range(len(words) - 4)] if len(words) >= 5 else [words] if words else []
    return {b" ".join(r) for r in runs}


def plain_near(sets):
    """All pairs with a Jaccard similarity of 0.8 or more."""
    near, ids = [], sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            least, most = sorted((len(sets[a]), len(sets[b])))
            if least >= 0.8 * most and (both := len(sets[a] & sets[b])) >= 0.8 * (least + most - both):
                near.append((a, b))
    return near


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_near_duplicate_stage_equals_all_pairs_by_five_word_jaccard(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    sets = {r.doc_id: plain_shingles(r.text) for r in docs.collect()}
    near = plain_near(sets)
    want = {i for i, c in classes_of(sorted(sets), near).items() if i == c}
    got = [r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert any(sets[a] != sets[b] for a, b in near)


def test_near_duplicate_stage_of_chains_and_odd_rows(spark):
    rng = random.Random(3)
    base = [f"w{rng.randrange(10**6)}" for _ in range(200)]
    chain = [base[6 * i :] + [f"x{k}" for k in range(6 * i)] for i in range(8)]  # neighbours only are near
    rows = [(10 + i, " ".join(w)) for i, w in enumerate(chain)]
    rows += [(30, ""), (31, None), (32, "one two"), (33, "ONE  two"), (34, "two one"), (40, "a b c d e f"), (40, "a b c d e f")]
    rows += [(None, "one two"), (None, None)]
    got = jaccard.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0) for r in got) == [0, 0, 10, 30, 32, 34, 40]


def test_near_duplicate_stage_draws_candidates_by_fingerprints(spark, monkeypatch):
    rows = [(10, 0), (11, 0b111), (12, 0b111111), (13, 0b111111), (14, (1 << 40) - 1)]
    near = jaccard._fingerprint_pairs(spark.createDataFrame(rows, "node long, fp long"))
    assert {(r.node, r.component) for r in components.components(near).collect()} == {(n, 10) for n in (10, 11, 12, 13)}

    class Reached(Exception):
        pass

    def reached(found):
        raise Reached

    monkeypatch.setattr(simhash, "links", reached)
    with pytest.raises(Reached):
        jaccard.keep_one(spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e g")], "doc_id long, text string"))
