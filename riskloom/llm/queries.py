"""The queries opN_<name> of this subpackage, with their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from riskloom.llm import (
    align, bpe, decontaminate, html_extract, langid, lm, pii, quality, ranked, secrets, simhash, vectors, warc,
)
from riskloom.llm.common import hash_fold, table

BPE_FILE = "byte_bpe_multi_50k.tiktoken"
ALIGN_FILES = "byte_bpe_50k.json", "piece_bpe_32k.model"


def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe.digest_texts(docs, public_tokenizers.path(BPE_FILE), public_tokenizers.PATTERN)


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = hash_fold("doc_id", 4, 2)
    return langid.identify(docs, langid.fit(docs.filter(~held_out)), held_out)


def op4_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"), hash_fold("doc_id", 5, 1))


def op5_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.classify(docs, labels, hash_fold("doc_id", 5, 0))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.report(decontaminate.scan(docs, benchmark))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scan(table(spark, sf_dir, "documents"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"), secrets.labelled_findings(spark))


def op11_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return align.alignment(docs, *map(public_tokenizers.path, ALIGN_FILES))[0]


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages")).drop("url")


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_html, op2_bpe, op3_langid, op4_lm, op5_vectors, op6_simhash, op7_quality, op8_decontaminate, op9_pii, op10_secrets,
              op11_align, op12_warc, op13_search)
}

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

_TERMS = f"regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

ORACLES: dict[str, str] = {
    # every document against every item, term by term
    "op13_search": f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS words FROM documents WHERE text IS NOT NULL),
        tot AS (SELECT count(*) AS nd, CAST(sum(len(words)) AS BIGINT) AS l FROM d WHERE len(words) > 0),
        tf AS (SELECT r, doc_id, n, t, count(*) AS tf
               FROM (SELECT r, doc_id, CAST(len(words) AS BIGINT) AS n, unnest(words) AS t FROM d) GROUP BY ALL),
        df AS (SELECT t, CAST(floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
               FROM tf, tot GROUP BY t, nd),
        q AS (SELECT DISTINCT item_id, t FROM (SELECT item_id, unnest({_TERMS}) AS t FROM benchmark)),
        s AS (SELECT item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nd) // l)))) AS BIGINT) AS score
              FROM q JOIN df USING (t) JOIN tf USING (t), tot GROUP BY item_id, r, doc_id),
        k AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank,
              doc_id, score FROM s WHERE score > 0)
        SELECT * FROM k WHERE rank <= 10""",
    # digests over whole payloads; a window over equal ones
    "op12_warc": """
        WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages),
        h AS (SELECT *, max(page_id) OVER (PARTITION BY d) AS head FROM p)
        SELECT page_id, n AS payload_bytes, d AS payload_digest,
          CASE WHEN n >= 1000 AND page_id < head THEN 'revisit' ELSE 'response' END AS record_type,
          CASE WHEN n >= 1000 AND page_id < head THEN head END AS refers_to FROM h""",
    # every vector against every other
    "op5_vectors": """
        WITH RECURSIVE v AS (
          SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
          WHERE len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
            AND len([x FOR x IN embedding IF x <> 0]) > 0),
        p AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b
              ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
        r AS (SELECT vec_id AS x, vec_id AS y FROM embeddings UNION SELECT r.x, p.y FROM r JOIN p ON p.x = r.y),
        c AS (SELECT x, min(y) AS component_id FROM r GROUP BY x),
        n AS (SELECT x, count(*) AS n_links FROM p GROUP BY x)
        SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
        FROM embeddings JOIN c ON c.x = vec_id LEFT JOIN n ON n.x = vec_id""",
    # every run of words of every document against every window
    "op8_decontaminate": f"""
        WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        b AS (SELECT item_id, w, least(10, len(w)) AS n FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
        b1 AS (SELECT item_id, w, n, unnest(range(1, CAST(len(w) - n + 2 AS BIGINT))) AS i FROM b),
        windows AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win FROM b1),
        d1 AS (SELECT doc_id, w, n, unnest(range(1, CAST(greatest(len(w) - n + 2, 1) AS BIGINT))) AS i
               FROM d, (SELECT DISTINCT n FROM windows)),
        runs AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS win FROM d1),
        hits AS (SELECT doc_id, i, n, item_id FROM runs JOIN windows USING (n, win)),
        words AS (SELECT doc_id, count(DISTINCT p) AS n_hit
                  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
        items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
                  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
          sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
}
