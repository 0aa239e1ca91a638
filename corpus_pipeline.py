"""A corpus from raw documents to token ids: quality, near-duplicates, benchmark leaks, personal data, tokens.

Each stage takes all that its predecessor kept. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from riskloom.llm import bpe, decontaminate, jaccard, pii, quality
from riskloom.llm.common import hash_fold, stored, table
from riskloom.llm.queries import BPE_FILE


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold; learned from labelled ones outside the held-out fold."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"), hash_fold("doc_id", 5, 0))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each class of near-duplicates: five-word shingles, similarity of 0.8."""
    return jaccard.keep_one(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind, n_chars set to the new length."""
    return pii.mask(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and whether the ids give back the text, for all documents."""
    return bpe.encode_texts(docs, public_tokenizers.path(BPE_FILE), public_tokenizers.PATTERN)


STAGES = [
    ("quality classifier", quality_filter),
    ("near-duplicates", near_duplicates),
    ("benchmark decontamination", benchmark_leaks),
    ("PII", personal_data),
    ("byte-level BPE", tokens),
]

#: SQL expresses neither the classifier nor the random field.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result but the last is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
