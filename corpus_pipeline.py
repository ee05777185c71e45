"""A corpus pipeline: toxicity, line and near deduplication, decontamination, then token ids.

Each stage takes (spark, docs, sf_dir) and works on all documents that the one before kept; all but
the last return the columns of ``documents``. Between stages documents are written and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickloom.llm import decontamination, line_dedup, simhash_dedup, toxicity, transducer_bpe
from tickloom.llm.common import materialised, remove_path, table


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted to the labelled among them, rejects go."""
    return toxicity.reject_toxic(docs, toxicity.learn_open(docs, table(spark, sf_dir, "labels")))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share stay in one of them."""
    return line_dedup.dedup_documents(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash_dedup.near_dedup(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark items cover beyond the limit go; others are left as they are."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token_ids, n_tokens and digests of the ids and of the text that they decode to."""
    return transducer_bpe.encode_with_digests(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("line_dedup", without_repeated_lines),
    ("simhash_dedup", without_near_copies),
    ("decontamination", without_benchmark),
    ("bpe", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what a stage has written goes when the next one has."""
    docs, path = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        before = path
        docs, path = materialised(stage(spark, docs, sf_dir), name)
        if before is not None:
            remove_path(spark, before)
    return STAGES[-1][1](spark, docs, sf_dir)


#: A learnt classifier, fingerprints and a tokenizer have no SQL form.
ORACLE_SQL = None
