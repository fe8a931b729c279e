"""The corpus pipeline: stages over ``documents``, each stored as Parquet before the next.

Every stage works on all rows that its predecessor kept. All but the last return the columns of
``documents``; the last adds the token ids of each text and their number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.llm import bpe, common, decontaminate, langid, minhash, sanitise


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; rejected ones go."""
    return langid.drop_rejected(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return minhash.drop_near_copies(docs)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of the benchmark."""
    return decontaminate.drop_leaking(docs, common.read_table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data and revealing terms replaced in their texts."""
    return sanitise.sanitised(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their token ids."""
    ids, number = common.free_name(docs, "token_ids", "n_tokens")
    return bpe.encode(docs, ids=ids).withColumn(number, F.size(ids))


STAGES = [
    ("language identification", language),
    ("MinHash near-dedup", near_copies),
    ("benchmark decontamination", leaks),
    ("personal data", personal_data),
    ("BPE encoding", tokens),
]

#: Models, signatures and merges cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs, before = common.read_table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        docs = common.checkpointed(stage(spark, docs, sf_dir))
        if before is not None:
            common.discard(before)
        before = docs
    return docs
