"""A training corpus from ``documents``: quality, near-duplicates, secrets, source mix, tokens.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage before kept; its result
is written as Parquet in the shared folder and read again as the next one's input.

Documents with a null or empty text go at the first stage; of repeated rows the second keeps one; rows
with null ids are judged like others; further columns of any name stay; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from factloom.llm import bpe, minhash, mixing, quality, secrets
from factloom.llm.common import table, written


def _quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def _near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, similarity 0.8) the smallest id stays."""
    return minhash.first_of_each(docs, shingle=5)


def _secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts."""
    return secrets.redacted(docs)


def _mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it."""
    return mixing.mixed(docs)


def _tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded texts, a row per document of the mix."""
    return bpe.digests(bpe.encode(docs))


STAGES = [
    ("quality rules", _quality),
    ("minhash near-dedup", _near_duplicates),
    ("secret scans", _secrets),
    ("mixing to weights", _mixing),
    ("bpe", _tokens),
]

#: SQL can express neither the line labels nor the tokenizer; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
