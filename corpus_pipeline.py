"""From documents to shards: rules, near copies, leaks, mixing, sharding.

Each stage works on all that the one before it kept, reads it from Parquet, and returns a
DataFrame; all but the last return the columns of documents. Rows without any case of their own
below behave as the operators' docstrings say; an empty table passes through all stages as one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paneflow.llm.common import table
from paneflow.llm.decontaminate import clean_documents
from paneflow.llm.mixing import mixed_documents
from paneflow.llm.near_dup import one_of_each
from paneflow.llm.quality import kept_documents
from paneflow.llm.sharding import sharded_documents
from paneflow.session import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, with lines cut out that very many documents of their host share."""
    return kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not hold an item of the benchmark."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's rate has it, in shuffled order."""
    return mixed_documents(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and slot."""
    return sharded_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", shards),
]

#: The second stage cannot be told in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
