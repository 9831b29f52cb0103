"""A corpus pipeline: toxicity, near and substring duplicates, benchmark
leaks, then packing. Each stage works on all rows that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import table
from gridloom.llm.decontaminate import decontaminate
from gridloom.llm.near_copies import drop_similar
from gridloom.llm.packing import pack_documents
from gridloom.llm.queries import tokenizer_path
from gridloom.llm.substring_dedup import rewrite_documents
from gridloom.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of documents with similar five-word shingles (0.8 or
    more) the document with the smallest id stays."""
    return drop_similar(docs)


def substring_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words under repeated windows go; a document left without words goes."""
    return rewrite_documents(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    numbered = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    found = decontaminate(numbered, table(spark, sf_dir, "benchmark"), text=f"c{docs.columns.index('text')}")
    return found.where(~F.col("contaminated")).select(*numbered.columns).toDF(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all documents' pieces in sequences of 2048 tokens."""
    return pack_documents(docs, tokenizer_path())


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("substring_duplicates", substring_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Weak supervision and packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridloom.llm.common import written

    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
