"""Corpus pipeline: toxicity filter, SimHash near-duplicate removal, mixing
of sources to target weights, best-fit packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run``
writes it as Parquet and hands the copy read back to the next stage. Every stage
reads whole texts of any length, takes null as an empty text, passes null ids and other columns
(of any name) through, and gives no rows for an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from linkgap.llm.common import stored
from linkgap.llm.mixing import mixed_documents
from linkgap.llm.packing import pack_documents
from linkgap.llm.queries import tokenizer_path
from linkgap.llm.simhash import drop_near_duplicates
from linkgap.llm.toxicity import keep_clean


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject: score below 0.5 (0.5 itself is rejected). Rows that repeat share
    a score and stay or go together; documents without words stay."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return keep_clean(spark, docs, labels)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates: the smallest id, of rows that share it one. Null and empty
    texts are one group; a group of null ids alone keeps one row."""
    return drop_near_duplicates(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or cut so that the sources reach their targets. A null source is a source; order is by a hash
    of id and text, so ties are rows that repeat wholly and are interchangeable; documents without words
    come once per epoch of their source."""
    return mixed_documents(docs)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the mixed documents with their sequence and place. An empty text is one piece, the end id;
    pieces of equal length are interchangeable and ranked by a hash of their id."""
    return pack_documents(docs, tokenizer_path())


STAGES = [("toxicity", toxicity_stage), ("SimHash near-dedup", dedup_stage), ("mixing", mix_stage),
          ("packing", pack_stage)]

#: Fingerprints, the fitted classifier and the tokenizer have no SQL form; tests/llm holds the brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
