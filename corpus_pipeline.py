"""A corpus pipeline: toxicity, near-duplicates, decontamination, secrets, mix.

Null and empty texts are documents like others (they are near-duplicates of each other).  Of rows that repeat, with one
doc_id or several, the near-duplicate stage keeps one.  Rows without doc_id are judged by their texts as others are.
An empty table gives no rows at any stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.llm.cluster import new_path, remove
from graphloom.llm.decontamination import decontaminated
from graphloom.llm.mixing import taken_documents
from graphloom.llm.secrets import redacted
from graphloom.llm.simhash import without_near_duplicates
from graphloom.llm.toxicity import without_toxic


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't predicted toxic."""
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, one row: that with the smallest doc_id, one without doc_id only if all are."""
    return without_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret replaced by a mark; n_chars follows the new text."""
    out = redacted(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in out.columns else out


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents that it takes, texts and all, with the words taken and the virtual finish time of the first copy."""
    return taken_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("secret scans", redact_secrets),
    ("mixing", mix),
]

# Toxicity, SimHash and weighted-shingle stages can't be written in SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each result written as Parquet in the shared folder and read again.

    A stage's table is deleted when the next one is written; the last stays.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for i, (_, stage) in enumerate(STAGES):
        path = new_path(spark, f"pipeline-{i}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove(spark, before)
        before = path
    return docs
