"""A training corpus in five stages over ``documents``, from quality rules to packed sequences.

Every stage takes ``(spark, docs, sf_dir)`` and returns a table, which is written and
read again as the next one's ``docs``. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartdex.llm.line_dedup import dedup_lines
from chartdex.llm.mixing import mix_documents, repeat_documents
from chartdex.llm.near_dedup import drop_near_duplicates
from chartdex.llm.packing import pack_documents
from chartdex.llm.quality import passes, quality_ledger
from chartdex.llm.shared import Workspace

POLICY = "v1"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every rule of the policy."""
    return quality_ledger(docs).where(passes(POLICY)).select("doc.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that at least ten of them share; ``n_chars`` follows the text."""
    changed = F.col("n_dropped") > 0
    text = F.when(changed, F.col("kept_text")).otherwise(F.col("doc.text"))
    length = F.when(changed, F.length("kept_text")).otherwise(F.col("doc.n_chars"))
    new = {"text": text, "n_chars": length.cast(docs.schema["n_chars"].dataType)}
    return dedup_lines(docs, min_docs=10).select(*[new.get(c, F.col("doc")[c]).alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near-duplicates: five words, similarity 0.8."""
    return drop_near_duplicates(docs, shingle=5, percent=80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents as often as they are taken, up to three times."""
    return repeat_documents(docs, mix_documents(docs, weights=(1, 2, 3), max_repeat=3, share=1.0))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their place in a training sequence."""
    return pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

#: No SQL: near-duplicate groups, hashed samples and packing are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    work = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = work.cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
