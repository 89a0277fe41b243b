"""A corpus from raw documents to packed sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it
kept.  All but the last return the columns of ``documents``; ``run`` writes each
stage's rows to the shared folder and reads them again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathloom.llm.base import step, table, with_row_key
from pathloom.llm.decontaminate import clean_documents
from pathloom.llm.near_dedup import near_duplicates
from pathloom.llm.packing import pack_documents
from pathloom.llm.personal_data import find_personal_data
from pathloom.llm.quality_rules import quality_report

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_report(docs.select(*COLUMNS).withColumn("_body", F.col("text")), text="_body").where("kept").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, the one with the least id.  Every row is
    a document of its own, whether it has an id or shares one."""
    rows = with_row_key(docs.select(*COLUMNS), "_key")
    kept = near_duplicates(rows, doc_id="_key").where("kept").select(F.col("doc_id").alias("_key"))
    return rows.join(kept, "_key", "left_semi").select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return clean_documents(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by the name of its kind."""
    found = find_personal_data(docs.select(*COLUMNS), keep=["doc_id", "lang", "source"])
    return found.select("doc_id", F.col("redacted").alias("text"), "lang", "source", F.length("redacted").cast("bigint").alias("n_chars"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the sequences that hold all documents, with their token ids."""
    return pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: SQL can't express the tokeniser rules or the boosted trees; the tests compare the
#: stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = step(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
