"""The corpus pipeline: quality, line dedup, near-duplicates, decontamination, mixing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stellate.llm import leaks, lines, mix, near, quality
from stellate.llm.shared import row_key, stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the policy rejects go."""
    return quality.filter_quality(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in many documents stay only where they occur first."""
    return lines.drop_lines(docs, keep_first=True)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, at a similarity of 0.8 or more."""
    return near.drop_copies(docs, 80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return leaks.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, whole, with their words and how often each is taken.

    A document without words is not taken, and no two others have an id and a text in common here.
    """
    taken = mix.mixed_documents(docs).where("repeats > 0").withColumnsRenamed({"doc_id": "__id", "row": "__row"})
    own = [c for c in taken.columns if c not in docs.columns and not c.startswith("__")]
    same = docs["doc_id"].eqNullSafe(taken["__id"]) & (row_key(docs["text"]) == taken["__row"])
    return docs.join(taken, same).select(*(docs[c] for c in docs.columns), *(taken[c] for c in own))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over all documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs


#: Similarity of signatures, edit distances and a seeded mix have no SQL; tested by brute force.
ORACLE_SQL = None
