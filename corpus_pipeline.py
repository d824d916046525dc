"""The corpus pipeline: STAGES over ``documents``, each written as Parquet and
read again as the next one's input. Run as the registered query ``pipeline``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hiresight.llm import decontaminate, jaccard_join, mixing, sharding, toxicity
from hiresight.llm.tables import checkpointed, table


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under one half (operator 5)."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (operator 10)."""
    return jaccard_join.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those that benchmark passages contaminate (operator 7)."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that good and poor text reach their target shares
    (operator 8). No rate is under 1: every document stays at least once."""
    labelled = mixing.label_domains(table(spark, sf_dir, "labels"))
    return mixing.mix(docs, labelled, {"good": 0.90, "poor": 0.10}, low=1.0)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the shard each belongs to (operator 1)."""
    return sharding.place(docs, sharding.Tree.even(24))


STAGES = [
    ("toxicity", toxicity_filter),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

#: The stages learn models from the data; SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Between stages the documents are cut off by a
    checkpoint in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, checkpointed(docs) if k else docs, sf_dir)
    return docs
