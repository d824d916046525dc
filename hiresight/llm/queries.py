"""The registered queries of this package (``oracles`` has the SQL of those that
SQL can express). Each query applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import decontaminate, divergence, html, jaccard_join, language_model, licenses, line_dedup, mixing, periodic_runs, pii, repetition, sharding, toxicity
from .oracles import LLM_ORACLES
from .tables import table

__all__ = ["LLM_ORACLES", "LLM_QUERIES"]


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"), sharding.Tree.even(24))


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op3_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.repetition_rules(table(spark, sf_dir, "documents"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.fit(docs))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op6_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model, rare = language_model.fit(docs)
    return language_model.score(docs, model, rare)


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = mixing.label_domains(table(spark, sf_dir, "labels"))
    return mixing.rate_documents(table(spark, sf_dir, "documents"), labelled, {"good": 0.80, "poor": 0.15, "toxic": 0.05})


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = licenses.document_paths(table(spark, sf_dir, "documents"))
    return licenses.inherit(licenses.scan(files, licenses.fit(files)))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digests(periodic_runs.periodic_runs(periodic_runs.plant_periods(table(spark, sf_dir, "documents"))))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs, min_docs=10)).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


LLM_QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_html": op2_html,
    "op3_repetition": op3_repetition,
    "op4_pii": op4_pii,
    "op5_toxicity": op5_toxicity,
    "op6_language_model": op6_language_model,
    "op7_decontaminate": op7_decontaminate,
    "op8_mixing": op8_mixing,
    "op9_licenses": op9_licenses,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_divergence": op11_divergence,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_line_dedup": op13_line_dedup,
}
