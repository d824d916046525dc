"""End-to-end plans: raw postings -> canonical -> deduplicated -> enriched.

These are the compositions a user runs; each returns a lazy DataFrame, so
Catalyst sees (and prunes) the whole chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import clean_text
from ..operators.canonical import canonicalize, rejects, valid_jobs
from ..operators.dedupe import keep_first
from ..operators.enrich import enrich
from ..schemas import CANONICAL_COLUMNS
from ..sources import testdata


def jobs_from_canonical(canon: DataFrame, with_order: bool = False) -> DataFrame:
    """Valid canonical rows (bodies not cleaned yet) -> first posting per
    ``(run_date, job_key)`` in landing order -> cleaned and enriched jobs.

    Rejects are dropped before any shuffle. The dedupe aggregate holds keys
    and landing order only; the wide rows then semi-join the winners. The
    heavy per-row work (HTML cleaning, ~300 dictionary scans) runs on the
    survivors.
    """
    first = keep_first(valid_jobs(canon), ["run_date", "job_key"], [F.col("file_path"), F.col("pos")])
    out = enrich(first.withColumn("description", clean_text("description")), cleaned=True)
    return out.select(*CANONICAL_COLUMNS, *(["file_path", "pos"] if with_order else []))


def build_jobs(raw: DataFrame, strict_us: bool = True, with_order: bool = False) -> DataFrame:
    """The ``build`` stage for every run present in ``raw``. Filters on
    enrichment columns can be pushed back into the scoring projection; the
    output is meant to be written (``store.write_jobs``) before reports read it.
    """
    return jobs_from_canonical(canonicalize(raw, strict_us, clean_description=False), with_order)


def build_rejects(raw: DataFrame, strict_us: bool = True) -> DataFrame:
    return rejects(canonicalize(raw, strict_us, clean_description=False))


def jobs_history(spark: SparkSession, sf_dir: str, with_order: bool = False, partitions: int | None = None) -> DataFrame:
    """Job history over the generated test tables (adapter P), all runs."""
    return build_jobs(testdata.raw_postings(spark, sf_dir, partitions), with_order=with_order)


def canonical(spark: SparkSession, sf_dir: str, strict_us: bool = True) -> DataFrame:
    """Canonical rows + reasons from the test tables."""
    return canonicalize(testdata.raw_postings(spark, sf_dir), strict_us)
