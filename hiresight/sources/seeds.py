"""Seed inputs: company list CSV, discovery seeds YAML, dictionaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import boards as bd
from ..schemas import COMPANY_SEED


def read_company_seeds(spark: SparkSession, path: str) -> DataFrame:
    """``company_name, careers_url, ats_type, is_portfolio, notes``;
    ``is_portfolio`` is true only for the text ``true`` (any case)."""
    df = spark.read.schema(COMPANY_SEED).option("header", True).csv(path)
    return df.withColumn("is_portfolio", F.coalesce(F.lower(F.col("is_portfolio")) == "true", F.lit(False)))


def first_n(seeds: DataFrame, n: int | None) -> DataFrame:
    """The first ``n`` companies in file order (``0``/``None``: all). File
    order is the read order of a single CSV file."""
    if not n:
        return seeds
    return seeds.withColumn("__i", F.monotonically_increasing_id()).orderBy("__i").limit(n).drop("__i")


def seed_identifiers(seeds: DataFrame) -> DataFrame:
    """Board identifier per seed, or the reason it cannot be taken from the
    careers URL (bad or missing URL, unknown ATS type)."""
    return seeds.select(
        "*",
        bd.board_identifier("careers_url", "ats_type").alias("identifier"),
        bd.identifier_error("careers_url", "ats_type").alias("error"),
    )


DISCOVERY_DOMAIN = T.StructType([T.StructField("domain", T.StringType()), T.StructField("company_name", T.StringType())])


def read_discovery_seeds(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(domains(domain, company_name), known_urls(url)) from the discovery
    YAML. The file is a small configuration document read on the driver."""
    import yaml

    with open(path, encoding="utf-8") as f:
        data = yaml.safe_load(f) or {}
    domains = [(d.get("domain"), d.get("company_name")) for d in data.get("domains", []) or []]
    urls = [(u,) for u in data.get("known_careers_urls", []) or []]
    return (spark.createDataFrame(domains, DISCOVERY_DOMAIN),
            spark.createDataFrame(urls, "url string"))
