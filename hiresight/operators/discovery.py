"""Board discovery over tables of URLs, domains and probe results.

HTTP is not performed here: probing is an input table ``(url, status)``
(what a crawler landed), so discovery is joins and aggregates that scale
with the number of seeds and probes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..dictionaries import PROBE_CONFIDENCE, URL_PATTERN_CONFIDENCE
from ..functions import boards as bd

DISCOVERED = ["company_name", "company_domain", "careers_url", "ats_type",
              "discovery_method", "discovered_at", "confidence"]


def with_board(df: DataFrame, url: Column) -> DataFrame:
    """``df`` and the board's ``ats_type`` and ``identifier`` of a URL, read once
    per row: a generator's output cannot be copied into filters."""
    def board(u: Column) -> Column:
        ats = bd.detect_ats(u)
        return F.struct(ats.alias("ats_type"), bd.board_identifier(u, ats).alias("identifier"))

    return df.select("*", F.inline(F.transform(F.array(url), board)))


def discover_from_urls(urls: DataFrame, url_col: str = "url") -> DataFrame:
    """Board URLs recognised by pattern: ATS type, identifier, a display
    name from the identifier; unrecognised URLs yield no row."""
    u = F.col(url_col)
    return (with_board(urls, u)
            .where(F.col("ats_type").isNotNull())
            .select("*",
                    bd.name_from_token("identifier").alias("company_name"),
                    F.lit(None).cast("string").alias("company_domain"),
                    u.alias("careers_url"),
                    F.lit("url_pattern").alias("discovery_method"),
                    F.current_timestamp().alias("discovered_at"),
                    F.lit(URL_PATTERN_CONFIDENCE).alias("confidence")))


def domain_seeds(boards: DataFrame) -> DataFrame:
    """Distinct (domain, company_name) seeds."""
    return boards.select("domain", "company_name").distinct()


def board_root(url_col: str = "url"):
    """``scheme://host/first-segment`` of a URL (the board a probe hits)."""
    return F.regexp_extract(F.col(url_col), r"^(https?://[^/?#]+/[^/?#]+)", 1)


def probe_results(boards: DataFrame) -> DataFrame:
    """Probe outcome per board root URL: 200 when any landed page under that
    root answered 200, else the lowest status."""
    roots = boards.select(board_root().alias("url"), "probe_status").where(F.col("url") != "")
    return roots.groupBy("url").agg(F.when(F.max(F.col("probe_status") == 200), 200).otherwise(F.min("probe_status")).alias("status"))


def candidate_urls(seeds: DataFrame) -> DataFrame:
    """The five probe URLs of each seed with their probe order ``pos``."""
    return seeds.select("domain", "company_name",
                        F.posexplode(bd.candidate_urls("domain", "company_name")).alias("pos", "url"))


def first_board_hit(seeds: DataFrame, probes: DataFrame) -> DataFrame:
    """Per seed, the first candidate (probe order) that answered 200 and is
    a recognisable board URL. Joins candidates to probes (both large), then
    keeps the first hit per seed with one map-side-combined aggregate (the rows
    are narrow)."""
    cands = candidate_urls(seeds)
    ok = probes.where(F.col("status") == 200).select("url")
    hits = (cands.join(ok, "url", "left_semi")
            .where(bd.detect_ats("url").isNotNull()))
    winners = hits.groupBy("domain", "company_name").agg(F.min_by("url", "pos").alias("url"))
    return winners.select(
        "domain", "company_name",
        F.col("url").alias("careers_url"),
        bd.detect_ats("url").alias("ats_type"),
        bd.board_identifier("url").alias("identifier"),
        F.lit("subdomain_probe").alias("discovery_method"),
        F.current_timestamp().alias("discovered_at"),
        F.lit(PROBE_CONFIDENCE).alias("confidence"),
    )


def posting_boards(postings: DataFrame, url_col: str = "job_url") -> DataFrame:
    """(ats_type, identifier) of every board with at least one posting."""
    return (with_board(postings.select(url_col), F.col(url_col)).select("ats_type", "identifier")
            .where(F.col("identifier").isNotNull()).distinct())


def verify_boards(discovered: DataFrame, postings: DataFrame, url_col: str = "job_url") -> DataFrame:
    """Keep discovered boards that have at least one posting (semi join on
    ATS type and board identifier)."""
    return discovered.join(posting_boards(postings, url_col), ["ats_type", "identifier"], "left_semi")


def discovered_companies(by_probe: DataFrame, by_url: DataFrame) -> DataFrame:
    """The discovery output table (7 columns): probe hits (company and
    domain from the seed) followed by URL-pattern hits."""
    probe = by_probe.select(F.col("company_name"), bd.clean_domain("domain").alias("company_domain"),
                            *[c for c in DISCOVERED[2:]])
    return probe.unionByName(by_url.select(*DISCOVERED))
