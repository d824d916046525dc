"""Registered queries: one per operator of the inventory, each a function
``(spark, sf_dir) -> DataFrame`` over the generated tables.

Output conventions shared with the SQL oracles: arrays are joined with ``|``,
doubles are rounded to 6 decimals, every computed column is aliased.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import boards as bd
from ..functions import keys, location, text
from ..operators import dedupe, discovery, enrich, facts, metrics, sketches, trends
from ..operators import canonical as canon_ops
from ..operators.canonical import rejects, valid_jobs
from ..sources import testdata
from ..sources.registry import shared_drafts, source_drafts
from . import pipeline

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


REPORTS: dict[str, Callable[[DataFrame], DataFrame]] = {}


def report(fn: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """A report over the job history, registered as a query that builds the
    history from the tables (``REPORTS`` has it for a stored history)."""
    REPORTS[fn.__name__] = fn
    QUERIES[fn.__name__] = lambda spark, sf: fn(pipeline.jobs_history(spark, sf))
    return fn


def r6(c: Column | str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def joined(c: str) -> Column:
    return F.array_join(F.col(c), "|").alias(c)


def _jobs(spark, sf):
    return pipeline.jobs_history(spark, sf)


def _seeds(spark, sf):
    """Company seeds derived from the postings: one row per company with
    its portfolio flag."""
    return testdata.postings(spark, sf).select("company_name", "is_portfolio").distinct()


# ---------------------------------------------------------------- text (T1-T4)

@query
def clean_text_pages(spark, sf):
    pages = testdata.read_table(spark, sf, "pages")
    return pages.select("page_id", text.clean_text("html").alias("clean"))


@query
def clean_text_lower_pages(spark, sf):
    pages = testdata.read_table(spark, sf, "pages")
    return pages.select("page_id", text.clean_text("html", lowercase=True).alias("clean"))


@query
def normalize_whitespace_docs(spark, sf):
    docs = testdata.read_table(spark, sf, "documents")
    return docs.select("doc_id", text.normalize_whitespace("text").alias("normalized"))


@query
def keyword_counts(spark, sf):
    docs = testdata.read_table(spark, sf, "documents")
    kw = docs.select(F.explode(text.extract_keywords("text", 3)).alias("keyword"))
    return kw.groupBy("keyword").agg(F.count(F.lit(1)).alias("n"))


@query
def state_abbrev(spark, sf):
    docs = testdata.read_table(spark, sf, "documents")
    return docs.select("doc_id", text.extract_state_abbrev("text").alias("state_abbrev"))


# ------------------------------------------------------------ location (L1-L5)

def _loc_rows(spark, sf):
    return testdata.postings(spark, sf).select("pos", "location_raw")


@query
def is_remote(spark, sf):
    return _loc_rows(spark, sf).select("pos", location.is_remote("location_raw").alias("is_remote"))


@query
def state_code(spark, sf):
    return _loc_rows(spark, sf).select("pos", location.extract_state_code("location_raw").alias("state_code"))


@query
def city(spark, sf):
    p = _loc_rows(spark, sf).withColumn("st", location.extract_state_code("location_raw"))
    return p.select("pos", location.extract_city("location_raw", "st").alias("city"))


@query
def postal_code(spark, sf):
    return _loc_rows(spark, sf).select("pos", location.extract_postal_code("location_raw").alias("postal_code"))


def _parsed(spark, sf, strict):
    p = location.with_location(_loc_rows(spark, sf), "location_raw", strict)
    return p.select("pos", "city", "state", "postal_code", "is_remote", "is_us", r6("confidence").alias("confidence"))


@query
def parse_location_strict(spark, sf):
    return _parsed(spark, sf, True)


@query
def parse_location_lenient(spark, sf):
    return _parsed(spark, sf, False)


@query
def validate_us(spark, sf):
    strict = location.with_location(_loc_rows(spark, sf), "location_raw", True, prefix="s_")
    both = location.with_location(strict, "location_raw", False, prefix="l_")
    return both.select(
        "pos",
        location.valid_us("s_is_us", "s_confidence", True).alias("valid_strict"),
        location.valid_us("l_is_us", "l_confidence", False).alias("valid_lenient"),
    )


# L1-L5 and H1 over whole texts of every language

def _texts(spark, sf):
    return testdata.read_table(spark, sf, "documents").select("doc_id", "text")


@query
def is_remote_docs(spark, sf):
    return _texts(spark, sf).select("doc_id", location.is_remote("text").alias("is_remote"))


@query
def state_code_docs(spark, sf):
    return _texts(spark, sf).select("doc_id", location.extract_state_code("text").alias("state_code"))


@query
def postal_code_docs(spark, sf):
    return _texts(spark, sf).select("doc_id", location.extract_postal_code("text").alias("postal_code"))


@query
def parse_location_docs(spark, sf):
    p = location.with_location(_texts(spark, sf), "text", True)
    return p.select("doc_id", "city", "state", "postal_code", "is_remote", "is_us", r6("confidence").alias("confidence"))


@query
def text_hashes(spark, sf):
    docs = testdata.read_table(spark, sf, "documents")
    return docs.select("doc_id", keys.generate_hash("text").alias("text_hash"), keys.generate_hash("source", "lang", "text").alias("row_hash"))


# ----------------------------------------------------------- keys (H1-H3)

@query
def job_keys(spark, sf):
    p = testdata.postings(spark, sf)
    return p.select(
        "pos",
        keys.generate_job_key("source", "company_name", "source_job_id", "title").alias("job_key"),
        keys.generate_company_id("company_name").alias("company_id"),
        keys.generate_hash("source", "source_job_id", "title").alias("posting_hash"),
    )


@query
def company_ids(spark, sf):
    p = testdata.postings(spark, sf).select("company_name").distinct()
    return p.select("company_name", keys.generate_company_id("company_name").alias("company_id"),
                    keys.generate_company_id("company_name", F.lit("example.com")).alias("company_id_with_domain"))


# ------------------------------------------------- canonical / filters (P, F)

CANONICAL_OUT = ["pos", "source", "source_job_id", "job_url", "company_name", "company_id", "title",
                 "description", "department", "employment_type", "location_raw", "city", "state",
                 "postal_code", "is_remote", "country", "date_posted", "run_date", "job_key"]


@query
def canonical_jobs(spark, sf):
    return valid_jobs(pipeline.canonical(spark, sf)).select(*CANONICAL_OUT)


@query
def canonical_with_third_source(spark, sf):
    """P3 with a source that the library does not know, registered by the caller."""
    known = shared_drafts(testdata.raw_postings(spark, sf))
    third = source_drafts(testdata.workday_like_postings(spark, sf), testdata.WORKDAY_LIKE)
    return valid_jobs(canon_ops.canonical_rows(known.unionByName(third))).select(*CANONICAL_OUT)


@query
def us_filter_valid(spark, sf):
    c = valid_jobs(pipeline.canonical(spark, sf))
    return c.select("pos", "job_key", "state", "city", "is_remote")


@query
def us_filter_lenient(spark, sf):
    c = valid_jobs(pipeline.canonical(spark, sf, strict_us=False))
    return c.select("pos", "job_key", "state", "city", "is_remote")


@query
def us_rejects(spark, sf):
    return rejects(pipeline.canonical(spark, sf), "pos")


@query
def reject_counts(spark, sf):
    c = pipeline.canonical(spark, sf)
    return c.groupBy("run_date", "source").agg(
        F.count_if(F.col("reason").isNull()).alias("valid_jobs"),
        F.count_if(F.col("reason").isNotNull()).alias("rejected_jobs"),
    )


@query
def reject_counts_by_reason(spark, sf):
    c = pipeline.canonical(spark, sf).withColumn("status", F.coalesce("reason", F.lit("valid")))
    return canon_ops.reject_counts(c, ("run_date", "source", "status"))


# ---------------------------------------------------------- enrich (E1-E7)

def _p_clean(spark, sf):
    """Every posting of a known source (rejects included) with its canonical,
    cleaned description."""
    return pipeline.canonical(spark, sf).select("pos", "title", "description", "company_name")


@query
def role_family(spark, sf):
    p = enrich.with_role_family(_p_clean(spark, sf), cleaned=True)
    return p.select("pos", "role_family")


@query
def industry_tag(spark, sf):
    p = enrich.with_industry(_p_clean(spark, sf))
    return p.select("pos", F.col("industry.industry_tag").alias("industry_tag"),
                    r6("industry.confidence").alias("confidence"))


@query
def skills(spark, sf):
    p = enrich.with_skills(_p_clean(spark, sf), enrich.cleaned_title_and_body("title", "description"), cleaned=True)
    return p.select("pos", F.array_join("skills", "|").alias("skills"))


@report
def enrichment_coverage(jobs):
    return enrich.enrichment_coverage(jobs, ["run_date"])


# ------------------------------------------------------- dedupe (D1, D2, W1, J)

@query
def dedupe_first(spark, sf):
    v = valid_jobs(pipeline.canonical(spark, sf))
    return dedupe.deduplicate_jobs(v).select("job_key", "pos", "run_date")


@query
def duplicates_removed(spark, sf):
    v = valid_jobs(pipeline.canonical(spark, sf))
    return dedupe.duplicates_removed(v)


@query
def latest_snapshot(spark, sf):
    hist = pipeline.jobs_history(spark, sf, with_order=True)
    snap = dedupe.latest_per_key(hist, ["job_key"], ["run_date"], [F.col("source"), F.col("pos")])
    return snap.select("job_key", "run_date", "pos", "title", "state", joined("skills"))


def _runs(jobs):
    """The jobs of each run, in order; one row per run comes to the driver."""
    days = sorted(r["run_date"] for r in jobs.select("run_date").distinct().collect())
    return [(d, jobs.where(F.col("run_date") == F.lit(d))) for d in days]


def _first_postings(spark, sf):
    return dedupe.deduplicate_jobs(valid_jobs(pipeline.canonical(spark, sf))).select("job_key", "run_date", "source", "pos", "title", "state")


@query
def latest_snapshot_by_merges(spark, sf):
    """W1 as it is maintained: one run after the other is merged in."""
    (_, snapshot), *later = _runs(_first_postings(spark, sf))
    for _, run in later:
        snapshot = dedupe.merge_latest(snapshot, run)
    return snapshot.select("job_key", "run_date", "pos", "title", "state")


@query
def tagged_runs_by_index(spark, sf):
    """J1 and J2 as they are maintained: every run is tagged from its own rows
    and the first-seen index as of that run."""
    (_, run), *later = _runs(_first_postings(spark, sf))
    index = dedupe.run_keys(run)
    tagged = dedupe.tag_run(run, index)
    for _, run in later:
        index = dedupe.merge_first_seen(index, dedupe.run_keys(run))
        tagged = tagged.union(dedupe.tag_run(run, index))
    return tagged.select("run_date", "job_key", "first_run_date", "is_new")


@query
def first_seen_after_rebuild(spark, sf):
    """The first-seen index after the second run was rebuilt without its
    Lever postings."""
    runs = _runs(_first_postings(spark, sf))
    index = dedupe.run_keys(runs[0][1])
    for _, run in runs[1:]:
        index = dedupe.merge_first_seen(index, dedupe.run_keys(run))
    day, rebuilt = runs[1][0], runs[1][1].where("source = 'greenhouse'")
    later = _first_postings(spark, sf).where(F.col("run_date") > F.lit(day))
    return dedupe.repair_first_seen(index, rebuilt, later, day)


@query
def events_latest(spark, sf):
    ev = testdata.read_table(spark, sf, "events")
    latest = dedupe.latest_per_key(ev, ["user_id", "event_type"], ["ts", "event_id"])
    return latest.select("user_id", "event_type", "event_id", "ts", r6("value").alias("value"))


@query
def new_jobs(spark, sf):
    tagged = dedupe.new_vs_existing(_jobs(spark, sf))
    return tagged.where(F.col("is_new")).select("run_date", "job_key")


@query
def existing_jobs(spark, sf):
    tagged = dedupe.new_vs_existing(_jobs(spark, sf))
    return tagged.where(~F.col("is_new")).select("run_date", "job_key", "first_run_date")


@report
def new_vs_existing_by_run(jobs):
    return dedupe.new_vs_existing_counts(jobs)


@report
def new_vs_previous_run(jobs):
    """J1/J2 between consecutive runs: current run vs the run before."""
    keys = jobs.select("run_date", "job_key")
    cur = keys.join(trends.runs_with_previous(keys), "run_date")
    prev = keys.select(F.col("run_date").alias("prev_run_date"), "job_key", F.lit(True).alias("known"))
    flagged = cur.join(prev, ["prev_run_date", "job_key"], "left")  # (run, key) is unique on both sides
    kind = F.when(F.col("known"), "existing").otherwise("new").alias("kind")
    return flagged.groupBy("run_date", kind).agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------ metrics (A1-A9)

@report
def skills_by_role_family(jobs):
    return metrics.skills_by_role_family(jobs)


@report
def skills_by_state(jobs):
    return metrics.skills_by_state(jobs)


@report
def top_skills(jobs):
    return metrics.top_skills(jobs, 100)


@report
def skill_metric_sets(jobs):
    out = metrics.skill_grouping_sets(jobs)
    return out.select("metric", "run_date", "role_family", "state", "skill", "job_count")


@report
def role_mix_by_industry(jobs):
    return metrics.role_mix_by_industry(jobs)


@report
def summary_stats(jobs):
    return metrics.summary_stats(jobs)


@query
def ingest_stats(spark, sf):
    return metrics.ingest_stats(testdata.raw_postings(spark, sf))


@query
def ingest_outcomes(spark, sf):
    b = testdata.boards(spark, sf)
    return metrics.seed_outcomes(b, url="url", ats="ats_type")


@query
def ingest_summary(spark, sf):
    b = testdata.boards(spark, sf)
    return metrics.ingest_summary(b, valid_jobs(pipeline.canonical(spark, sf)), url="url", ats="ats_type")


@query
def summary_stats_from_facts(spark, sf):
    return metrics.summary_stats(facts.job_facts(_jobs(spark, sf)))


@query
def top_skills_from_facts(spark, sf):
    return metrics.top_skills(facts.job_facts(_jobs(spark, sf)), 100)


@query
def skill_growth_from_facts(spark, sf):
    return trends.skill_growth(facts.job_facts(_jobs(spark, sf)))


@query
def skill_family_matrix_from_facts(spark, sf):
    return trends.skill_family_matrix(facts.job_facts(_jobs(spark, sf)), 20)


@query
def distinct_over_run_ranges(spark, sf):
    """A9 over every range of runs: states from the runs' sketches (exact for so
    few values), job keys exactly and if the sketches come within their bound."""
    jobs = _first_postings(spark, sf)
    days = [str(d) for d, _ in _runs(jobs)]
    ranges = [(a, b) for i, a in enumerate(days) for b in days[i:]]
    estimated = sketches.distinct_over(sketches.run_sketches(jobs, ["job_key", "state"]), ranges)
    exact = sketches.in_ranges(jobs, ranges).groupBy("since", "until").agg(F.count_distinct("job_key").alias("exact"))
    close = F.abs(F.col("job_key") - F.col("exact")) <= 0.05 * F.col("exact")
    return estimated.join(exact, ["since", "until"]).select("since", "until", "state", F.col("exact").alias("job_key"), close.alias("close"))


# ----------------------------------------------------------- trends (W, M, J)

@report
def jobs_by_run(jobs):
    return trends.jobs_by_run(jobs)


@report
def jobs_growth(jobs):
    return trends.jobs_growth(jobs)


@report
def skill_growth(jobs):
    return trends.skill_growth(jobs)


@report
def hiring_velocity(jobs):
    return trends.hiring_velocity(jobs)


@report
def role_mix_shift(jobs):
    out = trends.role_mix_shift(jobs)
    return out.select("role_family", "run_date", r6("share").alias("share"), r6("prev_share").alias("prev_share"),
                      r6("share_change").alias("share_change"))


@report
def remote_pct(jobs):
    return trends.remote_pct(jobs).select("run_date", r6("remote_pct").alias("remote_pct"))


@report
def avg_jobs_per_company(jobs):
    out = trends.avg_jobs_per_company(jobs)
    return out.select("run_date", r6("avg_jobs_per_company").alias("avg_jobs_per_company"))


@report
def jobs_with_skill(jobs):
    return trends.jobs_with_skill(jobs, "Python")


@report
def skills_expanded(jobs):
    return trends.skills_expanded(jobs)


@report
def top_companies(jobs):
    return trends.top_companies(jobs, 10)


@report
def jobs_by_state(jobs):
    return trends.jobs_by_state(jobs)


@report
def top_cities(jobs):
    return trends.top_cities(jobs, 10)


@report
def remote_by_state(jobs):
    return trends.remote_by_state(jobs)


@report
def state_hhi(jobs):
    return trends.state_hhi(jobs).select("run_date", r6("hhi").alias("hhi"))


@report
def top_skills_per_family(jobs):
    return trends.top_skills_per_family(jobs, 5)


@report
def skill_family_matrix(jobs):
    return trends.skill_family_matrix(jobs, 20)


@report
def industry_share(jobs):
    out = trends.industry_share(jobs)
    return out.select("run_date", "industry_tag", "role_family", "job_count",
                      r6("share_of_industry").alias("share_of_industry"),
                      r6("industry_share_of_run").alias("industry_share_of_run"))


@report
def eng_ratio(jobs):
    out = trends.eng_ratio(jobs)
    return out.select("run_date", "eng_jobs", "non_eng_jobs", r6("eng_ratio").alias("eng_ratio"))


@query
def portfolio_jobs(spark, sf):
    return trends.portfolio_jobs(_jobs(spark, sf), _seeds(spark, sf))


@query
def benchmark_vs_market(spark, sf):
    out = trends.benchmark_vs_market(_jobs(spark, sf), _seeds(spark, sf))
    return out.select("run_date", r6("market_avg").alias("market_avg"), r6("portfolio_avg").alias("portfolio_avg"),
                      r6("portfolio_vs_market").alias("portfolio_vs_market"))


@report
def dim_company(jobs):
    return trends.dim_company(jobs)


@report
def dim_date(jobs):
    return trends.dim_date(jobs)


@report
def star_by_week(jobs):
    return trends.star_by_week(jobs)


# ------------------------------------------------------------- boards (U, J5)

@query
def detect_ats(spark, sf):
    b = testdata.boards(spark, sf)
    return b.select(
        "page_id", "url",
        bd.is_greenhouse_url("url").alias("is_greenhouse"),
        bd.is_lever_url("url").alias("is_lever"),
        bd.greenhouse_token("url").alias("greenhouse_token"),
        bd.lever_company("url").alias("lever_company"),
        bd.detect_ats("url").alias("ats"),
    )


@query
def board_identifiers(spark, sf):
    b = testdata.boards(spark, sf)
    return b.select(
        "page_id", "ats_type",
        bd.board_identifier("url", "ats_type").alias("identifier"),
        bd.identifier_error("url", "ats_type").alias("error"),
    )


@query
def discovered_urls(spark, sf):
    return discovery.discover_from_urls(testdata.boards(spark, sf).select("page_id", "url")) \
        .select("page_id", "company_name", "careers_url", "ats_type", "discovery_method",
                r6("confidence").alias("confidence"))


@query
def candidate_urls(spark, sf):
    seeds = discovery.domain_seeds(testdata.boards(spark, sf))
    return discovery.candidate_urls(seeds).select("domain", "company_name", "pos", "url")


@query
def first_board_hit(spark, sf):
    b = testdata.boards(spark, sf)
    hits = discovery.first_board_hit(discovery.domain_seeds(b), discovery.probe_results(b))
    return hits.select("domain", "company_name", "careers_url", "ats_type", "discovery_method",
                       r6("confidence").alias("confidence"))


@query
def verified_boards(spark, sf):
    b = testdata.boards(spark, sf)
    found = discovery.discover_from_urls(b.select("page_id", "url"))
    postings = valid_jobs(pipeline.canonical(spark, sf)).select("job_url")
    return discovery.verify_boards(found, postings).select("page_id", "ats_type", "identifier")


@query
def job_urls(spark, sf):
    p = testdata.postings(spark, sf)
    return p.select(
        "pos",
        bd.greenhouse_job_url("company_slug", "source_job_id").alias("greenhouse_url"),
        bd.lever_job_url("company_slug", "source_job_id").alias("lever_url"),
    )
