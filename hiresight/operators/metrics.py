"""Per-run metric tables over the job history.

Every metric groups by ``run_date`` as well, so one call covers all runs
(pass a filtered frame, e.g. ``where(run_date == d)``, for a single run; the
filter prunes partitions of a partitioned store). Aggregations are hash
aggregates with map-side partial combine, so a dominant skill, state or
company is reduced on every map task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RUN = "run_date"
#: a row of facts (``operators.facts``) stands for this many jobs
JOBS = "n_jobs"


def n_jobs(rows: DataFrame) -> Column:
    """Count of jobs: of the rows, or of the jobs that they stand for."""
    return F.sum(JOBS) if JOBS in rows.columns else F.count(F.lit(1))


def n_jobs_if(rows: DataFrame, condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col(JOBS))), F.lit(0)) if JOBS in rows.columns else F.count_if(condition)


def _weight(rows: DataFrame) -> list[str]:
    return [JOBS] if JOBS in rows.columns else []


def explode_skills(jobs: DataFrame, *keep: str) -> DataFrame:
    """One row per (job, skill); jobs without skills drop out."""
    return jobs.where(F.size("skills") > 0).select(RUN, *keep, *_weight(jobs), F.explode("skills").alias("skill"))


def skills_by_role_family(jobs: DataFrame) -> DataFrame:
    ex = explode_skills(jobs, "role_family")
    return ex.where(F.col("role_family").isNotNull()).groupBy(RUN, "role_family", "skill").agg(n_jobs(ex).alias("job_count"))


def skills_by_state(jobs: DataFrame) -> DataFrame:
    ex = explode_skills(jobs, "state")
    return ex.where(F.col("state").isNotNull()).groupBy(RUN, "state", "skill").agg(n_jobs(ex).alias("job_count"))


def rank_within(df: DataFrame, group: list[str], order: list, n: int | None) -> DataFrame:
    """``rank`` 1..n inside each group (row_number over a deterministic
    order). Run on aggregated rows, whose group sizes are bounded by the
    dictionary / number of distinct values, never on raw rows."""
    w = Window.partitionBy(*group).orderBy(*order)
    out = df.withColumn("rank", F.row_number().over(w).cast("long"))
    return out.where(F.col("rank") <= n) if n is not None else out


def top_n(df: DataFrame, group: list[str], order: list, n: int, key: list[str], buckets: int = 64) -> DataFrame:
    """Exact top ``n`` per group when groups can be large (e.g. companies
    of a run): rank inside ``(group, hash(key) % buckets)`` first, keep ``n``
    per bucket, then rank the at most ``buckets * n`` survivors per group.
    Every row of the global top ``n`` is in the top ``n`` of its bucket, so
    the result equals a single window over the whole group, without sending
    the whole group to one task."""
    salted = df.withColumn("__b", F.pmod(F.xxhash64(*[F.col(k) for k in key]), F.lit(buckets)))
    local = rank_within(salted, [*group, "__b"], order, n).drop("rank", "__b")
    return rank_within(local, group, order, n)


def top_skills(jobs: DataFrame, n: int = 100) -> DataFrame:
    """Top ``n`` skills per run by job count (ties by skill name)."""
    ex = explode_skills(jobs)
    counts = ex.groupBy(RUN, "skill").agg(n_jobs(ex).alias("job_count"))
    return rank_within(counts, [RUN], [F.desc("job_count"), F.asc("skill")], n)


def role_mix_by_industry(jobs: DataFrame) -> DataFrame:
    return (jobs.where(F.col("industry_tag").isNotNull() & F.col("role_family").isNotNull())
            .groupBy(RUN, "industry_tag", "role_family").agg(n_jobs(jobs).alias("job_count")))


def summary_stats(jobs: DataFrame) -> DataFrame:
    return jobs.groupBy(RUN).agg(
        n_jobs(jobs).alias("total_jobs"),
        n_jobs_if(jobs, F.col("source") == "greenhouse").alias("greenhouse_jobs"),
        n_jobs_if(jobs, F.col("source") == "lever").alias("lever_jobs"),
        F.count_distinct("company_id").alias("unique_companies"),
        n_jobs_if(jobs, F.col("is_remote")).alias("remote_jobs"),
        F.count_distinct("state").alias("states_covered"),
        n_jobs_if(jobs, F.size("skills") > 0).alias("jobs_with_skills"),
        n_jobs_if(jobs, F.col("industry_tag").isNotNull()).alias("jobs_with_industry"),
    )


def skill_grouping_sets(jobs: DataFrame) -> DataFrame:
    """A1-A3 in one pass: a single explode aggregated with grouping sets
    ((run, family, skill), (run, state, skill), (run, skill)). ``metric``
    names the set; null family/state rows are dropped, as in the per-metric
    tables."""
    ex = explode_skills(jobs, "role_family", "state")
    sets = [[RUN, "role_family", "skill"], [RUN, "state", "skill"], [RUN, "skill"]]
    out = ex.groupingSets(sets, RUN, "role_family", "state", "skill").agg(
        n_jobs(ex).alias("job_count"),
        F.grouping("role_family").alias("g_family"),
        F.grouping("state").alias("g_state"),
    )
    metric = (F.when((F.col("g_family") == 0), F.lit("skills_by_role_family"))
              .when(F.col("g_state") == 0, F.lit("skills_by_state"))
              .otherwise(F.lit("top_skills")))
    out = out.withColumn("metric", metric)
    keep = (((F.col("metric") == "skills_by_role_family") & F.col("role_family").isNotNull())
            | ((F.col("metric") == "skills_by_state") & F.col("state").isNotNull())
            | (F.col("metric") == "top_skills"))
    return out.where(keep).drop("g_family", "g_state")


def generate_metrics(jobs: DataFrame) -> dict[str, DataFrame]:
    """The five metric tables of one ``metrics`` run, all lazy. The three skill
    tables share one explode + aggregate (grouping sets)."""
    sets = skill_grouping_sets(jobs)
    by_family = sets.where(F.col("metric") == "skills_by_role_family").select(RUN, "role_family", "skill", "job_count")
    by_state = sets.where(F.col("metric") == "skills_by_state").select(RUN, "state", "skill", "job_count")
    overall = sets.where(F.col("metric") == "top_skills").select(RUN, "skill", "job_count")
    return {
        "skills_by_role_family": by_family.orderBy(RUN, "role_family", F.desc("job_count"), "skill"),
        "skills_by_state": by_state.orderBy(RUN, "state", F.desc("job_count"), "skill"),
        "top_skills_overall": rank_within(overall, [RUN], [F.desc("job_count"), F.asc("skill")], 100),
        "role_mix_by_industry": role_mix_by_industry(jobs).orderBy(RUN, "industry_tag", F.desc("job_count"), "role_family"),
        "summary_stats": summary_stats(jobs),
    }


def ingest_stats(raw: DataFrame) -> DataFrame:
    """Per run: company boards landed, postings, postings per source."""
    return raw.groupBy(RUN).agg(
        F.count_distinct("source", "company_name").alias("companies_processed"),
        F.count(F.lit(1)).alias("total_jobs"),
        F.count_if(F.col("source") == "greenhouse").alias("greenhouse_jobs"),
        F.count_if(F.col("source") == "lever").alias("lever_jobs"),
    )


def seed_outcomes(seeds: DataFrame, url: str = "careers_url", ats: str = "ats_type") -> DataFrame:
    """Extraction outcome per seed company, grouped by ATS type: a known ATS
    (greenhouse / lever) without a usable board identifier fails; an unknown
    ATS is processed with no postings, as in the original extractor."""
    from ..functions import boards as bd

    known = F.coalesce(F.col(ats).isin("greenhouse", "lever"), F.lit(False))
    failed = known & bd.board_identifier(url, ats).isNull()
    return seeds.groupBy(ats).agg(
        F.count(F.lit(1)).alias("companies"),
        F.count_if(~failed).alias("companies_processed"),
        F.count_if(failed).alias("companies_failed"),
        F.count_if(~known).alias("unknown_ats"),
    )


def ingest_summary(seeds: DataFrame, postings: DataFrame, url: str = "careers_url", ats: str = "ats_type",
                   job_url: str = "job_url") -> DataFrame:
    """Extraction summary by ATS type: seed companies, processed, failed (a
    known ATS without a usable identifier), processed ones without postings,
    and postings. Postings are counted per board first, so a hot board is one
    row when it meets the seeds."""
    from ..functions import boards as bd

    counts = (postings.select(bd.detect_ats(job_url).alias("__ats"), bd.board_identifier(job_url).alias("__id"))
              .where(F.col("__id").isNotNull()).groupBy("__ats", "__id").agg(F.count(F.lit(1)).alias("__n")))
    known = F.coalesce(F.col(ats).isin("greenhouse", "lever"), F.lit(False))
    tagged = seeds.select(F.col(ats), bd.board_identifier(url, ats).alias("__seed"), known.alias("__known"))
    failed = F.col("__known") & F.col("__seed").isNull()
    joined = tagged.join(counts, (F.col("__seed") == F.col("__id")) & (F.col(ats) == F.col("__ats")), "left")
    return joined.groupBy(ats).agg(
        F.count(F.lit(1)).alias("companies"),
        F.count_if(~failed).alias("companies_processed"),
        F.count_if(failed).alias("companies_failed"),
        F.count_if(~failed & F.col("__n").isNull()).alias("companies_without_postings"),
        F.coalesce(F.sum("__n"), F.lit(0)).alias("total_jobs"),
    )
