"""Trend and BI measures over the job history.

Windows here only ever run over *aggregated* rows, never over postings:
ranking and share windows partition by run (and a dictionary value) over
rows bounded by dictionary sizes or the 51 states; ``lag`` windows see one
row per run. Rankings over an unbounded key (companies, cities) are
two-stage (``metrics.top_n``); changes between runs are joins, not windows
over per-company partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..dictionaries import ROLE_FAMILIES, Taxonomy
from ..sources.layout import checkpointed
from .metrics import JOBS, RUN, explode_skills, n_jobs, n_jobs_if, rank_within, top_n

ENGINEERING_FAMILY = "Tech/Engineering"


def jobs_by_run(jobs: DataFrame) -> DataFrame:
    return jobs.groupBy(RUN).agg(n_jobs(jobs).alias("total_jobs"))


def runs_with_previous(rows: DataFrame) -> DataFrame:
    """Distinct runs of jobs, or of counts per run, with the previous existing
    run. One row per run date; the global window sees only that many rows."""
    runs = rows.select(RUN).distinct()
    return runs.withColumn("prev_run_date", F.lag(RUN).over(Window.orderBy(RUN)))


def jobs_growth(jobs: DataFrame) -> DataFrame:
    """Total per run minus total of the previous existing run (0 before the
    first run)."""
    per_run = jobs_by_run(jobs)
    prev = F.lag("total_jobs").over(Window.orderBy(RUN))
    return (per_run.withColumn("prev_jobs", F.coalesce(prev, F.lit(0)))
            .withColumn("jobs_growth", F.col("total_jobs") - F.col("prev_jobs")))


def _shift_to_next_run(counts: DataFrame, runs: DataFrame, value: str, keys: list[str]) -> DataFrame:
    """Re-key each (keys, run) count to the run that follows it."""
    nxt = runs.select(F.col("prev_run_date").alias(RUN + "_from"), F.col(RUN).alias("next_run"))
    return (counts.join(nxt, counts[RUN] == nxt[RUN + "_from"], "inner")
            .select(*keys, F.col("next_run").alias(RUN), F.col(value).alias("prev_" + value)))


def change_vs_previous_run(counts: DataFrame, runs: DataFrame, keys: list[str], value: str) -> DataFrame:
    """For each key, value in a run vs the previous existing run, with
    missing values as 0. A full outer join with the counts shifted by one
    run keeps the runs where a key appears and the run right after it
    disappears, without densifying keys x runs."""
    prev = _shift_to_next_run(counts, runs, value, keys)
    joined = counts.join(prev, [*keys, RUN], "full_outer")
    return joined.select(
        *keys, RUN,
        F.coalesce(F.col(value), F.lit(0)).alias(value),
        F.coalesce(F.col("prev_" + value), F.lit(0)).alias("prev_" + value),
    ).withColumn("change", F.col(value) - F.col("prev_" + value))


def _change_of(counts: DataFrame, key: str, value: str) -> DataFrame:
    """Change per key of counts by run. The runs come from the counts (null
    keys included). The counts are checkpointed: the shifted side and the run
    list prune them differently, so Spark would not reuse their exchange and
    build the history once for each."""
    counts = checkpointed(counts)
    return change_vs_previous_run(counts.where(F.col(key).isNotNull()), runs_with_previous(counts), [key], value)


def skill_growth(jobs: DataFrame) -> DataFrame:
    # jobs without skills count under a null skill, so that every run shows up
    ex = jobs.select(RUN, *([JOBS] if JOBS in jobs.columns else []), F.explode_outer("skills").alias("skill"))
    counts = ex.groupBy(RUN, "skill").agg(n_jobs(ex).alias("job_count"))
    return _change_of(counts, "skill", "job_count")


def hiring_velocity(jobs: DataFrame) -> DataFrame:
    """Jobs per company per run and change vs the previous run."""
    counts = jobs.groupBy("company_id", RUN).agg(n_jobs(jobs).alias("job_count"))
    return _change_of(counts, "company_id", "job_count")


def role_mix_shift(jobs: DataFrame) -> DataFrame:
    """Share of each role family in each run and its change vs the
    previous run."""
    counts = jobs.groupBy(RUN, "role_family").agg(n_jobs(jobs).alias("job_count"))
    total = F.sum("job_count").over(Window.partitionBy(RUN))  # at most one row per family and run
    shares = counts.select(RUN, "role_family", (F.col("job_count") / total).alias("share"))
    return _change_of(shares, "role_family", "share").withColumnRenamed("change", "share_change")


def remote_pct(jobs: DataFrame) -> DataFrame:
    return jobs.groupBy(RUN).agg(
        F.coalesce(F.try_divide(n_jobs_if(jobs, F.col("is_remote")), n_jobs(jobs)), F.lit(0.0)).alias("remote_pct"))


def avg_jobs_per_company(jobs: DataFrame) -> DataFrame:
    return jobs.groupBy(RUN).agg(
        F.try_divide(n_jobs(jobs), F.count_distinct("company_id")).alias("avg_jobs_per_company"))


def jobs_with_skill(jobs: DataFrame, skill: str) -> DataFrame:
    """Jobs whose skill list contains ``skill`` exactly (a text search would
    count Java inside JavaScript)."""
    return jobs.groupBy(RUN).agg(n_jobs_if(jobs, F.array_contains("skills", skill)).alias("jobs_with_skill"))


def skills_expanded(jobs: DataFrame) -> DataFrame:
    """One row per (job, skill); a job without skills keeps one null row."""
    return jobs.select("job_key", RUN, F.explode_outer("skills").alias("skill"))


def top_companies(jobs: DataFrame, n: int = 10) -> DataFrame:
    """Top ``n`` hiring companies per run; the number of companies grows
    with the data, so the ranking is two-stage (see ``top_n``)."""
    counts = jobs.groupBy(RUN, "company_name").agg(n_jobs(jobs).alias("job_count"))
    return top_n(counts, [RUN], [F.desc("job_count"), F.asc("company_name")], n, ["company_name"])


def jobs_by_state(jobs: DataFrame) -> DataFrame:
    return jobs.where(F.col("state").isNotNull()).groupBy(RUN, "state").agg(n_jobs(jobs).alias("job_count"))


def top_cities(jobs: DataFrame, n: int = 10) -> DataFrame:
    counts = jobs.where(F.col("city").isNotNull()).groupBy(RUN, "city", "state").agg(n_jobs(jobs).alias("job_count"))
    return top_n(counts, [RUN], [F.desc("job_count"), F.asc("city"), F.asc("state")], n, ["city", "state"])


def remote_by_state(jobs: DataFrame) -> DataFrame:
    return jobs.where(F.col("state").isNotNull()).groupBy(RUN, "state").agg(
        n_jobs_if(jobs, F.col("is_remote")).alias("remote_jobs"),
        n_jobs_if(jobs, ~F.col("is_remote")).alias("onsite_jobs"),
    )


def state_hhi(jobs: DataFrame) -> DataFrame:
    """Herfindahl-Hirschman index of jobs over states: sum of squared
    shares (jobs without a state excluded)."""
    by_state = jobs_by_state(jobs)
    total = F.sum("job_count").over(Window.partitionBy(RUN))
    return (by_state.withColumn("share", F.col("job_count") / total)
            .groupBy(RUN).agg(F.sum(F.col("share") * F.col("share")).alias("hhi")))


def top_skills_per_family(jobs: DataFrame, n: int = 5) -> DataFrame:
    ex = explode_skills(jobs, "role_family")
    counts = ex.where(F.col("role_family").isNotNull()).groupBy(RUN, "role_family", "skill").agg(n_jobs(ex).alias("job_count"))
    return rank_within(counts, [RUN, "role_family"], [F.desc("job_count"), F.asc("skill")], n)


def family_column(name: str) -> str:
    return "".join(ch if ch.isalnum() else "_" for ch in name.lower()).strip("_")


def skill_family_matrix(jobs: DataFrame, n: int = 20, taxonomy: Taxonomy = ROLE_FAMILIES) -> DataFrame:
    """Skill x role-family job counts for the top ``n`` skills of each run.
    The pivot values are the taxonomy's families, so no extra pass is needed
    to discover them."""
    families = [f for f, _ in taxonomy]
    ex = explode_skills(jobs, "role_family")
    counts = ex.groupBy(RUN, "skill").agg(
        n_jobs(ex).alias("job_count"),
        *[n_jobs_if(ex, F.col("role_family") == f).alias(family_column(f)) for f in families],
    )
    return rank_within(counts, [RUN], [F.desc("job_count"), F.asc("skill")], n)


def industry_share(jobs: DataFrame) -> DataFrame:
    """Role distribution within each industry, and industry share of the run."""
    counts = (jobs.where(F.col("industry_tag").isNotNull() & F.col("role_family").isNotNull())
              .groupBy(RUN, "industry_tag", "role_family").agg(n_jobs(jobs).alias("job_count")))
    in_ind = F.sum("job_count").over(Window.partitionBy(RUN, "industry_tag"))
    in_run = F.sum("job_count").over(Window.partitionBy(RUN))
    return (counts.withColumn("share_of_industry", F.col("job_count") / in_ind)
            .withColumn("industry_share_of_run", in_ind / in_run))


def eng_ratio(jobs: DataFrame) -> DataFrame:
    eng = F.col("role_family") == ENGINEERING_FAMILY
    return jobs.groupBy(RUN).agg(
        n_jobs_if(jobs, eng).alias("eng_jobs"),
        n_jobs_if(jobs, ~eng | F.col("role_family").isNull()).alias("non_eng_jobs"),
    ).withColumn("eng_ratio", F.try_divide(F.col("eng_jobs"), F.col("non_eng_jobs")))


def _seed_key(c: Column) -> Column:
    return F.lower(F.trim(c))


def portfolio_jobs(jobs: DataFrame, seeds: DataFrame) -> DataFrame:
    """Jobs of portfolio companies (seed flag ``is_portfolio``), per run and
    company. Seeds are joined on the normalised company name; the seed list
    is one row per company, and AQE broadcasts it when it is small."""
    port = (seeds.where(F.col("is_portfolio"))
            .select(_seed_key(F.col("company_name")).alias("seed_key")).distinct())
    tagged = jobs.join(port, _seed_key(jobs["company_name"]) == port["seed_key"], "left_semi")
    return tagged.groupBy(RUN, "company_name").agg(n_jobs(jobs).alias("job_count"))


def benchmark_vs_market(jobs: DataFrame, seeds: DataFrame) -> DataFrame:
    """Average jobs per portfolio company vs per company overall, by run."""
    market = jobs.groupBy(RUN).agg(F.try_divide(n_jobs(jobs), F.count_distinct("company_id")).alias("market_avg"))
    port = portfolio_jobs(jobs, seeds).groupBy(RUN).agg(
        F.try_divide(F.sum("job_count"), F.count(F.lit(1))).alias("portfolio_avg"))
    return (market.join(port, RUN, "left")
            .withColumn("portfolio_vs_market", F.try_divide(F.col("portfolio_avg"), F.col("market_avg"))))


def jobs_per_capita(jobs: DataFrame, population: DataFrame) -> DataFrame:
    """Jobs per 1M residents by state; ``population(state, population)`` is
    supplied by the user (census table)."""
    return (jobs_by_state(jobs).join(population, "state", "inner")
            .withColumn("jobs_per_million", F.try_divide(F.col("job_count") * F.lit(1_000_000.0), F.col("population"))))


def dim_company(jobs: DataFrame) -> DataFrame:
    return jobs.groupBy("company_id").agg(F.min("company_name").alias("company_name"))


def dim_date(jobs: DataFrame) -> DataFrame:
    """Every calendar date between the first and the last run, flagged when
    a run happened that day."""
    bounds = jobs.agg(F.min(RUN).alias("lo"), F.max(RUN).alias("hi"))
    days = bounds.select(F.explode(F.sequence("lo", "hi")).alias("date"))
    runs = jobs.select(F.col(RUN).alias("date")).distinct().withColumn("has_run", F.lit(True))
    return (days.join(runs, "date", "left")
            .select("date", F.coalesce("has_run", F.lit(False)).alias("has_run"),
                    F.year("date").alias("year"), F.month("date").alias("month"),
                    F.weekofyear("date").alias("week")))


def star_by_week(jobs: DataFrame) -> DataFrame:
    """The star join: jobs with their company and date dimensions, summed up by
    company and calendar week. The fact side is aggregated to (company, run)
    before it meets the dimensions."""
    facts = jobs.groupBy("company_id", RUN).agg(n_jobs(jobs).alias("job_count"), n_jobs_if(jobs, F.col("is_remote")).alias("remote_jobs"))
    return (facts.join(dim_company(jobs), "company_id").join(dim_date(jobs), F.col(RUN) == F.col("date"))
            .groupBy("company_id", "company_name", "year", "week")
            .agg(F.sum("job_count").alias("job_count"), F.sum("remote_jobs").alias("remote_jobs"), F.count(F.lit(1)).alias("runs")))
