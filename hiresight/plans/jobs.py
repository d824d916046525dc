"""Batch entry points: the stages a deployment schedules (build, metrics,
latest snapshot, export), as functions over paths. Each is one or a few
Spark jobs; nothing is collected to the driver except row counts."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import dedupe, facts, metrics
from ..operators.canonical import canonical_rows, rejects
from ..schemas import CANONICAL
from ..sources import bucketed, files, landing, store, versions
from ..sources.registry import DEFAULT_SOURCES, Sources
from .pipeline import jobs_from_canonical


def run_build(spark: SparkSession, raw_root: str, jobs_path: str, rejects_path: str | None,
              run_date: str | Sequence[str], strict_us: bool = True, sources: Sources = DEFAULT_SOURCES) -> None:
    """Landed files of one or several runs -> canonical, deduplicated, enriched
    history (dates that are rebuilt are replaced) + rejects. Raw files are
    parsed once: jobs and rejects are built from staged rows, which go again."""
    dates = [run_date] if isinstance(run_date, str) else list(run_date)
    staged = f"{jobs_path.rstrip('/')}_staged/{uuid.uuid4()}"
    canon = canonical_rows(landing.read_drafts(spark, raw_root, dates, sources=sources), strict_us, clean_description=False)
    canon = canon.withColumn("rejected", F.col("reason").isNotNull())
    try:
        canon.write.partitionBy("rejected").parquet(staged)
        rows = spark.read.schema(canon.schema).parquet(staged)
        store.write_jobs(jobs_from_canonical(rows.where("NOT rejected")), jobs_path, dates)
        if rejects_path is not None:
            store.write_rejects(rejects(rows.where("rejected")), rejects_path, dates)
    finally:
        files.delete(spark, staged)


def run_metrics(spark: SparkSession, jobs_path: str, out_dir: str, run_date: str) -> list[str]:
    """The five metric tables of one run as CSV folders
    ``{out_dir}/{metric}_{run_date}``; nothing is written for an empty run."""
    jobs = store.read_jobs(spark, jobs_path, run_date=run_date)
    if jobs.limit(1).count() == 0:
        return []
    # the columns that the metrics read; bodies are never cached
    jobs = jobs.select("run_date", "source", "company_id", "role_family", "state", "is_remote", "skills", "industry_tag").persist()
    written = []
    for name, table in metrics.generate_metrics(jobs).items():
        path = f"{out_dir.rstrip('/')}/{name}_{run_date}"
        store.write_csv(table.drop("rank") if "rank" in table.columns else table, path)
        written.append(path)
    jobs.unpersist()
    return written


def run_latest(spark: SparkSession, jobs_path: str, snapshot_path: str, csv_path: str | None = None,
               as_of: str | None = None) -> None:
    """Latest row per job key over every run (optionally up to ``as_of``),
    ties broken by source. Written to a folder distinct from the history."""
    hist = store.read_jobs(spark, jobs_path)
    if as_of is not None:
        hist = hist.where(F.col("run_date") <= F.lit(as_of).cast("date"))
    snap = dedupe.latest_per_key(hist, ["job_key"], ["run_date"], [F.col("source")])
    store.write_snapshot(snap, snapshot_path)
    if csv_path:
        store.write_csv(store.read_snapshot(spark, snapshot_path), csv_path, single_file=False)


def run_latest_incremental(spark: SparkSession, jobs_path: str, snapshot_root: str, run_date: str, buckets: int | None = None) -> str:
    """Latest snapshot after ``run_date`` from the previous version and only
    that run's partition. Versions are stored by ``job_key`` (``bucketed``), so
    the merge shuffles the run alone; each is a new ``version=run_date`` folder
    (never its own input). After a late rebuild of an earlier date the later
    versions are made anew, one after the other, so each equals the full rebuild
    of its date. Returns the folder of ``run_date``."""
    known = bucketed.versions(spark, snapshot_root)
    before = max((v for v in known if v < run_date), default=None)
    for date in [run_date, *(v for v in known if v > run_date)]:
        run = store.read_jobs(spark, jobs_path, run_date=date)
        snap = run
        if before is not None:
            old = f"{snapshot_root}/version={before}"
            snap = dedupe.merge_latest(bucketed.read(spark, old, CANONICAL), run)
            buckets = bucketed.layout(spark, old)["buckets"]
        bucketed.write(snap, f"{snapshot_root}/version={date}", "job_key", buckets)
        before = date
    return f"{snapshot_root}/version={run_date}"


INDEX = T.StructType([T.StructField("job_key", T.StringType()), T.StructField("first_run_date", T.DateType())])


def run_first_seen(spark: SparkSession, jobs_path: str, index_root: str, run_date: str, buckets: int | None = None) -> str:
    """Bring the first-seen index (job key, first run) up to ``run_date``: a new
    run is merged in, a run that was rebuilt is repaired, whatever its place in
    time. The index is stored by ``job_key``; versions are numbered folders, each
    with the runs that it covers. Returns the newest version's folder."""
    known = bucketed.versions(spark, index_root)
    run = store.read_jobs(spark, jobs_path, run_date=run_date).select("job_key", "run_date")
    covered: list[str] = []
    index = dedupe.run_keys(run)
    if known:
        newest = f"{index_root}/version={known[-1]}"
        how = bucketed.layout(spark, newest)
        covered, buckets, old = how["runs"], how["buckets"], bucketed.read(spark, newest, INDEX)
        if run_date in covered:
            later = store.read_jobs(spark, jobs_path, since=run_date).where(F.col("run_date") > F.lit(run_date).cast("date"))
            later = later.where(F.col("run_date").isin([F.lit(d).cast("date") for d in covered]))
            index = dedupe.repair_first_seen(old, run, later, run_date)
        else:
            index = dedupe.merge_first_seen(old, dedupe.run_keys(run))
    path = f"{index_root}/version={len(known) and int(known[-1]) + 1:08d}"
    bucketed.write(index, path, "job_key", buckets, runs=sorted({*covered, run_date}))
    return path


def read_tagged_run(spark: SparkSession, jobs_path: str, index_root: str, run_date: str) -> DataFrame:
    """A run's rows with ``first_run_date`` and ``is_new``, read from that run and
    the newest index alone."""
    newest = bucketed.versions(spark, index_root)[-1]
    return dedupe.tag_run(store.read_jobs(spark, jobs_path, run_date=run_date), bucketed.read(spark, f"{index_root}/version={newest}", INDEX))


def run_facts(spark: SparkSession, jobs_path: str, facts_path: str) -> list[str]:
    """Bring the facts beside a history up to date and return the dates that
    were made anew: those whose history has another version than the one that
    the facts were made from. Only these dates' postings are read, without
    their texts."""
    jobs, known = versions.current(spark, jobs_path), versions.made_from(spark, facts_path)
    stale = sorted(d for d in {*jobs, *known} if jobs.get(d) != known.get(d))
    if stale:
        rows = store.read_jobs(spark, jobs_path).where(F.col("run_date").isin([F.lit(d).cast("date") for d in stale]))
        versions.replace_dates(facts.job_facts(rows), facts_path, stale, lambda w, to: w.parquet(to), of={d: jobs.get(d) for d in stale})
    return stale


def read_facts(spark: SparkSession, facts_path: str) -> DataFrame:
    """Facts for the reports of ``metrics`` and ``trends``."""
    return versions.read_dates(spark, facts_path, facts.FACTS)


def run_full(spark: SparkSession, raw_root: str, data_root: str, run_date: str) -> None:
    """build -> metrics -> latest for one run (the landing step is external)."""
    jobs = f"{data_root}/staged/jobs"
    run_build(spark, raw_root, jobs, f"{data_root}/exports/rejects", run_date, strict_us=True)
    run_metrics(spark, jobs, f"{data_root}/exports", run_date)
    run_latest(spark, jobs, f"{data_root}/staged/latest", f"{data_root}/exports/jobs_latest")
