"""Tables that are maintained run by run equal those made anew."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import scratch_dir
from hiresight.operators import dedupe, facts
from hiresight.plans import jobs as J
from hiresight.plans.queries import REPORTS
from hiresight.schemas import CANONICAL
from hiresight.sources import bucketed, files, store

DATES = ["2025-01-06", "2025-01-13", "2025-01-20"]


def postings(spark, rows):
    """Canonical rows from (run date, key, state, skills)."""
    full = []
    for d, key, state, skills in rows:
        v = {f.name: None for f in CANONICAL} | {
            "source": key.split("_")[0], "source_job_id": key, "job_url": "u", "company_name": f"Co {len(key) % 3}", "company_id": f"c{len(key) % 3}",
            "title": f"{key} {d}", "description": "text", "location_raw": state or "", "state": state, "city": state and state.lower(), "is_remote": key[-1] in "13",
            "country": "US", "date_scraped": dt.datetime(2025, 1, 1), "role_family": ["Data/AI", "Sales", None][len(key) % 3], "skills": skills,
            "industry_tag": ["Retail", None][len(skills) % 2], "run_date": dt.date.fromisoformat(d), "job_key": key}
        full.append(tuple(v[f.name] for f in CANONICAL))
    return spark.createDataFrame(full, CANONICAL)


def first_history(spark):
    rows = []
    for k, d in enumerate(DATES):
        for i in range(30):
            if (i + k) % 3:
                rows.append((d, f"{'lever' if i % 4 else 'greenhouse'}_{i}" + "x" * (i % 5), ["CO", "TN", None][i % 3], ["Python", "SQL", "Go"][: i % 4]))
    return postings(spark, rows)


def rows_of(df):
    return sorted(map(str, df.collect()))


@pytest.fixture()
def history(spark):
    path = scratch_dir("history-") + "/jobs"
    store.write_jobs(first_history(spark), path)
    return path


def anew_latest(spark, path, upto):
    return dedupe.latest_per_key(store.read_jobs(spark, path).where(F.col("run_date") <= F.lit(upto).cast("date")), ["job_key"], ["run_date"], [F.col("source")])


def test_snapshot_is_merged_without_moving_it(spark, history):
    root = scratch_dir("snap-")
    for d in DATES:
        J.run_latest_incremental(spark, history, root, d, buckets=4)
        assert rows_of(store.read_snapshot(spark, f"{root}/version={d}")) == rows_of(anew_latest(spark, history, d))
    old = bucketed.read(spark, f"{root}/version={DATES[1]}", CANONICAL)
    plan = dedupe.merge_latest(old, store.read_jobs(spark, history, run_date=DATES[2]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(job_key") == 1 and "Bucketed: true" in plan
    above = plan.split("Exchange")[0]  # the snapshot comes first in the join: no exchange stands over it
    assert "SortMergeJoin" in above and f"version={DATES[1]}" in above
    # a late rebuild mends the later versions
    late = postings(spark, [(DATES[0], "lever_new", "CO", []), (DATES[0], "greenhouse_0", "TN", ["Go"])])
    store.write_jobs(late, history, [DATES[0]])
    J.run_latest_incremental(spark, history, root, DATES[0])
    for d in DATES:
        assert rows_of(store.read_snapshot(spark, f"{root}/version={d}")) == rows_of(anew_latest(spark, history, d))


def test_a_version_without_its_marker_is_not_there(spark, history):
    root = scratch_dir("snap-")
    J.run_latest_incremental(spark, history, root, DATES[0], buckets=2)
    J.run_latest_incremental(spark, history, root, DATES[1])
    files.delete(spark, f"{root}/version={DATES[1]}/_layout.json")        # died before the end
    assert bucketed.versions(spark, root) == [DATES[0]]
    J.run_latest_incremental(spark, history, root, DATES[1])
    assert rows_of(store.read_snapshot(spark, f"{root}/version={DATES[1]}")) == rows_of(anew_latest(spark, history, DATES[1]))


def tagged(spark, path, index, d):
    return sorted((r["job_key"], str(r["first_run_date"]), r["is_new"]) for r in J.read_tagged_run(spark, path, index, d).collect())


def test_first_seen_index_tags_runs_and_survives_rebuilds(spark, history):
    root = scratch_dir("index-")

    def check(dates):
        whole = dedupe.new_vs_existing(store.read_jobs(spark, history).where(F.col("run_date").isin([F.lit(d).cast("date") for d in dates])))
        for d in dates:
            want = whole.where(F.col("run_date") == F.lit(d).cast("date"))
            assert tagged(spark, history, root, d) == sorted((r["job_key"], str(r["first_run_date"]), r["is_new"]) for r in want.collect())

    for k, d in enumerate(DATES):
        J.run_first_seen(spark, history, root, d, buckets=4)
        check(DATES[: k + 1])
    # one run is tagged from its rows and the index alone, and the index does not move
    plan = J.read_tagged_run(spark, history, root, DATES[2])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and plan.count("hashpartitioning") <= 1
    # rebuilt: some keys are gone from the first run, a new one is there
    kept = store.read_jobs(spark, history, run_date=DATES[0]).where("source = 'lever'")
    rebuilt = kept.unionByName(postings(spark, [(DATES[0], "lever_29xxxx", "CO", [])]))
    store.write_jobs(rebuilt.dropDuplicates(["job_key"]), history, [DATES[0]])
    J.run_first_seen(spark, history, root, DATES[0])
    check(DATES)
    # and a run that became empty
    store.write_jobs(first_history(spark).limit(0), history, [DATES[1]])
    J.run_first_seen(spark, history, root, DATES[1])
    check([DATES[0], DATES[2]])


def test_an_older_run_may_come_late(spark, history):
    root = scratch_dir("index-")
    for d in (DATES[1], DATES[0], DATES[2]):
        J.run_first_seen(spark, history, root, d, buckets=2)
    newest = bucketed.versions(spark, root)[-1]
    got = {r["job_key"]: str(r["first_run_date"]) for r in bucketed.read(spark, f"{root}/version={newest}", J.INDEX).collect()}
    assert got == {r["job_key"]: str(r["first_run_date"]) for r in dedupe.first_seen(store.read_jobs(spark, history)).collect()}


NEEDS_KEYS = {"new_vs_existing_by_run", "new_vs_previous_run", "skills_expanded", "enrichment_coverage"}


def test_reports_from_facts(spark, history):
    path = scratch_dir("facts-") + "/facts"
    assert J.run_facts(spark, history, path) == DATES and J.run_facts(spark, history, path) == []

    def check():
        made, whole = J.read_facts(spark, path), store.read_jobs(spark, history)
        for name, report in REPORTS.items():
            if name not in NEEDS_KEYS:
                assert rows_of(report(made)) == rows_of(report(whole)), name

    check()
    # a rebuilt date and a date that became empty are the only ones made anew
    store.write_jobs(postings(spark, [(DATES[1], "lever_77", "CO", ["Rust"])]), history, [DATES[1]])
    store.write_jobs(first_history(spark).limit(0), history, [DATES[2]])
    assert J.run_facts(spark, history, path) == DATES[1:]
    check()
    read = J.read_facts(spark, path)
    assert not any("jobs" in f.split("/")[-4:] for f in read.inputFiles()) and "job_key" not in read.columns
    assert facts.job_facts(store.read_jobs(spark, history)).count() == read.count()


def test_sketches_stay_within_their_bound(spark):
    from hiresight.operators import sketches

    # 8 runs that share most of their keys: 20,000 and more distinct ones over the ranges
    ids = spark.range(0, 8 * 12_000).withColumn("run", (F.col("id") / 12_000).cast("int"))
    jobs = ids.select(F.date_add(F.lit("2025-01-06").cast("date"), F.col("run") * 7).alias("run_date"),
                      (F.col("id") % 12_000 + F.col("run") * 1_500).cast("string").alias("job_key"), (F.col("id") % 40).cast("string").alias("city"))
    kept = sketches.run_sketches(jobs, ["job_key", "city"]).persist()
    days = sorted(str(r[0]) for r in kept.select("run_date").collect())
    for i in range(8):
        for j in range(i, 8):
            got = sketches.distinct_between(kept, days[i], days[j]).first()
            exact = 12_000 + 1_500 * (j - i)
            assert abs(got["job_key"] - exact) <= 0.05 * exact and got["city"] == 40
    assert tuple(sketches.exact_between(jobs, days[1], days[3], ["job_key", "city"]).first()) == (15_000, 40)
    assert tuple(sketches.distinct_between(kept, "1999-01-01", "1999-01-02").first()) == (0, 0)
    many = {(str(r["since"]), str(r["until"])): r["job_key"] for r in sketches.distinct_over(kept, [(days[0], days[2]), (days[4], days[4])]).collect()}
    assert many == {k: sketches.distinct_between(kept, *k).first()["job_key"] for k in many} and len(many) == 2
    kept.unpersist()
