"""Landed JSON -> canonical -> dedupe -> enrich -> store round trip."""
import json
import os

import pytest
from pyspark.sql import functions as F

from hiresight.operators import dedupe
from hiresight.operators.canonical import canonicalize, rejects, valid_jobs
from hiresight.plans.pipeline import build_jobs
from conftest import scratch_dir
from hiresight.sources import landing, store

GH = {
    "id": 70411, "title": "Data Engineer, Ledger",
    "content": "<p>Nightly ledgers of a data team: SQL and Python.</p>",
    "location": {"name": "Denver, CO"},
    "absolute_url": "https://boards.greenhouse.io/oakbank/jobs/70411",
    "updated_at": "2025-01-14T16:20:00Z",
    "metadata": [{"name": "team", "value": "x"}, {"name": "department", "value": "Ledger"}, {"name": "employment_type", "value": "Permanent"}],
}
LV = {
    "id": "f00-77", "text": "Warehouse Planner",
    "description": "",
    "descriptionPlain": "Plan the night shifts.",
    "categories": {"location": "Nashville, TN", "department": "Depots", "commitment": "Seasonal"},
    "hostedUrl": "https://jobs.lever.co/oakbank/f00-77", "createdAt": 1736503200000,
}


def land(root, run_date, source, company, jobs):
    d = os.path.join(root, run_date, source, company.lower().replace(" ", ""))
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, "jobs.json"), "w") as f:
        json.dump({"company_name": company, "source": source, "identifier": "x",
                   "extracted_at": f"{run_date}T06:00:00", "job_count": len(jobs), "jobs": jobs}, f, indent=2)


@pytest.fixture(scope="module")
def raw_root():
    root = scratch_dir("raw-")
    abroad = dict(GH, id=2, location={"name": "Lyon, France"})
    no_id = {k: v for k, v in GH.items() if k != "id"}
    land(root, "2025-01-20", "greenhouse", "Test Company", [GH, abroad, dict(GH, content="A later copy with another body"), no_id])
    land(root, "2025-01-20", "lever", "Test Company", [LV])
    land(root, "2025-01-27", "greenhouse", "Test Company", [GH])
    land(root, "2025-01-27", "workday", "Other", [GH])
    return root


def test_scan_and_canonical(spark, raw_root):
    raw = landing.read_raw_postings(spark, raw_root, "2025-01-20")
    canon = canonicalize(raw)
    v = {r["source"]: r for r in valid_jobs(canon).collect()}
    gh, lv = v["greenhouse"], v["lever"]
    assert (gh["source_job_id"], gh["title"], gh["state"], gh["city"]) == ("70411", "Data Engineer, Ledger", "CO", "Denver")
    assert (gh["department"], gh["employment_type"], str(gh["date_posted"])) == ("Ledger", "Permanent", "2025-01-14")
    assert (lv["source_job_id"], lv["title"], lv["state"], lv["city"]) == ("f00-77", "Warehouse Planner", "TN", "Nashville")
    assert (lv["department"], lv["employment_type"], str(lv["date_posted"])) == ("Depots", "Seasonal", "2025-01-10")
    assert lv["description"] == "Plan the night shifts."
    rej = sorted((r["reason"], r["source_job_id"]) for r in rejects(canon).collect())
    assert rej == [("Failed US location validation", "2"), ("Transform error: missing id", "unknown")]


def test_unknown_source_is_dropped(spark, raw_root):
    canon = canonicalize(landing.read_raw_postings(spark, raw_root, "2025-01-27"))
    assert [r["source"] for r in canon.collect()] == ["greenhouse"]


def test_build_dedupes_within_run_and_enriches(spark, raw_root):
    jobs = build_jobs(landing.read_raw_postings(spark, raw_root)).collect()
    per_run = sorted((str(r["run_date"]), r["source"]) for r in jobs)
    assert per_run == [("2025-01-20", "greenhouse"), ("2025-01-20", "lever"), ("2025-01-27", "greenhouse")]
    gh = [r for r in jobs if r["source"] == "greenhouse"][0]
    # 'engineer' (Tech) and 'data engineer' (Data/AI) tie 11-11: the first family wins.
    assert gh["role_family"] == "Tech/Engineering" and gh["skills"] == ["Python", "SQL"]
    assert gh["description"] == "Nightly ledgers of a data team: SQL and Python."    # the first body wins
    assert gh["industry_tag"] == "Technology"      # 'data' in the description


def test_store_round_trip_is_idempotent(spark, raw_root):
    path = os.path.join(scratch_dir("store-"), "jobs")
    jobs = build_jobs(landing.read_raw_postings(spark, raw_root))
    store.write_jobs(jobs, path)
    store.write_jobs(jobs.where(F.col("run_date") == "2025-01-20"), path)   # rerun one date
    back = store.read_jobs(spark, path)
    assert back.count() == 3
    assert store.read_jobs(spark, path, run_date="2025-01-27").count() == 1
    assert store.read_jobs(spark, os.path.join(path, "missing")).count() == 0
    assert store.read_jobs(spark, path, since="2025-01-21").count() == 1
    assert store.read_jobs(spark, path, days=5, as_of="2025-01-29").count() == 1
    assert store.read_jobs(spark, path, days=90, as_of="2025-01-29").count() == 3


def test_keep_first_and_latest(spark):
    df = spark.createDataFrame([("k1", 1, "a"), ("k1", 0, "b"), ("k2", 5, "c")], "job_key string, pos long, v string")
    got = sorted(tuple(r) for r in dedupe.keep_first(df, ["job_key"], [F.col("pos")]).collect())
    assert got == [("k1", 0, "b"), ("k2", 5, "c")]
    again = dedupe.keep_first(dedupe.keep_first(df, ["job_key"], [F.col("pos")]), ["job_key"], [F.col("pos")])
    assert sorted(tuple(r) for r in again.collect()) == got     # idempotent


def test_new_existing_partition_current(spark):
    hist = spark.createDataFrame([("a",), ("b",)], "job_key string")
    cur = spark.createDataFrame([("a",), ("c",), ("d",)], "job_key string")
    new, ex = dedupe.split_new_existing(cur, hist)
    n, e = {r[0] for r in new.collect()}, {r[0] for r in ex.collect()}
    assert n == {"c", "d"} and e == {"a"} and not (n & e)
    empty = spark.createDataFrame([], "job_key string")
    assert dedupe.split_new_existing(cur, empty)[0].count() == 3


def test_full_run_writes_history_metrics_and_snapshot(spark, raw_root):
    from hiresight.plans.jobs import run_full
    from hiresight.sources import store as st

    data = scratch_dir("data-")
    run_full(spark, raw_root, data, "2025-01-20")
    run_full(spark, raw_root, data, "2025-01-27")
    run_full(spark, raw_root, data, "2025-01-27")     # rerun: idempotent
    assert st.read_jobs(spark, f"{data}/staged/jobs").count() == 3
    snap = st.read_snapshot(spark, f"{data}/staged/latest").collect()
    assert len(snap) == 2 and {str(r["run_date"]) for r in snap if r["source"] == "greenhouse"} == {"2025-01-27"}
    summary = spark.read.option("header", True).csv(f"{data}/exports/summary_stats_2025-01-20").first()
    assert (summary["total_jobs"], summary["greenhouse_jobs"], summary["lever_jobs"]) == ("2", "1", "1")
    top = spark.read.option("header", True).csv(f"{data}/exports/top_skills_overall_2025-01-20").collect()
    assert {r["skill"] for r in top} == {"Python", "SQL"}
    assert st.export_run(spark, f"{data}/staged/jobs", "2025-01-20", f"{data}/export_csv") == 2
    assert spark.read.option("header", True).csv(f"{data}/export_csv").count() == 2
    assert st.export_run(spark, f"{data}/staged/jobs", "2024-01-01", f"{data}/export_none") == 0


def test_seed_readers(spark, tmp_path):
    from hiresight.sources import seeds
    from hiresight.dictionaries import load_taxonomy, SKILLS

    csv = tmp_path / "companies.csv"
    csv.write_text("company_name,careers_url,ats_type,is_portfolio,notes\n"
                   "Oak Bank,https://boards.greenhouse.io/oakbank,greenhouse,TRUE,x\n"
                   "Pine Depot,https://jobs.lever.co/pinedepot,lever,false,y\n"
                   "Nope,https://example.com/jobs,greenhouse,,z\n"
                   "Odd,https://example.com,workday,false,\n")
    df = seeds.seed_identifiers(seeds.read_company_seeds(spark, str(csv)))
    rows = [(r["company_name"], r["is_portfolio"], r["identifier"], r["error"]) for r in df.collect()]
    assert rows[0] == ("Oak Bank", True, "oakbank", None)
    assert rows[1] == ("Pine Depot", False, "pinedepot", None)
    assert rows[2][3] == "greenhouse_token_missing" and rows[2][1] is False
    assert rows[3][3] == "ats_unsupported"
    assert seeds.first_n(seeds.read_company_seeds(spark, str(csv)), 2).count() == 2
    yml = tmp_path / "disc.yml"
    yml.write_text("domains:\n  - domain: oakbank.example\n    company_name: Oak Bank\nknown_careers_urls:\n  - https://jobs.lever.co/pinedepot\n")
    doms, urls = seeds.read_discovery_seeds(spark, str(yml))
    assert doms.first()["domain"] == "oakbank.example" and urls.count() == 1
    tax = tmp_path / "skills.yml"
    tax.write_text("skills:\n  langs:\n    - Python\n    - Go\n")
    assert load_taxonomy(str(tax), "skills", SKILLS) == (("langs", ("Python", "Go")),)
    assert load_taxonomy(str(tmp_path / "missing.yml"), "skills", SKILLS) is SKILLS


def test_parse_date_forms(spark):
    from hiresight.operators.canonical import parse_date
    vals = ["2025-01-15T10:00:00Z", "2025-01-15T23:30:00-05:00", "2025-01-15", "2025-01-15 10:00",
            "2025-01-15x10:00", "20250115", "20250115T100000", "1736503200000", "2025-13-01", "soon", "", None,
            "2025-01-15T10:00:00Z junk", "2025-01-06T99:99:99", "2025-01-06T23:60:00", "1736503200", "2025-01-06T10:00:00+25:00"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i long, x string")
    got = [None if r[0] is None else str(r[0]) for r in df.orderBy("i").select(parse_date("x")).collect()]
    assert got == ["2025-01-15", "2025-01-15", "2025-01-15", "2025-01-15", "2025-01-15", "2025-01-15",
                   "2025-01-15", "2025-01-10", None, None, None, None, None, None, None, None, None]


def test_epoch_wins_over_basic_date(spark):
    from hiresight.operators.canonical import parse_date
    df = spark.createDataFrame([("1737072000000",)], "x string")
    assert str(df.select(parse_date("x")).first()[0]) == "2025-01-17"


def test_discovery_output(spark):
    from hiresight.operators import discovery
    from hiresight.sources import store as st

    urls = spark.createDataFrame([("https://boards.greenhouse.io/oak-bank",), ("https://jobs.lever.co/pinedepot",),
                                  ("https://example.com/careers",)], "url string")
    found = discovery.discover_from_urls(urls)
    rows = sorted((r["company_name"], r["ats_type"], r["confidence"]) for r in found.collect())
    assert rows == [("Oak Bank", "greenhouse", 0.95), ("Pinedepot", "lever", 0.95)]
    seeds = spark.createDataFrame([("https://Oakbank.example/", "Oak Bank")], "domain string, company_name string")
    probes = spark.createDataFrame([("https://boards.greenhouse.io/oakbankexample", 404), ("https://boards.greenhouse.io/oakbank", 200)],
                                   "url string, status int")
    hit = discovery.first_board_hit(seeds, probes)
    out = discovery.discovered_companies(hit, found)
    assert out.columns == discovery.DISCOVERED and out.count() == 3
    assert hit.first()["careers_url"] == "https://boards.greenhouse.io/oakbank"
    assert {r["company_domain"] for r in out.collect()} == {"oakbank.example", None}
    path = os.path.join(scratch_dir("disc-"), "discovered")
    st.write_discovered(out, path)
    assert spark.read.option("header", True).csv(path).count() == 3


def test_incremental_snapshot_equals_full_rebuild(spark, raw_root):
    from hiresight.plans.jobs import run_build, run_latest, run_latest_incremental
    from hiresight.sources import store as st

    data = scratch_dir("snap-")
    jobs = f"{data}/jobs"
    for d in ("2025-01-20", "2025-01-27"):
        run_build(spark, raw_root, jobs, f"{data}/rejects", d)
        last = run_latest_incremental(spark, jobs, f"{data}/latest", d)
    run_latest(spark, jobs, f"{data}/full")
    cols = ["job_key", "run_date", "source", "title"]
    inc = sorted(tuple(r) for r in st.read_snapshot(spark, last).select(*cols).collect())
    full = sorted(tuple(r) for r in st.read_snapshot(spark, f"{data}/full").select(*cols).collect())
    assert inc == full and len(inc) == 2


def test_rebuilt_dates_leave_nothing_stale(spark, raw_root):
    path, rej = os.path.join(scratch_dir("stale-"), "jobs"), os.path.join(scratch_dir("stale-"), "rejects")
    canon = canonicalize(landing.read_raw_postings(spark, raw_root))
    jobs, bad = build_jobs(landing.read_raw_postings(spark, raw_root)), rejects(canon)
    dates = ["2025-01-20", "2025-01-27"]
    store.write_jobs(jobs, path, dates)
    store.write_rejects(bad, rej, dates)
    assert store.read_jobs(spark, path).count() == 3
    store.write_jobs(jobs.where("source = 'lever'"), path, ["2025-01-20"])      # one source gone
    assert [r["source"] for r in store.read_jobs(spark, path, run_date="2025-01-20").collect()] == ["lever"]
    assert store.read_jobs(spark, path, run_date="2025-01-27").count() == 1
    store.write_jobs(jobs.limit(0), path, ["2025-01-20"])                       # no rows at all
    assert store.read_jobs(spark, path, run_date="2025-01-20").count() == 0
    read = lambda: store.read_rejects(spark, rej)
    assert read().count() == 2
    store.write_rejects(bad.limit(0), rej, ["2025-01-20"])
    assert read().count() == 0


def test_corrupt_files_are_listed(spark):
    root = scratch_dir("corrupt-")
    land(root, "2025-03-03", "greenhouse", "Good", [GH])
    os.makedirs(os.path.join(root, "2025-03-03", "lever", "bad"))
    with open(os.path.join(root, "2025-03-03", "lever", "bad", "jobs.json"), "w") as f:
        f.write('{"company_name": "Bad", "jobs": [')
    env = landing.read_envelopes(spark, root)
    assert [r["file_path"].split("/")[-2] for r in landing.corrupt_files(env).collect()] == ["bad"]
    assert landing.read_raw_postings(spark, root).count() == 1


def test_latest_ignores_null_recency(spark):
    df = spark.createDataFrame([("k", "2025-01-01", 1), ("k", None, 2), ("n", None, 3)], "job_key string, d string, v int").withColumn("d", F.col("d").cast("date"))
    got = {r["job_key"]: r["v"] for r in dedupe.latest_per_key(df, ["job_key"], ["d"], [F.col("v")]).collect()}
    assert got == {"k": 1, "n": 3}


def test_probe_and_seed_outcomes(spark):
    from hiresight.operators import discovery, metrics
    pages = spark.createDataFrame([("https://x.example/a/1", 0), ("https://x.example/a/2", 200), ("https://x.example/b", 404)], "url string, probe_status int")
    assert {r["url"][-1]: r["status"] for r in discovery.probe_results(pages).collect()} == {"a": 200, "b": 404}
    seeds = spark.createDataFrame([("u", None), ("https://jobs.lever.co/oak", "lever"), ("u", "lever"), ("https://boards.greenhouse.io/pine", "greenhouse")], "careers_url string, ats_type string")
    got = {r["ats_type"]: tuple(r)[1:] for r in metrics.seed_outcomes(seeds).collect()}
    assert got == {None: (1, 1, 0, 1), "lever": (2, 1, 1, 0), "greenhouse": (1, 1, 0, 0)}
    jobs = spark.createDataFrame([("https://jobs.lever.co/oak/1",), ("https://jobs.lever.co/oak/2",)], "job_url string")
    got = {r["ats_type"]: tuple(r)[1:] for r in metrics.ingest_summary(seeds, jobs).collect()}
    assert got == {None: (1, 1, 0, 1, 0), "lever": (2, 1, 1, 0, 2), "greenhouse": (1, 1, 0, 1, 0)}


def test_jobs_per_capita(spark):
    from hiresight.operators import trends
    jobs = spark.createDataFrame([("2025-01-06", s) for s in ("CO", "CO", "TN", None, "ZZ")], "run_date string, state string")
    people = spark.createDataFrame([("CO", 4_000_000), ("TN", 500_000), ("OR", 1)], "state string, population long")
    got = {r["state"]: r["jobs_per_million"] for r in trends.jobs_per_capita(jobs, people).collect()}
    assert got == {"CO": 0.5, "TN": 2.0}


def test_late_rebuild_mends_later_snapshots(spark):
    from hiresight.plans.jobs import run_build, run_latest, run_latest_incremental

    root, data = scratch_dir("late-"), scratch_dir("latesnap-")
    jobs = f"{data}/jobs"
    land(root, "2025-01-20", "greenhouse", "Oak", [GH])
    land(root, "2025-01-27", "greenhouse", "Oak", [dict(GH, id=2)])
    for d in ("2025-01-20", "2025-01-27"):
        run_build(spark, root, jobs, f"{data}/rejects", d)
        run_latest_incremental(spark, jobs, f"{data}/latest", d)
    land(root, "2025-01-20", "lever", "Oak", [LV])                              # a late file
    run_build(spark, root, jobs, f"{data}/rejects", "2025-01-20")
    run_latest_incremental(spark, jobs, f"{data}/latest", "2025-01-20")
    run_latest(spark, jobs, f"{data}/full")
    keys = lambda p: sorted(r["job_key"] for r in store.read_snapshot(spark, p).collect())
    assert keys(f"{data}/latest/version=2025-01-27") == keys(f"{data}/full") and len(keys(f"{data}/full")) == 3


def test_bodies_stay_out_of_the_dedupe_aggregate(spark, raw_root):
    plan = build_jobs(landing.read_raw_postings(spark, raw_root))._jdf.queryExecution().executedPlan().toString()
    aggregates = [line for line in plan.split("\n") if "Aggregate(" in line]
    assert aggregates and not any("description" in line or "content" in line for line in aggregates)
