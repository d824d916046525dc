"""Source registry, per-posting rescue, and versioned dates."""
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import scratch_dir
from hiresight.operators.canonical import canonical_rows, canonicalize, rejects, valid_jobs
from hiresight.plans.jobs import run_build
from hiresight.sources import files, landing, registry, store, versions
from hiresight.streaming.landing_stream import run_incremental_build
from test_pipeline import GH, LV, land

# a third system: other field names, and `location` is a string there
TALENTO = registry.JobSource(
    "talento",
    registry.struct_of("code", "role", "text", "location", "opened", contract=registry.struct_of("kind"), tags=T.ArrayType(T.StringType())),
    {"source_job_id": "code", "title": "role", "body": "text", "location_raw": "location", "posted": "opened",
     "employment_type": "contract.kind", "department": "try_element_at(tags, 1)", "job_url": "concat('https://jobs.talento.example/', code)"})
ALL = registry.sources(registry.GREENHOUSE, registry.LEVER, TALENTO)
TA = {"code": "T-9", "role": "Depot Clerk", "text": "Count <b>boxes</b> with SQL.", "location": "Raleigh, NC", "opened": "2025-01-11",
      "contract": {"kind": "Permanent"}, "tags": ["Depots", "x"]}


def test_third_source_needs_no_library_change(spark):
    root, out = scratch_dir("third-"), scratch_dir("third-out-")
    land(root, "2025-01-20", "greenhouse", "Oak", [GH])
    land(root, "2025-01-20", "talento", "Oak", [TA, dict(TA, code=None), dict(TA, code="T-2", location="Lyon, France")])
    run_build(spark, root, f"{out}/jobs", f"{out}/rejects", "2025-01-20", sources=ALL)
    rows = {r["source"]: r for r in store.read_jobs(spark, f"{out}/jobs").collect()}
    assert set(rows) == {"greenhouse", "talento"}
    t = rows["talento"]
    assert (t["source_job_id"], t["title"], t["description"], t["department"], t["employment_type"]) == ("T-9", "Depot Clerk", "Count boxes with SQL.", "Depots", "Permanent")
    assert (t["state"], t["city"], str(t["date_posted"]), t["job_url"], t["skills"]) == ("NC", "Raleigh", "2025-01-11", "https://jobs.talento.example/T-9", ["SQL"])
    bad = sorted((r["source"], r["reason"]) for r in store.read_rejects(spark, f"{out}/rejects").collect())
    assert bad == [("talento", "Failed US location validation"), ("talento", "Transform error: missing id")]
    # the default registry does not know the third source
    assert {r["source"] for r in landing.read_drafts(spark, root, "2025-01-20").collect()} == {"greenhouse"}
    assert landing.read_drafts(spark, root, "1999-01-01").count() == 0


def test_stream_takes_the_third_source(spark):
    root, out = scratch_dir("third-"), scratch_dir("third-out-")
    land(root, "2025-01-20", "talento", "Oak", [TA])
    land(root, "2025-01-27", "lever", "Oak", [LV])
    run_incremental_build(spark, root, f"{out}/jobs", f"{out}/ckpt", sources=ALL)
    assert sorted(r["source"] for r in store.read_jobs(spark, f"{out}/jobs").collect()) == ["lever", "talento"]
    # both dates came from one pass, and nothing staged is left
    assert len(files.folders(spark, f"{out}/jobs/data")) == 1 and files.folders(spark, f"{out}/jobs_staged") == []


def test_shared_and_own_drafts_agree(spark):
    root = scratch_dir("drafts-")
    land(root, "2025-01-20", "greenhouse", "Oak", [GH, dict(GH, id=5, content="", description="plain")])
    land(root, "2025-01-20", "lever", "Oak", [LV])
    own = canonical_rows(landing.read_drafts(spark, root)).collect()
    shared = canonicalize(landing.read_raw_postings(spark, root)).collect()
    assert sorted(map(str, own)) == sorted(map(str, shared)) and len(own) == 3


def test_registry_refuses_what_cannot_work():
    with pytest.raises(ValueError, match="two sources"):
        registry.sources(registry.LEVER, registry.LEVER)
    with pytest.raises(ValueError, match="location is string"):
        registry.posting_schema(ALL)
    with pytest.raises(ValueError, match="draft fields"):
        registry.JobSource("x", registry.struct_of("a"), {"source_job_id": "a", "salary": "a"})
    with pytest.raises(ValueError, match="posting id"):
        registry.JobSource("x", registry.struct_of("a"), {"title": "a"})
    with pytest.raises(ValueError, match="rename"):
        registry.JobSource("x", registry.struct_of("pos"), {"source_job_id": "pos"})


def test_one_bad_posting_spoils_no_other(spark):
    root = scratch_dir("bad-")
    odd = dict(GH, id=8, location="Denver, CO")              # a string where an object belongs
    land(root, "2025-03-03", "greenhouse", "Oak", [GH, odd, None, 7, dict(GH, id=9)])
    os.makedirs(os.path.join(root, "2025-03-03", "lever", "bad"))
    with open(os.path.join(root, "2025-03-03", "lever", "bad", "jobs.json"), "w") as f:
        f.write('{"company_name": "Bad", "jobs": [')
    for partitions in (None, 3):
        canon = canonical_rows(landing.read_drafts(spark, root, partitions=partitions))
        assert sorted(r["source_job_id"] for r in valid_jobs(canon).collect()) == ["70411", "9"]
        bad = [(r["reason"], r["source_job_id"]) for r in rejects(canon).collect()]
        assert sorted(bad) == [("Transform error: malformed posting", "8"), *[("Transform error: malformed posting", "unknown")] * 2]
    assert landing.corrupt_files(landing.read_envelopes(spark, root)).count() == 1
    assert landing.envelope_stats(spark, root).collect()[0]["postings"] == 5


def _jobs(spark, rows):
    df = spark.createDataFrame(rows, "run_date string, source string, v long")
    return df.withColumn("run_date", F.col("run_date").cast("date"))


SCHEMA = T.StructType([T.StructField("run_date", T.DateType()), T.StructField("source", T.StringType()), T.StructField("v", T.LongType())])


def _write(df, path, dates=None):
    versions.replace_dates(df, path, dates, lambda w, to: w.parquet(to), by=("source",))


def _read(spark, path, keep=lambda d: True):
    return sorted((str(r["run_date"]), r["source"], r["v"]) for r in versions.read_dates(spark, path, SCHEMA, keep).collect())


def test_a_write_that_dies_leaves_the_old_rows(spark):
    path = scratch_dir("versions-") + "/t"
    _write(_jobs(spark, [("2025-01-06", "a", 1), ("2025-01-13", "a", 2)]), path)
    boom = F.udf(lambda v: 1 // 0, "long")
    with pytest.raises(Exception, match="ZeroDivisionError"):
        _write(_jobs(spark, [("2025-01-06", "a", 9)]).withColumn("v", boom("v")), path, ["2025-01-06"])
    assert _read(spark, path) == [("2025-01-06", "a", 1), ("2025-01-13", "a", 2)]
    # a swap that died midway is skipped, and the next one goes past it
    assert files.create_text(spark, f"{path}/_manifest/000000000002.json", '{"dates": {"2025-01-06"')
    assert _read(spark, path) == [("2025-01-06", "a", 1), ("2025-01-13", "a", 2)]
    _write(_jobs(spark, [("2025-01-06", "b", 3)]), path, ["2025-01-06"])
    assert _read(spark, path) == [("2025-01-06", "b", 3), ("2025-01-13", "a", 2)]
    assert files.names(spark, f"{path}/_manifest")[-1] == "000000000003.json"


def test_dates_are_replaced_as_a_whole(spark):
    path = scratch_dir("versions-") + "/t"
    rows = _jobs(spark, [("2025-01-06", "a", 1), ("2025-01-13", "a", 2), ("2025-01-20", "a", 3)])
    _write(rows, path, ["2025-01-06", "2025-01-13"])                # rows of other dates stay out
    assert _read(spark, path) == [("2025-01-06", "a", 1), ("2025-01-13", "a", 2)]
    _write(rows.limit(0), path, ["2025-01-06"])                     # a date that became empty
    assert _read(spark, path) == [("2025-01-13", "a", 2)]
    _write(rows, path)                                              # the dates that have rows
    assert len(_read(spark, path)) == 3 and _read(spark, path, lambda d: d > "2025-01-13") == [("2025-01-20", "a", 3)]
    assert versions.read_dates(spark, path + "/none", SCHEMA).count() == 0
    # only the chosen dates' folders are read
    got = versions.read_dates(spark, path, SCHEMA, lambda d: d == "2025-01-20")
    assert len(got.inputFiles()) == 1


def test_two_writers_lose_no_date(spark):
    path = scratch_dir("versions-") + "/t"
    versions.publish(spark, path, {"2025-01-06": "v1"})
    versions.publish(spark, path, {"2025-01-13": "v2"})
    assert not files.create_text(spark, f"{path}/_manifest/000000000002.json", "{}")        # taken
    assert versions.current(spark, path) == {"2025-01-06": "v1", "2025-01-13": "v2"}
    plain = scratch_dir("plain-")
    os.makedirs(f"{plain}/run_date=2025-01-06")
    with pytest.raises(ValueError, match="without a manifest"):
        _write(_jobs(spark, [("2025-01-06", "a", 1)]), plain)


def test_unread_versions_can_be_removed(spark):
    path = scratch_dir("versions-") + "/t"
    for k in range(4):
        _write(_jobs(spark, [("2025-01-06", "a", k)]), path)
    assert versions.remove_unread(spark, path) == []                # all younger than a day
    assert len(versions.remove_unread(spark, path, older_than_hours=-1, manifests=2)) == 2
    assert _read(spark, path) == [("2025-01-06", "a", 3)] and len(files.folders(spark, f"{path}/data")) == 2
    with open(f"{path}/_manifest/000000000004.json") as f:
        assert set(json.load(f)["dates"]) == {"2025-01-06"}
