import os

from conftest import scratch_dir
from hiresight.sources import store
from hiresight.streaming.landing_stream import run_incremental_build
from test_pipeline import GH, LV, land


def test_incremental_build_rebuilds_touched_dates(spark):
    root, out = scratch_dir("land-"), scratch_dir("out-")
    jobs, ckpt = os.path.join(out, "jobs"), os.path.join(out, "ckpt")
    land(root, "2025-02-03", "greenhouse", "Acme Software", [GH])
    run_incremental_build(spark, root, jobs, ckpt)
    assert store.read_jobs(spark, jobs).count() == 1

    # A late file for the same date and a new date arrive.
    land(root, "2025-02-03", "lever", "Acme Software", [LV])
    land(root, "2025-02-10", "greenhouse", "Acme Software", [GH, dict(GH, id=7)])
    run_incremental_build(spark, root, jobs, ckpt)
    got = store.read_jobs(spark, jobs).groupBy("run_date").count().orderBy("run_date").collect()
    assert [(str(r[0]), r[1]) for r in got] == [("2025-02-03", 2), ("2025-02-10", 2)]

    # Nothing new: a rerun changes nothing.
    run_incremental_build(spark, root, jobs, ckpt)
    assert store.read_jobs(spark, jobs).count() == 4
