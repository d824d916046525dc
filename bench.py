"""Benchmark: headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Prints one JSON line:
{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

``write_history`` is the build stage (postings -> canonical -> dedupe ->
enrichment) written as Parquet to a scratch folder, as the stored history would
be; the report queries read that store. All other queries start from the
tables. Every result is fully computed with a no-op sink (nothing is collected
to the driver).
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from hiresight.plans import pipeline  # noqa: E402
from hiresight.plans.queries import QUERIES, REPORTS  # noqa: E402
from hiresight.session import local_session  # noqa: E402
from hiresight.sources import store  # noqa: E402

FROM_TABLES = ["canonical_jobs", "us_rejects", "parse_location_strict", "clean_text_pages", "keyword_counts",
               "role_family", "industry_tag", "skills", "dedupe_first", "events_latest", "first_board_hit", "verified_boards"]
FROM_HISTORY = ["top_skills", "skills_by_role_family", "skills_by_state", "role_mix_by_industry", "summary_stats",
                "skill_metric_sets", "new_vs_existing_by_run", "jobs_growth", "skill_growth", "hiring_velocity",
                "role_mix_shift", "state_hhi", "top_skills_per_family", "skill_family_matrix", "industry_share"]


def run(df) -> float:
    t = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, shuffle_partitions=4 * cpus, driver_memory="16g",
                          extra={"spark.ui.showConsoleProgress": "false"})
    def measure(sf: str, store_path: str) -> dict[str, float]:
        times: dict[str, float] = {}
        t = time.perf_counter()
        # the test tables are one row group each: spread them over the cores
        store.write_jobs(pipeline.jobs_history(spark, sf, partitions=2 * cpus), store_path)
        times["write_history"] = time.perf_counter() - t
        for name in FROM_TABLES:
            times[name] = run(QUERIES[name](spark, sf))
        history = store.read_jobs(spark, store_path)
        for name in FROM_HISTORY:
            times[name] = run(REPORTS[name](history))
        return times

    scratch = tempfile.mkdtemp(prefix="bench-")
    warm = "/root/testdata/sf0.001"
    if os.path.isdir(warm):  # compile once on the smallest tables (not timed)
        measure(warm, f"{scratch}/warm")
    times = measure(sf_dir, f"{scratch}/jobs")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
