from datetime import date

import pytest
from pyspark.sql import functions as F

from hiresight.operators import trends

DAYS = [date(2025, 1, d) for d in (6, 13, 20)]
ROWS = [("a", 0, ["x", "y"], "Data"), ("a", 0, [], None), ("a", 2, ["x"], "Data"), ("b", 1, ["y"], "Data"), (None, 1, ["x", "x"], "Sales"), ("b", None, ["z"], "Data")]
SCHEMA = "company_id string, run_date date, skills array<string>, role_family string"


def jobs(spark):
    return spark.createDataFrame([(c, None if d is None else DAYS[d], s, f) for c, d, s, f in ROWS], SCHEMA).coalesce(1)


@pytest.mark.parametrize("report", [trends.skill_growth, trends.hiring_velocity, trends.role_mix_shift])
def test_the_history_is_built_once(spark, report):
    built = spark.sparkContext.accumulator(0)

    @F.udf("date")
    def seen(d):
        built.add(1)
        return d

    got = report(jobs(spark).withColumn("run_date", seen("run_date"))).collect()
    assert built.value == len(ROWS)
    assert sorted(map(str, got)) == sorted(map(str, report(jobs(spark)).collect()))


def test_velocity_is_against_the_run_before(spark):
    got = sorted(((r["company_id"], str(r["run_date"]), r["job_count"], r["prev_job_count"], r["change"]) for r in trends.hiring_velocity(jobs(spark)).collect()), key=str)
    a, b, c = map(str, DAYS)
    # a run of none is a run too, the first; it has no run before, and nothing is shifted to it
    assert ("a", a, 2, 0, 2) in got and ("a", b, 0, 2, -2) in got and ("a", c, 1, 0, 1) in got
    assert ("b", b, 1, 0, 1) in got and ("b", c, 0, 1, -1) in got and all(r[0] for r in got)
