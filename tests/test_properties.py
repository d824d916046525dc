"""Property tests: invariants that must hold for any input."""
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hiresight.functions import text
from hiresight.operators import dedupe, trends

SETTINGS = dict(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
texts = st.text(alphabet=st.sampled_from(list("ab <>/\t\n\x1d\xa0é-_")), max_size=30)


@settings(**SETTINGS)
@given(st.lists(texts, min_size=1, max_size=8))
def test_clean_text_is_idempotent_and_normalised(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    once = df.select(text.clean_text("x").alias("c"))
    rows = once.select("c", text.clean_text("c").alias("cc")).collect()
    for c, cc in rows:
        assert c == cc
        assert "  " not in c and c == c.strip(" ")


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 10**6)), min_size=1, max_size=40, unique_by=lambda r: r[1]))
def test_keep_first_is_partitioning_invariant(spark, rows):
    df = spark.createDataFrame(rows, "k int, pos long")
    expect = {k: min(p for kk, p in rows if kk == k) for k, _ in rows}
    for parts in (1, 3):
        got = dedupe.keep_first(df.repartition(parts), ["k"], [F.col("pos")]).collect()
        assert {r["k"]: r["pos"] for r in got} == expect


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.sampled_from(["Technology", "Healthcare"]), st.sampled_from(["Sales", "Data/AI", "Finance"])),
                min_size=1, max_size=30))
def test_industry_shares_sum_to_one(spark, rows):
    df = spark.createDataFrame([("2025-01-06", i, r) for i, r in rows], "run_date string, industry_tag string, role_family string") \
        .withColumn("run_date", F.col("run_date").cast("date"))
    out = trends.industry_share(df)
    sums = out.groupBy("industry_tag").agg(F.sum("share_of_industry").alias("s")).collect()
    assert all(abs(r["s"] - 1.0) < 1e-9 for r in sums)
    total = out.select("industry_tag", "industry_share_of_run").distinct().agg(F.sum("industry_share_of_run")).first()[0]
    assert abs(total - 1.0) < 1e-9


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.sampled_from(["r1", "r2"]), st.text(alphabet="abcdef", min_size=1, max_size=3), st.integers(1, 5)),
                min_size=1, max_size=60, unique_by=lambda r: (r[0], r[1])))
def test_two_stage_top_n_equals_single_window(spark, rows):
    from hiresight.operators.metrics import rank_within, top_n
    df = spark.createDataFrame(rows, "run_date string, company_name string, job_count long")
    order = [F.desc("job_count"), F.asc("company_name")]
    a = sorted(tuple(r) for r in rank_within(df, ["run_date"], order, 3).collect())
    b = sorted(tuple(r) for r in top_n(df, ["run_date"], order, 3, ["company_name"], buckets=4).collect())
    assert a == b
