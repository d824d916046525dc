"""Every registered query agrees with its SQL oracle on the smallest tables."""
import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="generated test data not present")
def test_all_queries_match_oracles(spark):
    import duckdb
    import __spark_entry__ as E
    from check_oracle import TABLES, rows_of

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    from conftest import scratch_dir
    from hiresight.plans import pipeline
    from hiresight.plans.queries import QUERIES, REPORTS
    from hiresight.sources import store

    oracles = E.oracle_sql()
    bad = []
    # reports run over the stored history, as in use; all other queries from the tables
    path = os.path.join(scratch_dir("history-"), "jobs")
    store.write_jobs(pipeline.jobs_history(spark, SF), path)
    history = store.read_jobs(spark, path)
    for name, fn in QUERIES.items():
        df = REPORTS[name](history) if name in REPORTS else fn(spark, SF)
        s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
        res = con.execute(oracles[name])
        d_cols, d_rows = [d[0] for d in res.description], res.fetchall()
        if sorted(s_cols) != sorted(d_cols) or rows_of(s_cols, s_rows) != rows_of(d_cols, d_rows):
            bad.append(name)
    assert not bad


def test_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() >= 0 and "skill" in df.columns


def test_every_query_has_an_oracle():
    import __spark_entry__ as E
    from hiresight.plans.queries import QUERIES

    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())
    assert len(QUERIES) >= 69
