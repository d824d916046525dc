"""Aggregate facts of the runs: the postings without texts and keys, counted.

One row stands for ``n_jobs`` postings of a run that agree in every dimension
that a report groups or filters by. The reports of ``metrics`` and ``trends``
take facts in place of postings and give the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import CANONICAL
from .metrics import JOBS, RUN

DIMENSIONS = (RUN, "source", "company_id", "company_name", "role_family", "industry_tag", "state", "city", "is_remote", "skills")
FACTS = T.StructType([*(CANONICAL[d] for d in DIMENSIONS), T.StructField(JOBS, T.LongType())])


def job_facts(jobs: DataFrame) -> DataFrame:
    return jobs.groupBy(*DIMENSIONS).agg(F.count(F.lit(1)).alias(JOBS))
