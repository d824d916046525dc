"""Declared schemas. Nothing is inferred at read time."""

from __future__ import annotations

from pyspark.sql import types as T

S, B, D, TS, L, DB = (T.StringType(), T.BooleanType(), T.DateType(),
                      T.TimestampType(), T.LongType(), T.DoubleType())


def _f(name, dtype, nullable=True):
    return T.StructField(name, dtype, nullable)


# One landed file: raw/{run_date}/{source}/{company_id}/jobs.json. Its ``jobs``
# are an array of the source's postings (``sources.registry``).
RAW_ENVELOPE = T.StructType([
    _f("company_name", S),
    _f("source", S),
    _f("identifier", S),
    _f("extracted_at", S),
    _f("job_count", L),
])

CANONICAL = T.StructType([
    _f("source", S, False),
    _f("source_job_id", S, False),
    _f("job_url", S, False),
    _f("company_name", S, False),
    _f("company_domain", S),
    _f("company_id", S, False),
    _f("title", S, False),
    _f("description", S, False),
    _f("department", S),
    _f("employment_type", S),
    _f("seniority", S),
    _f("location_raw", S, False),
    _f("city", S),
    _f("state", S),
    _f("postal_code", S),
    _f("msa", S),
    _f("is_remote", B, False),
    _f("country", S, False),
    _f("date_posted", D),
    _f("date_scraped", TS, False),
    _f("role_family", S),
    _f("skills", T.ArrayType(S, False), False),
    _f("industry_tag", S),
    _f("run_date", D, False),
    _f("job_key", S, False),
])
CANONICAL_COLUMNS = [f.name for f in CANONICAL.fields]

REJECT = T.StructType([
    _f("company_name", S),
    _f("source", S),
    _f("source_job_id", S),
    _f("reason", S),
    _f("raw_location", S),
])

COMPANY_SEED = T.StructType([
    _f("company_name", S),
    _f("careers_url", S),
    _f("ats_type", S),
    _f("is_portfolio", S),
    _f("notes", S),
])

DISCOVERED_COMPANY = T.StructType([
    _f("company_name", S),
    _f("company_domain", S),
    _f("careers_url", S),
    _f("ats_type", S),
    _f("discovery_method", S),
    _f("discovered_at", TS),
    _f("confidence", DB),
])
