"""Stable SHA-256 keys for companies and postings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col, strip_ws


def generate_hash(*parts: Column | str) -> Column:
    """Hex SHA-256 of the parts joined by ``|`` (UTF-8)."""
    cols = [_col(p) for p in parts]
    data = cols[0] if len(cols) == 1 else F.concat_ws("|", *cols)
    return F.sha2(data, 256)


def _norm(c: Column | str) -> Column:
    return strip_ws(F.lower(_col(c)))


def generate_company_id(name: Column | str, domain: Column | str | None = None) -> Column:
    """First 16 hex chars of hash(lower(strip(name)) [| lower(strip(domain))])."""
    key = _norm(name)
    if domain is not None:
        d = _col(domain)
        key = F.when(d.isNotNull() & (d != ""), F.concat(key, F.lit("|"), _norm(d))).otherwise(key)
    return F.substring(F.sha2(key, 256), 1, 16)


def generate_job_key(
    source: Column | str, company: Column | str, job_id: Column | str, title: Column | str
) -> Column:
    """``{source}_{hash(company)[:8]}_{hash(id|title)[:8]}``; a retitled
    posting gets a new key."""
    company_hash = F.substring(F.sha2(_norm(company), 256), 1, 8)
    job_hash = F.substring(generate_hash(strip_ws(_col(job_id)), _norm(title)), 1, 8)
    return F.concat(_col(source), F.lit("_"), company_hash, F.lit("_"), job_hash)
