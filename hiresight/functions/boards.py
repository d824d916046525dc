"""Job-board URL recognition (Greenhouse / Lever) as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..dictionaries import GREENHOUSE_HOST, LEVER_HOST
from .text import _col, strip_ws

GREENHOUSE_TOKEN = r"boards\.greenhouse\.io/([a-zA-Z0-9_-]+)"
LEVER_TOKEN = r"jobs\.lever\.co/([a-zA-Z0-9_-]+)"


def is_greenhouse_url(url: Column | str) -> Column:
    return F.coalesce(F.lower(_col(url)).contains(GREENHOUSE_HOST), F.lit(False))


def is_lever_url(url: Column | str) -> Column:
    # 'lever.co' also matches e.g. clever.com, as in the original.
    return F.coalesce(F.lower(_col(url)).contains(LEVER_HOST), F.lit(False))


def greenhouse_token(url: Column | str) -> Column:
    """Board token after ``boards.greenhouse.io/`` (case-sensitive host)."""
    return F.nullif(F.regexp_extract(_col(url), GREENHOUSE_TOKEN, 1), F.lit(""))


def lever_company(url: Column | str) -> Column:
    return F.nullif(F.regexp_extract(_col(url), LEVER_TOKEN, 1), F.lit(""))


def title_case(c: Column | str) -> Column:
    """Python ``str.title`` for ASCII text: every letter run is capitalised."""
    runs = F.regexp_extract_all(_col(c), F.lit("[a-zA-Z]+|[^a-zA-Z]+"), 0)
    return F.array_join(
        F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.lower(F.substring(r, 2, 1 << 30)))),
        "",
    )


def name_from_token(token: Column | str) -> Column:
    return title_case(F.replace(_col(token), F.lit("-"), F.lit(" ")))


def detect_ats(url: Column | str) -> Column:
    """``greenhouse`` / ``lever`` when the URL is a board URL with an
    identifier (Greenhouse checked first), else null."""
    u = _col(url)
    return (
        F.when(is_greenhouse_url(u) & greenhouse_token(u).isNotNull(), F.lit("greenhouse"))
        .when(is_lever_url(u) & lever_company(u).isNotNull(), F.lit("lever"))
    )


def board_identifier(url: Column | str, ats: Column | str | None = None) -> Column:
    u = _col(url)
    a = detect_ats(u) if ats is None else _col(ats)
    return F.when(a == "greenhouse", greenhouse_token(u)).when(a == "lever", lever_company(u))


def identifier_error(url: Column | str, ats_type: Column | str) -> Column:
    """Reason code when no identifier can be taken from a careers URL for a
    declared ATS type, or null when one can."""
    u, a = _col(url), _col(ats_type)
    return (
        F.when(u.isNull() | (u == ""), F.lit("url_missing"))
        .when(a == "greenhouse",
              F.when(greenhouse_token(u).isNull(), F.lit("greenhouse_token_missing")))
        .when(a == "lever",
              F.when(lever_company(u).isNull(), F.lit("lever_company_missing")))
        .otherwise(F.lit("ats_unsupported"))
    )


def greenhouse_job_url(token: Column | str, job_id: Column | str) -> Column:
    return F.concat(F.lit("https://boards.greenhouse.io/"), _col(token), F.lit("/jobs/"), _col(job_id))


def lever_job_url(company: Column | str, job_id: Column | str) -> Column:
    return F.concat(F.lit("https://jobs.lever.co/"), _col(company), F.lit("/"), _col(job_id))


def clean_domain(domain: Column | str) -> Column:
    """lower + strip, drop every ``http(s)://``, strip trailing slashes."""
    d = strip_ws(F.lower(_col(domain)))
    d = F.when(d.startswith("http"), F.regexp_replace(d, "https?://", "")).otherwise(d)
    return F.regexp_replace(d, "/+$", "")


def candidate_urls(domain: Column | str, company_name: Column | str) -> Column:
    """The five probe URLs, in probe order."""
    d = F.replace(clean_domain(domain), F.lit("."), F.lit(""))
    name = F.lower(_col(company_name))
    squashed = F.replace(name, F.lit(" "), F.lit(""))
    dashed = F.replace(name, F.lit(" "), F.lit("-"))
    gh, lv = F.lit("https://boards.greenhouse.io/"), F.lit("https://jobs.lever.co/")
    return F.array(
        F.concat(gh, d), F.concat(gh, squashed), F.concat(lv, d), F.concat(lv, squashed), F.concat(lv, dashed)
    )
