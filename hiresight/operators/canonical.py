"""Raw board postings -> canonical job rows + reject rows.

One narrow pass: every source's postings are first drafted (``sources.registry``
knows the field mappings); location parsing, keys and the reject reason are
computed from the draft fields. Valid rows and rejects are two filters over
that result (callers that need both should write both from one staged table).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..dictionaries import COUNTRY, REJECT_NOT_US
from ..functions.keys import generate_company_id, generate_job_key
from ..functions.location import with_location
from ..functions.text import _col, clean_text
from ..schemas import CANONICAL_COLUMNS
from ..sources.registry import DEFAULT_SOURCES, Sources, shared_drafts

# ISO-8601 date or date-time (what datetime.fromisoformat accepts after 'Z'
# is turned into an offset). The calendar date is the text's own date.
# Any single character but a digit may separate date and time; the basic form
# (YYYYMMDD[Thhmmss]) is accepted as well.
_HOUR, _SIXTY = r"(?:[01]\d|2[0-3])", r"[0-5]\d"
_TIME = (rf"(?:\D{_HOUR}(?::?{_SIXTY}(?::?{_SIXTY}(?:[.,]\d{{1,9}})?)?)?"
         rf"(?:Z|[+-]{_HOUR}(?::?{_SIXTY}(?::?{_SIXTY}(?:\.\d{{1,6}})?)?)?)?)?$")
ISO_DATE_TIME = r"^\d{4}-\d{2}-\d{2}" + _TIME
ISO_BASIC_DATE_TIME = r"^\d{8}" + _TIME
EPOCH_MILLIS = r"^\d{13}$"


def metadata_value(metadata: Column | str, key: str) -> Column:
    """Value of the first ``{name, value}`` item whose name is ``key``."""
    hit = F.filter(_col(metadata), lambda m: m["name"] == F.lit(key))
    return F.try_element_at(hit, F.lit(1))["value"]


def parse_date(c: Column | str) -> Column:
    """Calendar date of an ISO date/date-time string in its own offset;
    13 digits are epoch milliseconds (UTC); anything else -> null."""
    s = _col(c)
    iso = F.when(s.rlike(ISO_DATE_TIME), F.try_to_date(F.substring(s, 1, 10), "yyyy-MM-dd"))
    basic = F.when(s.rlike(ISO_BASIC_DATE_TIME), F.try_to_date(F.substring(s, 1, 8), "yyyyMMdd"))
    # Whole-day arithmetic keeps the UTC date independent of the session zone.
    epoch = F.when(
        s.rlike(EPOCH_MILLIS),
        F.date_from_unix_date(F.floor(s.try_cast("bigint") / F.lit(86400000)).cast("int")),
    )
    return F.coalesce(iso, epoch, basic)


def canonicalize(raw: DataFrame, strict_us: bool = True, clean_description: bool = True,
                 sources: Sources = DEFAULT_SOURCES) -> DataFrame:
    """Map flattened raw postings to canonical columns plus ``reason``.

    Input columns: ``source, company_name, run_date, extracted_at, file_path,
    pos`` and the raw posting fields of ``sources``. Unknown sources are dropped
    (neither valid nor rejected).
    """
    return canonical_rows(shared_drafts(raw, sources), strict_us, clean_description)


def canonical_rows(drafts: DataFrame, strict_us: bool = True, clean_description: bool = True) -> DataFrame:
    """Canonical columns plus ``reason`` of drafted postings. ``reason`` is
    null for valid rows. ``file_path`` and ``pos`` are kept: they are the
    first-wins order for deduplication.

    ``clean_description=False`` leaves the posting body raw so that a caller
    can clean it later (the build cleans after its dedupe shuffle, where the
    work is evenly spread); apply ``clean_text`` to it before use.
    """
    staged = drafts.select(
        "source", "source_job_id", "job_url", "company_name",
        F.coalesce("title", F.lit("")).alias("title"),
        (clean_text("body") if clean_description else F.col("body")).alias("description"),
        "department", "employment_type",
        F.coalesce("location_raw", F.lit("")).alias("location_raw"),
        parse_date("posted").alias("date_posted"),
        F.coalesce(F.try_to_timestamp(F.col("extracted_at")), F.col("run_date").cast("timestamp")).alias("date_scraped"),
        "run_date", "file_path", "pos", "malformed",
    )
    staged = with_location(staged, "location_raw", strict=strict_us, prefix="loc_")
    staged_id = F.col("source_job_id")
    reason = (
        F.when(F.col("malformed"), F.lit("Transform error: malformed posting"))
        .when(staged_id.isNull(), F.lit("Transform error: missing id"))
        .when(~F.col("loc_is_us"), F.lit(REJECT_NOT_US))
    )
    return staged.select(
        "source", "source_job_id", "job_url", "company_name",
        F.lit(None).cast("string").alias("company_domain"),
        generate_company_id("company_name").alias("company_id"),
        "title", "description", "department", "employment_type",
        F.lit(None).cast("string").alias("seniority"),
        "location_raw",
        F.col("loc_city").alias("city"),
        F.col("loc_state").alias("state"),
        F.col("loc_postal_code").alias("postal_code"),
        F.lit(None).cast("string").alias("msa"),
        F.col("loc_is_remote").alias("is_remote"),
        F.lit(COUNTRY).alias("country"),
        "date_posted", "date_scraped",
        F.lit(None).cast("string").alias("role_family"),
        F.array().cast("array<string>").alias("skills"),
        F.lit(None).cast("string").alias("industry_tag"),
        "run_date",
        generate_job_key("source", "company_name", "source_job_id", "title").alias("job_key"),
        reason.alias("reason"),
        F.when(staged_id.isNotNull(), F.col("location_raw")).alias("raw_location"),
        "file_path", "pos",
    )


def valid_jobs(canon: DataFrame) -> DataFrame:
    """Rows that passed (canonical columns + order columns)."""
    return canon.where(F.col("reason").isNull()).select(*CANONICAL_COLUMNS, "file_path", "pos")


def rejects(canon: DataFrame, *keep: str) -> DataFrame:
    """Reject rows: company_name, source, source_job_id, reason, raw_location
    and run_date, after the columns ``keep``."""
    return canon.where(F.col("reason").isNotNull()).select(
        *keep,
        "company_name", "source",
        F.coalesce(F.col("source_job_id"), F.lit("unknown")).alias("source_job_id"),
        "reason", "raw_location", "run_date",
    )


def reject_counts(canon: DataFrame, by: tuple[str, ...] = ("run_date", "source", "reason")) -> DataFrame:
    """Valid/reject totals grouped by reason (null reason = valid)."""
    return canon.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
