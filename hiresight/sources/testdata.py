"""Adapter from the driver's generated tables to job-posting inputs.

The generated tables hold no job postings, so postings are derived row by row
from ``documents`` (one posting per document, the whole document text as the
posting body) and board URLs from ``pages``. The derivations are projections
written once as SQL expressions that both Spark and DuckDB accept, so the
library code (Spark) and the oracle queries (DuckDB) start from the very same
rows. Work and output grow with the input tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .layout import spread
from .registry import JobSource, posting_schema, struct_of


def _case(expr: str, values: list[str]) -> str:
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {expr} {whens} END"


# Fixed lists used to build postings from documents.
TITLES = [
    "Senior Software Engineer", "Data Scientist", "Analytics Engineer",
    "Product Manager", "UX Designer", "Account Executive", "Marketing Manager",
    "Customer Success Lead", "Accountant", "Recruiter", "Program Manager",
    "Paralegal", "Data Analyst", "Chief Happiness Officer",
]
COMPANY_SUFFIXES = ["Software", "Fintech", "Health", "Retail", "Logistics", "Group"]
LOCATIONS = [
    "Denver, CO", "Portland, OR 97201", "Nashville, TN", "United States, any city", "Phoenix, AZ",
    "Columbus, OH", "Raleigh, NC", "Greater Cleveland, OH 44101",
    "Lyon, France", "Osaka, Japan", "Madrid, Spain", "Dublin, Ireland", "Home office, Asia",
    "Flexible", "Worldwide", "Distributed team",
    "Denver, CO (Hybrid)", "Hamburg, DE", "Wheeling, West Virginia", "Portland, OR; Denver, CO",
    "Oregon", "Lausanne", "Pune, IN, India", "",
]
PHRASES = [
    "Python, SQL and dbt.",
    "AWS, Kubernetes and Go.",
    "C++ and Java.",
    "R&D with Spark and Airflow.",
    "",
    "Snowflake, Tableau and Power BI dashboards.",
    "React, Node.js and TypeScript on Google Cloud.",
    "Machine learning with PyTorch, scikit-learn and Hugging Face.",
    "Salesforce, HubSpot and Jira; Agile and CI/CD.",
    ".NET, C# and Docker on Azure.",
]
DEPARTMENTS = ["Engineering", "Data", "Product", "Sales", "Operations"]
EMPLOYMENT = ["Full-time", "Part-time", "Contract"]
EPOCH_DAY_2025_01_06 = 20094

# Repeated postings: ids ending in 9 repeat the posting before them in the next
# run; ids ending in 4 repeat it inside the same run, with another body.
BASE = "(CASE WHEN doc_id % 10 IN (4, 9) THEN doc_id - 1 ELSE doc_id END)"
# Odd inputs, a few in a hundred each.
NO_ID = "(doc_id % 97 = 5)"
OTHER_SOURCE = "(doc_id % 89 = 7)"
NO_TITLE = "(doc_id % 83 = 11)"
BAD_DATE = "(doc_id % 79 = 13)"
EMPTY_CONTENT = "(doc_id % 73 = 17)"
RUN_OFFSET = ("CAST(7 * (CAST(floor(doc_id / 10) AS BIGINT) % 4 + "
              "CASE WHEN doc_id % 10 = 9 THEN 1 ELSE 0 END) AS INT)")
RUN_DATE = f"CAST(DATE '2025-01-06' + {RUN_OFFSET} AS DATE)"
COMPANY_NO = f"({BASE} % 20)"

# Posting view P over `documents`: (name, expression) in output order.
POSTING_COLUMNS: list[tuple[str, str]] = [
    ("pos", "doc_id"),
    ("source", f"CASE WHEN {OTHER_SOURCE} THEN 'workday' WHEN CAST(floor({BASE} / 14) AS BIGINT) % 2 = 0 THEN 'greenhouse' ELSE 'lever' END"),
    ("source_job_id", f"CASE WHEN NOT {NO_ID} THEN CAST({BASE} AS STRING) END"),
    ("company_name", f"concat('src', CAST({COMPANY_NO} AS STRING), ' ', {_case(f'{COMPANY_NO} % 6', COMPANY_SUFFIXES)})"),
    ("company_slug", f"concat('src', CAST({COMPANY_NO} AS STRING))"),
    ("is_portfolio", f"({COMPANY_NO} % 4 = 0)"),
    ("title", f"CASE WHEN NOT {NO_TITLE} THEN {_case(f'{BASE} % 14', TITLES)} END"),
    ("location_raw", _case("(CAST(floor(doc_id / 20) AS BIGINT) + doc_id) % 24", LOCATIONS)),
    ("description", f"concat(coalesce(text, ''), ' ', {_case('CAST(floor(doc_id / 7) AS BIGINT) % 10', PHRASES)})"),
    ("department", _case(f"{BASE} % 5", DEPARTMENTS)),
    ("employment_type", _case(f"{BASE} % 3", EMPLOYMENT)),
    ("has_url", f"({BASE} % 3 <> 0)"),
    ("empty_content", EMPTY_CONTENT),
    ("bad_date", BAD_DATE),
    ("posted_iso", f"CASE WHEN {BAD_DATE} THEN '2025-01-06T24:61:00' ELSE concat(CAST(CAST(DATE '2025-01-03' + {RUN_OFFSET} AS DATE) AS STRING), "
                   f"CASE WHEN {BASE} % 2 = 0 THEN 'T09:30:00Z' ELSE 'T23:30:00-05:00' END) END"),
    # epoch seconds are no dates, epoch milliseconds are
    ("posted_epoch", f"CAST((CASE WHEN {BAD_DATE} THEN 1 ELSE 1000 END) * (CAST({EPOCH_DAY_2025_01_06 - 3} AS BIGINT) + {RUN_OFFSET}) * 86400 AS STRING)"),
    ("run_date", RUN_DATE),
]


def postings_select_sql(table: str = "documents") -> str:
    cols = ",\n  ".join(f"{expr} AS {name}" for name, expr in POSTING_COLUMNS)
    return f"SELECT\n  {cols}\nFROM {table}"


BOARD_URL = (
    "CASE page_id % 5 "
    "WHEN 0 THEN concat('https://boards.greenhouse.io/src', CAST(page_id % 40 AS STRING)) "
    "WHEN 1 THEN concat('https://jobs.lever.co/src', CAST(page_id % 40 AS STRING), '/x') "
    "WHEN 2 THEN concat('https://careers.greenhouse.io/src', CAST(page_id % 40 AS STRING)) "
    "WHEN 3 THEN concat('https://clever.com/src', CAST(page_id % 40 AS STRING)) "
    "ELSE url END"
)
# Board URL view B over `pages`.
BOARD_COLUMNS: list[tuple[str, str]] = [
    ("page_id", "page_id"),
    ("url", BOARD_URL),
    ("ats_type", "CASE page_id % 3 WHEN 0 THEN 'greenhouse' WHEN 1 THEN 'lever' ELSE 'workday' END"),
    ("domain", "CASE page_id % 4 WHEN 0 THEN concat('https://Src', CAST(page_id % 40 AS STRING), '.Example.com//') "
               "WHEN 1 THEN concat(' src', CAST(page_id % 40 AS STRING), '.example.com/ ') "
               "ELSE concat('src', CAST(page_id % 40 AS STRING), '.example.com') END"),
    ("company_name", "concat('src', CAST(page_id % 40 AS STRING))"),
    ("probe_status", "CASE WHEN page_id % 3 = 0 THEN 404 ELSE 200 END"),
]


def boards_select_sql(table: str = "pages") -> str:
    cols = ",\n  ".join(f"{expr} AS {name}" for name, expr in BOARD_COLUMNS)
    return f"SELECT\n  {cols}\nFROM {table}"


def read_table(spark: SparkSession, sf_dir: str, name: str, partitions: int | None = None) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"), partitions)


def postings(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """View P: one flat posting per document (see POSTING_COLUMNS)."""
    docs = read_table(spark, sf_dir, "documents", partitions)
    return docs.selectExpr(*[f"{expr} AS {name}" for name, expr in POSTING_COLUMNS])


def boards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """View B: one careers/board URL per page."""
    pages = read_table(spark, sf_dir, "pages")
    return pages.selectExpr(*[f"{expr} AS {name}" for name, expr in BOARD_COLUMNS])


def raw_postings(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """P re-shaped into landed board postings (the shape the JSON scan
    yields), so the canonical transform runs on the raw field layout of each
    source: Greenhouse ``content/location/metadata/updated_at``, Lever
    ``text/categories/createdAt``; some postings lack a URL."""
    p = postings(spark, sf_dir, partitions)
    gh = F.col("source") == "greenhouse"
    lv = F.col("source") == "lever"

    def only(cond, c):
        return F.when(cond, c)

    url = F.when(
        F.col("has_url"),
        F.when(gh, F.concat(F.lit("https://boards.greenhouse.io/"), F.col("company_slug"), F.lit("/jobs/"), F.col("source_job_id")))
        .otherwise(F.concat(F.lit("https://jobs.lever.co/"), F.col("company_slug"), F.lit("/"), F.col("source_job_id"))),
    )
    created = F.when(F.col("pos") % 2 == 0, F.col("posted_iso")).otherwise(F.col("posted_epoch"))
    posting = [
        F.col("source_job_id").alias("id"),
        only(gh, F.col("title")).alias("title"),
        only(gh, F.when(F.col("empty_content"), F.lit("")).otherwise(F.col("description"))).alias("content"),
        only(lv | F.col("empty_content"), F.col("description")).alias("description"),
        only(gh, F.struct(F.col("location_raw").alias("name"))).alias("location"),
        only(gh, url).alias("absolute_url"),
        only(gh, F.col("posted_iso")).alias("updated_at"),
        only(gh, F.array(
            F.struct(F.lit("department").alias("name"), F.col("department").alias("value")),
            F.struct(F.lit("employment_type").alias("name"), F.col("employment_type").alias("value")),
        )).alias("metadata"),
        only(lv, F.col("title")).alias("text"),
        F.lit(None).cast("string").alias("descriptionPlain"),
        only(lv, F.struct(
            F.col("location_raw").alias("location"),
            F.col("department").alias("department"),
            F.col("employment_type").alias("commitment"),
        )).alias("categories"),
        only(lv, url).alias("hostedUrl"),
        only(lv, created).alias("createdAt"),
    ]
    out = p.select(
        "source", "company_name", "run_date",
        F.concat(F.col("run_date").cast("string"), F.lit("T06:00:00")).alias("extracted_at"),
        F.lit("documents").alias("file_path"),
        "pos",
        *posting,
    )
    # Keep the declared raw types (e.g. metadata item struct) exactly.
    return out.select(
        *[F.col(c) for c in ("source", "company_name", "run_date", "extracted_at", "file_path", "pos")],
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in posting_schema().fields],
    )


#: a system that the library does not know: fields of its own, and ``location``
#: is a string here while it is an object elsewhere
WORKDAY_LIKE = JobSource(
    "workday",
    struct_of("requisition", "headline", "location", "opened", info=struct_of("html", "team", "time")),
    {"source_job_id": "requisition", "title": "headline", "body": "info.html", "location_raw": "location", "posted": "opened",
     "department": "info.team", "employment_type": "info.time", "job_url": "concat('https://jobs.workday.example/', requisition)"})


def workday_like_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P's rows of the third system in that system's raw shape."""
    p = postings(spark, sf_dir).where("source = 'workday'")
    return p.select(
        "source", "company_name", "run_date", F.concat(F.col("run_date").cast("string"), F.lit("T06:00:00")).alias("extracted_at"),
        F.lit("documents").alias("file_path"), "pos",
        F.col("source_job_id").alias("requisition"), F.col("title").alias("headline"), F.col("location_raw").alias("location"),
        F.col("posted_iso").alias("opened"),
        F.struct(F.col("description").alias("html"), F.col("department").alias("team"), F.col("employment_type").alias("time")).alias("info"))
