"""Sources of postings as data: a raw posting schema and a canonical select.

A ``JobSource`` names the fields of one applicant-tracking system's posting and
says, as SQL expressions over them, what each draft field is. ``canonicalize``
works on draft fields alone, so a new system is one more ``JobSource`` in a
mapping that the caller passes on:

Rows may carry a boolean ``malformed`` (a posting that did not fit its schema);
without it no row is.

* ``shared_drafts`` drafts rows that hold several sources' fields side by side
  (one pass, a CASE over ``source``; fields that the rows lack are null);
* ``source_drafts`` drafts rows of one source, whose fields may have any type:
  ``landing.read_drafts`` scans each source's own folders with its own schema
  and unites the drafts by name.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..dictionaries import GREENHOUSE_DEFAULT_JOB_URL, LEVER_DEFAULT_JOB_URL

#: draft fields of a posting, all strings
DRAFT = ("source_job_id", "job_url", "title", "body", "department", "employment_type", "location_raw", "posted")
#: what every raw row carries besides its posting (first-wins order included)
CONTEXT = ("source", "company_name", "run_date", "extracted_at", "file_path", "pos")


@dataclass(frozen=True)
class JobSource:
    """``fields`` maps draft fields to SQL expressions over ``posting``'s
    fields; a field that is left out is null."""

    name: str
    posting: T.StructType
    fields: Mapping[str, str]

    def __post_init__(self) -> None:
        unknown = set(self.fields) - set(DRAFT)
        if unknown:
            raise ValueError(f"{self.name}: no draft fields {sorted(unknown)}")
        if "source_job_id" not in self.fields:
            raise ValueError(f"{self.name}: a source says what its posting id is")
        clash = {f.name for f in self.posting} & set(CONTEXT)
        if clash:
            raise ValueError(f"{self.name}: rename the posting fields {sorted(clash)}")

    def field(self, draft: str) -> Column:
        return F.expr(self.fields.get(draft, "NULL")).cast("string")


def struct_of(*strings: str, **others: T.DataType) -> T.StructType:
    """A struct of string fields and of fields of other types."""
    fields = {**dict.fromkeys(strings, T.StringType()), **others}
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


def _item(key: str) -> str:
    """Value of the first metadata item of that name."""
    return f"try_element_at(filter(metadata, m -> m.name = '{key}'), 1).value"


# ``id`` is a string: Greenhouse integers arrive as their decimal text.
GREENHOUSE = JobSource(
    "greenhouse",
    struct_of("id", "title", "content", "description", location=struct_of("name"), absolute_url=T.StringType(),
              updated_at=T.StringType(), metadata=T.ArrayType(struct_of("name", "value"))),
    {"source_job_id": "id", "job_url": f"coalesce(absolute_url, concat('{GREENHOUSE_DEFAULT_JOB_URL}', id))", "title": "title",
     "body": "coalesce(nullif(content, ''), description)", "department": _item("department"), "employment_type": _item("employment_type"),
     "location_raw": "location.name", "posted": "updated_at"})

LEVER = JobSource(
    "lever",
    struct_of("id", "text", "description", "descriptionPlain", categories=struct_of("location", "department", "commitment"),
              hostedUrl=T.StringType(), createdAt=T.StringType()),
    {"source_job_id": "id", "job_url": f"coalesce(hostedUrl, concat('{LEVER_DEFAULT_JOB_URL}', id))", "title": "text",
     "body": "coalesce(nullif(description, ''), descriptionPlain)", "department": "categories.department",
     "employment_type": "categories.commitment", "location_raw": "categories.location", "posted": "createdAt"})

Sources = Mapping[str, JobSource]


def sources(*items: JobSource) -> dict[str, JobSource]:
    """The mapping of some sources; two of one name are an error."""
    out: dict[str, JobSource] = {}
    for s in items:
        if s.name in out:
            raise ValueError(f"two sources named {s.name}")
        out[s.name] = s
    return out


DEFAULT_SOURCES = sources(GREENHOUSE, LEVER)


def posting_schema(known: Sources = DEFAULT_SOURCES) -> T.StructType:
    """All sources' posting fields side by side, for rows that hold any of
    them. A field that two sources type differently needs ``source_drafts``."""
    out: dict[str, T.DataType] = {}
    for s in known.values():
        for f in s.posting:
            if out.setdefault(f.name, f.dataType) != f.dataType:
                raise ValueError(f"{s.name}: {f.name} is {f.dataType.simpleString()}, elsewhere {out[f.name].simpleString()}")
    return T.StructType([T.StructField(k, v) for k, v in out.items()])


def _with_fields(raw: DataFrame, posting: Iterable[T.StructField]) -> DataFrame:
    missing = {f.name: F.lit(None).cast(f.dataType) for f in posting if f.name not in raw.columns}
    if "malformed" not in raw.columns:
        missing["malformed"] = F.lit(False)
    return raw.withColumns(missing) if missing else raw


def shared_drafts(raw: DataFrame, known: Sources = DEFAULT_SOURCES) -> DataFrame:
    """Drafts of rows of several sources; rows of unknown sources are dropped."""
    rows = _with_fields(raw, posting_schema(known)).where(F.col("source").isin(*known))

    def pick(draft: str) -> Column:
        cases = [(F.col("source") == s.name, s.field(draft)) for s in known.values()]
        return reduce(lambda whens, c: whens.when(*c), cases[1:], F.when(*cases[0]))

    return rows.select(*CONTEXT, *[pick(d).alias(d) for d in DRAFT], "malformed")


def source_drafts(raw: DataFrame, source: JobSource) -> DataFrame:
    """Drafts of rows of one source (``source`` is set to its name)."""
    rows = _with_fields(raw, source.posting)
    return rows.select(F.lit(source.name).alias("source"), *CONTEXT[1:], *[source.field(d).alias(d) for d in DRAFT], "malformed")
