"""Scan of landed board JSON: ``{root}/{run_date}/{source}/{company_id}/jobs.json``.

One JSON document per company board (an envelope with its postings). The
source and the run date come from the directory, as the original layout
defines them; the company name comes from the envelope.

A file is one task of the scan, so the scan does as little as it can: it cuts
the envelope into postings and leaves each as JSON text. The text is parsed
with the source's schema after the rows may have been spread, one posting by
itself, so a posting of the wrong shape spoils no other: it arrives with
``malformed`` set and what could be read of it, and is rejected downstream.
Only a file that is no JSON at all is quarantined.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import RAW_ENVELOPE
from . import files
from .layout import spread
from .registry import CONTEXT, DEFAULT_SOURCES, DRAFT, Sources, posting_schema, source_drafts

PATH_PATTERN = r"/(\d{4}-\d{2}-\d{2})/([^/]+)/[^/]+/jobs\.json$"
Dates = str | Sequence[str] | None


def _glob(root: str, run_date: Dates, source: str) -> str:
    dates = run_date if isinstance(run_date, str) else "*" if run_date is None else "{" + ",".join(run_date) + "}"
    return f"{root.rstrip('/')}/{dates}/{source}/*/jobs.json"


def read_envelopes(spark: SparkSession, root: str, run_date: Dates = None, source: str = "*") -> DataFrame:
    """Envelopes with ``file_path``, ``run_date`` and the directory ``source``;
    ``jobs`` are the postings as JSON texts.

    ``run_date`` (one or several) and ``source`` narrow the glob, so only those
    files are listed. Malformed files land in ``_corrupt_record`` instead of
    failing the job.
    """
    jobs = T.StructField("jobs", T.ArrayType(T.StringType()))
    schema = T.StructType([*RAW_ENVELOPE.fields, jobs, T.StructField("_corrupt_record", T.StringType())])
    env = (spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", "_corrupt_record").json(_glob(root, run_date, source)))
    path = F.col("_metadata.file_path")
    return env.select(
        "*",
        path.alias("file_path"),
        F.to_date(F.regexp_extract(path, PATH_PATTERN, 1)).alias("run_date"),
        F.regexp_extract(path, PATH_PATTERN, 2).alias("dir_source"),
    )


def corrupt_files(envelopes: DataFrame) -> DataFrame:
    """Files that could not be parsed (quarantine list). The test of ``jobs``
    keeps a data column in the scan: Spark refuses to read the corrupt record
    alone."""
    broken = F.col("_corrupt_record").isNotNull() & F.col("jobs").isNull()
    return envelopes.where(broken).select("file_path", "_corrupt_record")


def posting_texts(envelopes: DataFrame) -> DataFrame:
    """One row per posting: ``source, company_name, run_date, extracted_at,
    file_path, pos`` and its JSON text ``job``. ``pos`` is the position in the
    file's ``jobs`` array (first-wins order)."""
    return envelopes.select(
        F.col("dir_source").alias("source"), "company_name", "run_date", "extracted_at", "file_path",
        F.posexplode("jobs").alias("pos", "job"),
    ).withColumn("pos", F.col("pos").cast("long"))


def parse_postings(texts: DataFrame, posting: T.StructType) -> DataFrame:
    """The context columns, the posting's fields, and ``malformed``: true for a
    text that is not a posting of that schema."""
    schema = T.StructType([*posting.fields, T.StructField("_bad", T.StringType())])
    parsed = F.from_json("job", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    rows = texts.select(*CONTEXT, F.inline(F.array(F.struct(parsed.alias("p"), F.col("job").isNull().alias("none")))))
    return rows.select(*CONTEXT, *[F.col("p")[f.name].alias(f.name) for f in posting.fields],
                       (F.col("none") | F.col("p._bad").isNotNull()).alias("malformed"))


def read_raw_postings(spark: SparkSession, root: str, run_date: Dates = None, partitions: int | None = None,
                      posting: T.StructType | None = None, source: str = "*") -> DataFrame:
    """Flattened postings with the fields of ``posting`` (default: those of all
    known sources). ``partitions`` spreads the postings, still as texts, when a
    few very large files hold most of them."""
    texts = spread(posting_texts(read_envelopes(spark, root, run_date, source)), partitions)
    return parse_postings(texts, posting or posting_schema())


def read_drafts(spark: SparkSession, root: str, run_date: Dates = None, partitions: int | None = None,
                sources: Sources = DEFAULT_SOURCES) -> DataFrame:
    """Drafted postings of all ``sources``: each source's folders are scanned
    with its own posting schema, and the drafts are united by name. A folder of
    an unknown source is not read."""
    drafts = [source_drafts(read_raw_postings(spark, root, run_date, partitions, s.posting, s.name), s) for s in sources.values()
              if files.any_match(spark, _glob(root, run_date, s.name))]
    if drafts:
        return reduce(DataFrame.unionByName, drafts)
    types = {**dict.fromkeys([*CONTEXT, *DRAFT], "string"), "run_date": "date", "pos": "long", "malformed": "boolean"}
    return spark.createDataFrame([], ", ".join(f"{c} {t}" for c, t in types.items()))


def envelope_stats(spark: SparkSession, root: str, run_date: Dates = None) -> DataFrame:
    """Per run and source: boards landed and postings (from ``job_count``)."""
    env = read_envelopes(spark, root, run_date).where(F.col("jobs").isNotNull() | F.col("_corrupt_record").isNull())
    return env.groupBy("run_date", F.col("dir_source").alias("source")).agg(
        F.count(F.lit(1)).alias("boards"),
        F.sum(F.coalesce("job_count", F.size("jobs"))).alias("postings"),
    )
