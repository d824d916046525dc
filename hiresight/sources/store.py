"""Job history store (versioned Parquet by run date), snapshot and CSV exports."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import CANONICAL, REJECT
from . import files, versions

REJECT_ROWS = T.StructType([*REJECT.fields, T.StructField("run_date", T.DateType())])


def write_jobs(jobs: DataFrame, path: str, run_dates: Sequence[str] | None = None,
               max_records_per_file: int = 2_000_000) -> None:
    """Write the history partitioned by run date and source (snappy).

    ``run_dates`` names the dates that are (re)built: each becomes exactly its
    rows here, also when there are none. Without it, the dates present in
    ``jobs`` are replaced and all others kept (a first load of many dates).
    All dates are written in one pass and swapped in together; until then, and
    after a failure, readers see the old rows (``versions``).

    No repartition by the partition columns: that would send every row of
    one (run date, source) to a single task. Each task writes its slice of
    each partition (Spark sorts rows by the partition columns within the
    task), so the write is as parallel as the build; file size is capped.
    """
    versions.replace_dates(jobs, path, run_dates, by=("source",), save=lambda w, to: (
        w.option("compression", "snappy").option("maxRecordsPerFile", max_records_per_file).parquet(to)))


def read_jobs(spark: SparkSession, path: str, run_date: str | dt.date | None = None,
              source: str | None = None, since: str | dt.date | None = None,
              days: int | None = None, as_of: str | dt.date | None = None) -> DataFrame:
    """The history, optionally one run, one source, runs since a date, or
    the last ``days`` days up to ``as_of`` (default today). Dates are chosen
    from the manifest, so only their folders are listed and read. A missing
    store is an empty frame with the canonical schema."""
    first = []
    if since is not None:
        first.append(str(since))
    if days is not None:
        end = dt.date.fromisoformat(str(as_of)) if as_of is not None else dt.date.today()
        first.append((end - dt.timedelta(days=days)).isoformat())

    def keep(date: str) -> bool:
        return (run_date is None or date == str(run_date)) and all(date >= f for f in first)

    df = versions.read_dates(spark, path, CANONICAL, keep)
    return df if source is None else df.where(F.col("source") == source)


def write_csv(df: DataFrame, path: str, single_file: bool = True) -> None:
    """CSV with header, UTF-8. Arrays are written as JSON text. Metric tables
    are small (bounded by dictionary sizes), so one file is written;
    pass ``single_file=False`` for large exports."""
    cols = [F.to_json(F.col(f.name)).alias(f.name) if f.dataType.typeName() == "array" else F.col(f.name)
            for f in df.schema.fields]
    out = df.select(*cols)
    if single_file:
        out = out.coalesce(1)
    out.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)


def write_rejects(rejects: DataFrame, path: str, run_dates: Sequence[str] | None = None) -> None:
    """Reject rows as CSV by run date; ``run_dates`` as in ``write_jobs``."""
    versions.replace_dates(rejects.select(*REJECT_ROWS.names), path, run_dates, save=lambda w, to: w.option("header", True).csv(to))


def read_rejects(spark: SparkSession, path: str, run_date: str | dt.date | None = None) -> DataFrame:
    return versions.read_dates(spark, path, REJECT_ROWS, lambda d: run_date is None or d == str(run_date), "csv", header="true")


def export_run(spark: SparkSession, store: str, run_date: str, out: str, fmt: str = "csv") -> int:
    """Export one run as CSV or Parquet; returns the row count (0 = nothing
    to export)."""
    df = read_jobs(spark, store, run_date=run_date)
    n = df.count()
    if n == 0:
        return 0
    if fmt == "csv":
        write_csv(df, out, single_file=False)
    else:
        df.write.mode("overwrite").parquet(out)
    return n


def write_snapshot(snapshot: DataFrame, path: str) -> None:
    """Unpartitioned snapshot. Write it to a new folder (e.g. one per
    version) rather than over the history it was computed from."""
    snapshot.write.mode("overwrite").option("compression", "snappy").parquet(path)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    if not files.exists(spark, path):
        return spark.createDataFrame([], CANONICAL)
    return spark.read.schema(CANONICAL).parquet(path)


def write_discovered(discovered: DataFrame, path: str) -> None:
    """Discovered companies as CSV, written in parallel: the table grows with
    the URLs that were scanned."""
    from ..operators.discovery import DISCOVERED

    write_csv(discovered.select(*DISCOVERED), path, single_file=False)
