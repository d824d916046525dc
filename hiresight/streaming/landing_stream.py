"""Incremental build over newly landed board files (Structured Streaming).

The landing folder only grows: each run adds ``{run_date}/{source}/{company}/
jobs.json`` files, and a late file may arrive for a date already built. A
file-source stream with ``trigger(availableNow=True)`` picks up exactly the
files not seen before (tracked in the checkpoint), and each micro-batch:

1. finds the run dates its files belong to (one row per date, a handful);
2. rebuilds those dates from *all* their landed files (``run_build`` reads the
   date folders, so files from earlier batches are included), parsing each file
   once and writing all dates in one pass;
3. swaps those dates in together. ``files_per_batch`` bounds a first start over
   a long backlog.

Rebuilding whole dates keeps first-wins deduplication over every file of
the date, and makes a replayed batch (after a failure) idempotent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.jobs import run_build
from ..schemas import RAW_ENVELOPE
from ..sources import landing
from ..sources.registry import DEFAULT_SOURCES, Sources


def _run_dates(batch: DataFrame) -> list[str]:
    dates = batch.select(F.regexp_extract("file_path", landing.PATH_PATTERN, 1).alias("d")).distinct()
    return sorted(r["d"] for r in dates.collect() if r["d"])


def start_incremental_build(spark: SparkSession, raw_root: str, jobs_path: str, checkpoint: str,
                            rejects_path: str | None = None, strict_us: bool = True,
                            files_per_batch: int = 1_000, sources: Sources = DEFAULT_SOURCES) -> StreamingQuery:
    """Start the stream; it processes every file not yet seen and stops."""
    files = (spark.readStream.schema(RAW_ENVELOPE).option("multiLine", True).option("maxFilesPerTrigger", files_per_batch)
             .json(f"{raw_root.rstrip('/')}/*/*/*/jobs.json")
             .select(F.col("_metadata.file_path").alias("file_path")))

    def process(batch: DataFrame, batch_id: int) -> None:
        dates = _run_dates(batch)
        if dates:
            run_build(spark, raw_root, jobs_path, rejects_path, dates, strict_us, sources)

    return (files.writeStream.foreachBatch(process)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def run_incremental_build(spark: SparkSession, raw_root: str, jobs_path: str, checkpoint: str,
                          rejects_path: str | None = None, strict_us: bool = True,
                          sources: Sources = DEFAULT_SOURCES) -> None:
    q = start_incremental_build(spark, raw_root, jobs_path, checkpoint, rejects_path, strict_us, sources=sources)
    q.awaitTermination()
