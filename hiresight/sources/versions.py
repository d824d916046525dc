"""Tables by run date whose dates are replaced as a whole, at once.

A write never touches what readers see. It puts all its dates, in one pass,
into a folder of its own::

    {path}/data/version={v}/run_date={d}/...

and then swaps them in with one small file, the next manifest::

    {path}/_manifest/{n}.json        {"dates": {date: version or null}, "of": {...}}

(``of`` may say which version of another table a date was made from.)

Readers follow the newest manifest that is whole. A writer that dies before the
swap leaves the old rows readable; one that dies within it leaves a broken
manifest, which is skipped. Two writers that swap at the same time get
different numbers: the later one starts from the earlier one's manifest, so no
date is lost. ``remove_unread`` deletes what no manifest names any more.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import files

ATTEMPTS = 50


def _manifests(path: str) -> str:
    return f"{path.rstrip('/')}/_manifest"


def _data(path: str) -> str:
    return f"{path.rstrip('/')}/data"


def _read_manifest(spark: SparkSession, path: str, name: str) -> dict[str, dict[str, str | None]] | None:
    try:
        found = json.loads(files.read_text(spark, f"{_manifests(path)}/{name}"))
        return {"dates": dict(found["dates"]), "of": dict(found.get("of", {}))}
    except (ValueError, KeyError, TypeError):
        return None


def _newest(spark: SparkSession, path: str) -> tuple[int, dict[str, dict[str, str | None]]]:
    """The number of the last manifest, and what the last whole one says."""
    names = files.names(spark, _manifests(path))
    number = int(names[-1].split(".")[0]) if names else 0
    for name in reversed(names):
        found = _read_manifest(spark, path, name)
        if found is not None:
            return number, found
    return number, {"dates": {}, "of": {}}


def current(spark: SparkSession, path: str) -> dict[str, str]:
    """Version of each date that has rows."""
    return {d: v for d, v in _newest(spark, path)[1]["dates"].items() if v is not None}


def made_from(spark: SparkSession, path: str) -> dict[str, str | None]:
    """What each date was made from, as its writer said."""
    return _newest(spark, path)[1]["of"]


def publish(spark: SparkSession, path: str, changes: dict[str, str | None], of: dict[str, str | None] | None = None) -> None:
    """Swap in the versions of some dates; all other dates stay."""
    for _ in range(ATTEMPTS):
        number, now = _newest(spark, path)
        text = json.dumps({"dates": {**now["dates"], **changes}, "of": {**now["of"], **(of or {})}}, sort_keys=True)
        if files.create_text(spark, f"{_manifests(path)}/{number + 1:012d}.json", text):
            return
    raise RuntimeError(f"{path}: other writers came first {ATTEMPTS} times")


def replace_dates(rows: DataFrame, path: str, run_dates: Sequence[str] | None,
                  save: Callable[[DataFrameWriter, str], None], by: Sequence[str] = (),
                  of: dict[str, str | None] | None = None) -> None:
    """Write ``rows`` partitioned by ``run_date`` and ``by`` and swap in their
    dates: those of ``run_dates`` (rows of other dates are left out; a date
    without rows becomes empty), or without it the dates that have rows.
    ``save`` writes a writer's rows to a folder."""
    spark = rows.sparkSession
    if any(n.startswith("run_date=") for n in files.folders(spark, path)):
        raise ValueError(f"{path} holds date folders without a manifest")
    if run_dates is not None:
        rows = rows.where(F.col("run_date").isin([F.lit(str(d)).cast("date") for d in run_dates]))
    version = f"{int(time.time() * 1000):013d}-{uuid.uuid4().hex[:8]}"
    to = f"{_data(path)}/version={version}"
    save(rows.write.mode("errorifexists").partitionBy("run_date", *by), to)
    written = {n.split("=", 1)[1] for n in files.folders(spark, to)}
    publish(spark, path, {str(d): version if str(d) in written else None for d in (run_dates if run_dates is not None else written)}, of)


def read_dates(spark: SparkSession, path: str, schema: T.StructType, keep: Callable[[str], bool] = lambda d: True,
               fmt: str = "parquet", **options: str) -> DataFrame:
    """The rows of the dates that ``keep`` accepts: only their folders are
    listed and read. A missing table is an empty frame."""
    wanted = [f"{_data(path)}/version={v}/run_date={d}" for d, v in sorted(current(spark, path).items()) if keep(d)]
    if not wanted:
        return spark.createDataFrame([], schema)
    rows = (spark.read.format(fmt).schema(T.StructType([*schema.fields, T.StructField("version", T.StringType())]))
            .options(**options).option("basePath", _data(path)).load(wanted))
    return rows.select(*schema.names)


def remove_unread(spark: SparkSession, path: str, older_than_hours: float = 24.0, manifests: int = 10) -> list[str]:
    """Delete versions that none of the last ``manifests`` manifests names and
    that are older than any running read or write may be; returns their names."""
    names = files.names(spark, _manifests(path))
    used = {v for n in names[-manifests:] for v in (_read_manifest(spark, path, n) or {"dates": {}})["dates"].values()}
    used |= set(current(spark, path).values())
    gone = []
    for folder in files.folders(spark, _data(path)):
        at = f"{_data(path)}/{folder}"
        if folder.split("=", 1)[1] not in used and files.modified(spark, at) < time.time() - older_than_hours * 3600:
            files.delete(spark, at)
            gone.append(folder.split("=", 1)[1])
    return gone
