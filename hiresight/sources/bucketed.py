"""Tables that stay hash-partitioned and sorted by a key on disk.

A bucketed table joins on its key without a shuffle of its own side, so merging
one run into a table of all keys moves the run alone. Every version is a folder
of its own; its marker file, written last, makes it readable and says how it is
partitioned. The tables are external: the session's catalog only holds their
layout, the rows are the folder's Parquet files.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from . import files

_MARKER = "_layout.json"


def _name(path: str) -> str:
    return "hiresight_bucketed_" + hashlib.sha256(path.rstrip("/").encode()).hexdigest()[:24]


def layout(spark: SparkSession, path: str) -> dict | None:
    """The marker of a version, or None where it was not written to its end."""
    try:
        return json.loads(files.read_text(spark, f"{path.rstrip('/')}/{_MARKER}")) if files.exists(spark, f"{path.rstrip('/')}/{_MARKER}") else None
    except ValueError:
        return None


def write(rows: DataFrame, path: str, key: str, buckets: int | None = None, **notes: object) -> None:
    """Write a version, replacing what the folder held. ``buckets`` defaults to
    the session's number of shuffle partitions; rows that come from a join with
    a table of as many buckets are written as they are."""
    spark = rows.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    files.delete(spark, f"{path.rstrip('/')}/{_MARKER}")
    spark.sql(f"DROP TABLE IF EXISTS {_name(path)}")
    (rows.write.mode("overwrite").format("parquet").option("path", path).option("compression", "snappy")
     .bucketBy(n, key).sortBy(key).saveAsTable(_name(path)))
    files.create_text(spark, f"{path.rstrip('/')}/{_MARKER}", json.dumps({"key": key, "buckets": n, **notes}))


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A version with its partitioning, or an empty frame."""
    how = layout(spark, path)
    if how is None:
        return spark.createDataFrame([], schema)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_name(path)} ({columns}) USING parquet CLUSTERED BY (`{how['key']}`) "
              f"SORTED BY (`{how['key']}`) INTO {how['buckets']} BUCKETS LOCATION '{path}'")
    return spark.table(_name(path)).select(*schema.names)


def versions(spark: SparkSession, root: str) -> list[str]:
    """The whole versions under a root (``version=...`` folders), in order."""
    found = [n.split("=", 1)[1] for n in files.folders(spark, root) if n.startswith("version=")]
    return [v for v in found if layout(spark, f"{root.rstrip('/')}/version={v}") is not None]
