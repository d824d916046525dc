"""Reading of the given tables, shared by the registered queries."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names. Only where that is unset
    (local tests) is a scratch folder set."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            import tempfile

            named = tempfile.mkdtemp(prefix="checkpoints-")
        sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder."""
    _shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Like ``checkpointed``, as a Parquet table: for rows of which later steps
    read a few columns each."""
    path = f"{_shared_folder(df.sparkSession)}/table-{uuid.uuid4()}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def positional(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """``df`` with its columns named c0, c1, ... and their former names, for
    stages that add columns beside whatever the input holds (``toDF`` with the
    former names undoes it, also for names with dots or that differ in case)."""
    return df.toDF(*(f"c{i}" for i in range(len(df.columns)))), df.columns


def column_of(names: list[str], name: str) -> str:
    """The positional name of a column: of that name, else of that name but for case."""
    if name not in names and sum(n.lower() == name.lower() for n in names) != 1:
        raise ValueError(f"no column {name}, or several, in {names}")
    return f"c{names.index(name) if name in names else [n.lower() for n in names].index(name.lower())}"


def id_remainder(column: str, divisor: int):
    """crc32 of the id as text (a null id as the empty text), mod divisor."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % divisor
