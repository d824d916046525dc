"""Layout helpers."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def spread(df: DataFrame, partitions: int | None) -> DataFrame:
    """Round-robin repartition to ``partitions`` when the caller asks for it
    (None: the input's own splits). It shuffles whole rows, so it only pays for
    an input that arrives in one unsplittable file. Round-robin repartitioning
    sorts rows locally first, so a retried task reproduces the same assignment.
    """
    return df if partitions is None else df.repartition(partitions)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once, as a reliable checkpoint in the folder that
    ``spark.checkpoint.dir`` names. Only where that is unset (local tests) is a
    scratch folder set."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoints-"))
    return df.checkpoint(eager=True)
