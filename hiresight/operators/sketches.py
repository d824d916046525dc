"""Distinct counts over any range of runs, from mergeable sketches per run.

A distinct count of a range is not a sum of the runs' counts, so exact answers
read every posting of the range. A run's HyperLogLog sketch is a few kilobytes,
whatever the run's size; the sketches of a range unite into the sketch of its
union. ``exact_between`` gives the exact figure next to it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .metrics import RUN

#: 2 ** LG_K registers: three standard errors are under 5 %
LG_K = 12
COUNTED = ("company_id", "job_key", "city")


def run_sketches(jobs: DataFrame, counted: Sequence[str] = COUNTED, lg_k: int = LG_K) -> DataFrame:
    """One row per run with a sketch of each column's distinct values (combined
    on the map side)."""
    return jobs.groupBy(RUN).agg(*[F.hll_sketch_agg(F.col(c).cast("string"), F.lit(lg_k)).alias(c) for c in counted])


def _between(since: str | None, until: str | None) -> Column:
    inside = F.lit(True)
    if since is not None:
        inside = inside & (F.col(RUN) >= F.lit(str(since)).cast("date"))
    if until is not None:
        inside = inside & (F.col(RUN) <= F.lit(str(until)).cast("date"))
    return inside


def distinct_between(sketches: DataFrame, since: str | None = None, until: str | None = None) -> DataFrame:
    """One row: the estimated distinct values of each sketched column over the
    runs from ``since`` to ``until`` (0 where no run is)."""
    counted = [c for c in sketches.columns if c != RUN]
    return sketches.where(_between(since, until)).agg(
        *[F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(c)), F.lit(0).cast("long")).alias(c) for c in counted])


def in_ranges(rows: DataFrame, ranges: Sequence[tuple[str, str]]) -> DataFrame:
    """``rows`` once for each range (``since``, ``until``) that holds their run."""
    listed = F.array(*[F.struct(F.lit(a).cast("date").alias("since"), F.lit(b).cast("date").alias("until")) for a, b in ranges])
    return rows.select("*", F.inline(F.filter(listed, lambda r: (r["since"] <= F.col(RUN)) & (F.col(RUN) <= r["until"]))))


def distinct_over(sketches: DataFrame, ranges: Sequence[tuple[str, str]]) -> DataFrame:
    """``distinct_between`` for many ranges: a row for each that holds a run."""
    counted = [c for c in sketches.columns if c != RUN]
    return in_ranges(sketches, ranges).groupBy("since", "until").agg(*[F.hll_sketch_estimate(F.hll_union_agg(c)).alias(c) for c in counted])


def exact_between(jobs: DataFrame, since: str | None = None, until: str | None = None, counted: Sequence[str] = COUNTED) -> DataFrame:
    return jobs.where(_between(since, until)).agg(*[F.count_distinct(c).alias(c) for c in counted])
