"""Keep-first deduplication, latest-per-key, and new/existing splits.

``keep_first`` finds the winners on keys and order columns alone (one narrow
aggregate, combined on the map side, so a hot key is one row per map task) and
then keeps the wide rows that semi-join them. Wide columns such as a posting's
body never enter the aggregate, and columns that nobody selects are not read.
No window over a raw key partition is used.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per ``keys``: the row with the smallest ``order`` tuple.

    ``order`` must be unique within a key group (end it with a unique column
    such as the position in the landed file): rows that tie are all kept.
    Null keys and null order values compare as equal.
    """
    names = [f"__o{i}" for i in range(len(order))]
    marked = df.select("*", *[o.alias(n) for o, n in zip(order, names, strict=True)])
    first = marked.groupBy(*keys).agg(F.min(F.struct(*names)).alias("__first")).select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        *[F.col("__first")[n].alias(f"{n}_first") for n in names])
    same = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    same += [F.col(n).eqNullSafe(F.col(f"{n}_first")) for n in names]
    return marked.join(first, reduce(lambda x, y: x & y, same), "left_semi").select(*df.columns)


def deduplicate_jobs(jobs: DataFrame, keys: Sequence[str] = ("run_date", "job_key")) -> DataFrame:
    """Keep the first posting per run and ``job_key`` in landing order
    (file, position in file). Not ``dropDuplicates``: its survivor is
    arbitrary."""
    return keep_first(jobs, keys, [F.col("file_path"), F.col("pos")])


def duplicates_removed(jobs: DataFrame, keys: Sequence[str] = ("run_date", "job_key"),
                       by: Sequence[str] = ()) -> DataFrame:
    """Rows before minus distinct keys after (keys include the run)."""
    return jobs.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_distinct(*[F.col(k) for k in keys]).alias("rows_after"),
    ).withColumn("duplicates_removed", F.col("rows_before") - F.col("rows_after"))


def latest_per_key(df: DataFrame, keys: Sequence[str], recency: Sequence[str],
                   tie_break: Sequence[Column] = ()) -> DataFrame:
    """One row per key: the greatest ``recency`` tuple (column names of
    date, timestamp or numeric type; null is the least recent), ties broken by
    the smallest ``tie_break`` tuple."""
    types = dict(df.dtypes)
    order = [x for c in recency for x in (F.col(c).isNull(), -_as_number(F.col(c), types[c]))]
    return keep_first(df, keys, [*order, *tie_break])


def _as_number(c: Column, dtype: str) -> Column:
    """Order-preserving numeric view of a column, so it can be negated."""
    if dtype == "date":
        return F.unix_date(c).cast("long")
    if dtype == "timestamp":
        return F.unix_micros(c)
    if dtype == "timestamp_ntz":
        # Wall-clock fields: exact and independent of the session time zone.
        secs = (F.date_part(F.lit("HOUR"), c) * 3600 + F.date_part(F.lit("MINUTE"), c) * 60
                + F.date_part(F.lit("SECOND"), c))
        return (F.unix_date(F.to_date(c)).cast("long") * F.lit(86_400_000_000)
                + (secs * F.lit(1_000_000)).cast("long"))
    return c


def split_new_existing(current: DataFrame, history: DataFrame,
                       key: str | Sequence[str] = "job_key") -> tuple[DataFrame, DataFrame]:
    """(new, existing): current rows whose key is absent from / present in
    history. Empty history makes everything new."""
    cols = [key] if isinstance(key, str) else list(key)
    hist_keys = history.select(*cols)
    return (current.join(hist_keys, cols, "left_anti"),
            current.join(hist_keys, cols, "left_semi"))


def first_seen(history: DataFrame, key: str = "job_key", at: str = "run_date") -> DataFrame:
    """First run in which each key appears (hash aggregate, partial per map)."""
    return history.groupBy(key).agg(F.min(at).alias("first_run_date"))


def new_vs_existing(history: DataFrame, key: str = "job_key", at: str = "run_date") -> DataFrame:
    """Tag every row of every run as new (key unseen in earlier runs) or
    existing, in one pass over history: compare with the key's first run."""
    first = first_seen(history, key, at)
    return history.join(first, key, "inner").withColumn(
        "is_new", F.col(at) == F.col("first_run_date")
    )


def new_vs_existing_counts(history: DataFrame, key: str = "job_key", at: str = "run_date") -> DataFrame:
    """Per run: keys seen for the first time (new) and keys seen in an
    earlier run (existing). History holds one row per (run, key). Counts
    only need two aggregates and a join of per-run rows: new(run) = keys
    whose first run is ``run``; existing = run total - new."""
    new = first_seen(history, key, at).groupBy(F.col("first_run_date").alias(at)).agg(
        F.count(F.lit(1)).alias("new_jobs"))
    totals = history.groupBy(at).agg(F.count(F.lit(1)).alias("total"))
    return (totals.join(new, at, "left")
            .select(at, F.coalesce("new_jobs", F.lit(0)).alias("new_jobs"),
                    (F.col("total") - F.coalesce("new_jobs", F.lit(0))).alias("existing_jobs")))


def merge_latest(snapshot: DataFrame, run: DataFrame, key: str = "job_key", at: str = "run_date", tie_break: str = "source") -> DataFrame:
    """``latest_per_key(snapshot + run)`` where both hold a key once: the row of
    the later ``at``, then of the lesser ``tie_break``. One join on the key: a
    snapshot that is stored by the key is not shuffled."""
    old, new = (df.select(key, F.struct(*df.columns).alias(side)) for df, side in ((snapshot, "old"), (run.select(*snapshot.columns), "new")))
    o, n = F.col("old"), F.col("new")
    later = o.isNull() | (n.isNotNull() & (
        (n[at] > o[at]) | (o[at].isNull() & n[at].isNotNull()) | (n[at].eqNullSafe(o[at]) & (n[tie_break] < o[tie_break]))))
    return old.join(new, key, "full_outer").select(F.when(later, n).otherwise(o).alias("row")).select("row.*")


FIRST = "first_run_date"


def merge_first_seen(index: DataFrame, keys: DataFrame, key: str = "job_key") -> DataFrame:
    """The index (key, first run) after some keys with their runs, one row each,
    were added. One join on the key."""
    new = keys.select(key, F.col(FIRST).alias("__new"))
    return index.join(new, key, "full_outer").select(key, F.least(FIRST, "__new").alias(FIRST))


def run_keys(run: DataFrame, key: str = "job_key", at: str = "run_date") -> DataFrame:
    """A run's keys with its date, as additions to the index."""
    return run.select(key, F.col(at).alias(FIRST)).distinct()


def repair_first_seen(index: DataFrame, run: DataFrame, later: DataFrame, run_date: str,
                      key: str = "job_key", at: str = "run_date") -> DataFrame:
    """The index after ``run_date`` was rebuilt to hold the rows of ``run``. Keys
    that were first seen in it and are gone from it move to their next run in
    ``later`` (the runs after it), of which only keys and dates are read, or
    leave the index."""
    day = F.lit(str(run_date)).cast("date")
    mine = run_keys(run, key, at)
    gone = index.where(F.col(FIRST) == day).join(mine, key, "left_anti").select(key)
    back = later.select(key, at).join(gone, key, "left_semi").groupBy(key).agg(F.min(at).alias(FIRST))
    return merge_first_seen(index.where(F.col(FIRST) != day), mine.union(back), key)


def tag_run(run: DataFrame, index: DataFrame, key: str = "job_key", at: str = "run_date") -> DataFrame:
    """Rows of a run with ``first_run_date`` and ``is_new``, from the run and
    the index alone (the index holds the run's keys)."""
    return run.join(index, key).withColumn("is_new", F.col(at) == F.col(FIRST))
