"""Periodic runs of words (operator 12), by a sparse diagonal DP.

A run is a stretch of consecutive words with smallest period q (words q apart
are identical) and at least ``max(least, 2 * q)`` words that cannot be extended
with that period. In the table of word i against the word q before it (lag q),
a run is a diagonal stretch of ``length - q`` matches: an earlier occurrence of
the word at that lag lengthens the lag's match, a mismatch ends it.

The table is never filled. A diagonal can only emit if it matches M times in a
row (M depends on the lag), so lags are worked off in classes [2^k, 2^(k+1)),
and a lag becomes active only where one of every M/2 words occurs earlier at
that lag together with the following words (a gram of M/2 + 1). Active lags of
neighbouring places join to one match; its ends are read word by word, and a
match that ends with sufficient length is emitted at once.

Inside a run of period d every multiple of d matches too. A lag whose words
lie in an emitted run of a period no longer than the gram is not the smallest
period there (Fine and Wilf), so it is skipped; that keeps the candidates of a
text of n words under about 2 n in each of log2(n) classes, also where one
word fills the whole text. What is left is checked against the emitted runs of
smaller periods, so results do not rest on the skipping or on gram hashes.

All texts of a piece are worked through at once in numpy, in map tasks without
a shuffle. Memory is a few times the longest single text.

Defined results: null and empty texts have no words, no runs and an empty
collapsed text; equal rows give equal rows; extra columns are ignored; an empty
table gives an empty result. Words are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import text as tx

_BASE = 0x8B2C6D1F4E97A35B
_CELLS = 1 << 21
RUN_TYPE = "array<struct<start:long,length:long,period:long>>"


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(n + 1, base, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


class _Grams:
    """Hashes of all grams of any length, from one prefix sum."""

    def __init__(self, words: np.ndarray):
        power, self.inverse = _powers(len(words))
        self.sum = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * power[:-1], dtype=np.uint64, out=self.sum[1:])

    def at(self, place: np.ndarray, n: int) -> np.ndarray:
        return tx.mix((self.sum[place + n] - self.sum[place]) * self.inverse[place])


def _grams_wanted(lo: int, hi: int, least: int) -> tuple[int, int]:
    """(step, gram): a match that can emit at a lag in lo..hi-1 holds a whole
    gram at a multiple of step."""
    m = lo if lo >= least else min(max(least - q, q) for q in range(lo, hi))
    step = max(m // 2, 1)
    return step, m - step + 1


def _candidates(grams: _Grams, first: np.ndarray, last: np.ndarray, live: np.ndarray, lo: int, hi: int, step: int, n: int, reach: np.ndarray):
    """(lag, place) where a gram at a multiple of the step occurs earlier in the
    same text at a lag in lo..hi-1, outside emitted runs of short periods."""
    place = live[live + n <= last[live]]
    if not len(place):
        return np.zeros(0, np.int64), place
    g = grams.at(place, n)
    order = np.argsort(g)
    g = g[order]
    new = np.r_[True, g[1:] != g[:-1]]
    again = ~(new & np.r_[new[1:], True])  # grams that occur twice or more
    rank, place = np.cumsum(new)[again], place[order][again]
    key = rank * (len(first) + 1) + place
    key.sort()
    anchor = (place - first[place]) % step == 0
    rank, place = rank[anchor], place[anchor]
    low = np.searchsorted(key, rank * (len(first) + 1) + np.maximum(place - hi + 1, first[place]))
    high = np.searchsorted(key, rank * (len(first) + 1) + place - lo, side="right")
    earlier, of = tx.ragged(low, np.maximum(high - low, 0))
    lag = place[of] - key[earlier] % (len(first) + 1)
    at = place[of]
    fresh = reach[at - lag] < at + n
    return lag[fresh], at[fresh]


def _extend(words: np.ndarray, first: np.ndarray, last: np.ndarray, lag: np.ndarray, place: np.ndarray, step: int, n: int, least: int):
    """(start, end, lag) of the runs whose matches cover the candidates."""
    order = np.lexsort((place, lag))
    lag, place = lag[order], place[order]
    new = np.flatnonzero(np.r_[True, (lag[1:] != lag[:-1]) | (place[1:] - place[:-1] != step)])
    end = np.r_[new[1:], len(lag)] - 1
    q, a, b = lag[new], place[new], place[end] + n
    margin = step + n
    lo, hi = np.maximum(a - margin, first[a] + q), np.minimum(b + margin, last[a])
    out = []
    cut = np.searchsorted(np.cumsum(hi - lo), np.arange(_CELLS, int((hi - lo).sum()) + _CELLS, _CELLS))
    for x, y in zip(np.r_[0, cut], np.r_[cut, len(q)], strict=True):
        if y <= x:
            continue
        cell, of = tx.ragged(lo[x:y], hi[x:y] - lo[x:y])
        of += x
        same = words[cell] == words[cell - q[of]]
        edge = np.r_[True, of[1:] != of[:-1]]
        begins = np.flatnonzero(same & (edge | ~np.r_[False, same[:-1]]))
        ends = np.flatnonzero(same & (np.r_[edge[1:], True] | ~np.r_[same[1:], False]))
        s, e, p = cell[begins] - q[of[begins]], cell[ends] + 1, q[of[begins]]
        # a match cut off by the window's edge is another candidate's
        whole = ((cell[begins] > lo[of[begins]]) | (lo[of[begins]] == first[cell[begins]] + p)) & ((e < hi[of[ends]]) | (e == last[cell[ends]]))
        long = whole & (e - s >= np.maximum(least, 2 * p))
        out.append(np.stack([s[long], e[long], p[long]]))
    return np.unique(np.concatenate(out, 1), axis=1) if out else np.zeros((3, 0), np.int64)


def _may_repeat(grams: _Grams, first: np.ndarray, last: np.ndarray, text: np.ndarray, least: int) -> np.ndarray:
    """The texts that hold some gram of the shortest emitting match twice."""
    n = (least + 1) // 2
    place = np.flatnonzero(np.arange(len(first)) + n <= last)
    bits = max(int(text[-1]).bit_length(), 1) if len(text) else 1
    key = np.sort(grams.at(place, n) >> np.uint64(bits) << np.uint64(bits) | text[place].astype(np.uint64))
    twice = key[1:][key[1:] == key[:-1]]
    return np.unique(twice & np.uint64((1 << bits) - 1)).astype(np.int64)


def find(words: np.ndarray, ptr: np.ndarray, least: int = 12) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of all runs, sorted so. ``words`` are the
    hashes of all words; text i has the words ``ptr[i]:ptr[i+1]``."""
    count = np.diff(ptr)
    text = np.repeat(np.arange(len(count)), count)
    first, last = np.repeat(ptr[:-1] - ptr[0], count), np.repeat(ptr[1:] - ptr[0], count)
    words = words[ptr[0] : ptr[-1]]
    chosen = _may_repeat(_Grams(words), first, last, text, least) if len(words) else np.zeros(0, np.int64)
    # from here on only the chosen texts, side by side
    at, _ = tx.ragged((ptr[:-1] - ptr[0])[chosen], count[chosen])
    n, words = count[chosen], words[at]
    bound = np.r_[0, np.cumsum(n)]
    text = np.repeat(chosen, n)
    first, last = np.repeat(bound[:-1], n), np.repeat(bound[1:], n)
    grams = _Grams(words)
    found = np.zeros((3, 0), np.int64)
    lo = 1
    while len(n) and max(least, 2 * lo) <= n.max():
        hi = 2 * lo
        step, gram = _grams_wanted(lo, hi, least)
        live = np.flatnonzero(last - first >= max(least, 2 * lo))
        lag, place = _candidates(grams, first, last, live, lo, hi, step, gram, _reach(found[:, found[2] <= gram], len(words)))
        if len(lag):
            runs = _extend(words, first, last, lag, place, step, gram, least)
            inside = _reach(found, len(words))[runs[0]] >= runs[1]  # of a run with a smaller period
            found = np.concatenate([found, runs[:, ~inside]], 1)
        lo = hi
    s, e, q = found
    order = np.lexsort((q, s))
    s, e, q = s[order], e[order], q[order]
    return text[s], s - first[s], e - s, q


def _reach(runs: np.ndarray, n: int) -> np.ndarray:
    """For each place, the furthest end of the runs that begin there or before."""
    out = np.zeros(n, np.int64)
    np.maximum.at(out, runs[0], runs[1])
    return np.maximum.accumulate(out)


def collapse(words: list[bytes], start: np.ndarray, length: np.ndarray, period: np.ndarray) -> bytes:
    """The words without those that a run holds after its first period."""
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, start + period, 1)
    np.add.at(edge, start + length, -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()])


def periodic_runs(docs: DataFrame, least: int = 12) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, ``runs`` by start and period,
    and ``collapsed``, the kept words joined by one space."""
    if least < 2:
        raise ValueError("a run has at least two words")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = tx.utf8(batch.column(1))
            for lo, hi in tx.chunks(texts):
                w = tx.Words(tx.Buffer(texts[lo:hi]), tx.SPACE)
                doc, start, length, period = find(w.hash, w.ptr, least)
                ptr = np.searchsorted(doc, np.arange(hi - lo + 1))
                out = []
                for i, t in enumerate(texts[lo:hi]):
                    kept, own = (t or b"").split(), slice(ptr[i], ptr[i + 1])
                    out.append(collapse(kept, start[own], length[own], period[own]) if ptr[i] < ptr[i + 1] else b" ".join(kept))
                runs = pa.ListArray.from_arrays(pa.array(ptr, pa.int32()), pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], ["start", "length", "period"]))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), runs, pa.array(out, pa.binary()).cast(pa.string())], names=["doc_id", "runs", "collapsed"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id long, runs {RUN_TYPE}, collapsed string")


def plant_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text) where the texts of about a tenth of the ids (crc32 of the
    id as text ends in 0) go over to a period that the id and the word count
    decide; their words are then joined by one space."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    rows = rows.withColumn("h", h).withColumn("g", F.floor(F.col("h") / 10))
    w = F.when(F.col("h") % 10 == 0, F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    rows = rows.withColumn("w", w).withColumn("n", F.nullif(F.size("w"), F.lit(0)))
    rows = rows.withColumn("a", (F.col("g") % F.col("n")).cast("int"))
    rows = rows.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))

    def periodic() -> Column:
        tail = F.transform(F.sequence(F.lit(0), F.col("n") - F.col("a") - 1), lambda j: F.get("w", F.col("a") + j % F.col("p")))
        return F.array_join(F.concat(F.slice("w", 1, F.col("a")), tail), " ")

    return rows.select("doc_id", F.when((F.col("h") % 10 == 0) & (F.col("n") > 0), periodic()).otherwise(F.col("text")).alias("text"))


def digests(runs: DataFrame) -> DataFrame:
    """The longest run (ties: smallest start, then period) and digests of the
    runs and of the collapsed text of each row of ``periodic_runs``."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
    rows = runs.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return rows.selectExpr("doc_id", "n_runs", "-best.start AS start", "best.length AS length", "-best.period AS period",
                           "1000 * best.length DIV -best.period AS exponent_milli", "runs_sha256", "collapsed_sha256")
