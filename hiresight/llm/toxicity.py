"""Toxicity: maximum-scoring segment search (operator 5).

1. Token scores. From labelled training rows, each hashed token's log-odds of
   toxic against other documents is taken with an informative Dirichlet prior
   (the token's overall rate). Tokens that are not clearly associated (|z| below
   ``z_min``) score 0. A constant ``drift`` is subtracted, so that ordinary text
   has a negative expected score.
2. Segments. A linear-time scan (Ruzzo-Tompa) over a text's token scores finds
   all maximal-scoring passages.
3. Calibration. Scores are scaled by the extreme-value parameter lambda, the
   root of E[exp(lambda s)] = 1 over non-toxic tokens, which makes
   lambda*S - ln(K n) a length-corrected log of the E-value. A logistic fit of
   out-of-fold statistics turns it into a probability.

Bounds: the fit uses at most ``sample`` labelled rows (chosen by a hash of the
id), tokens share ``2**BITS`` buckets, so what reaches the driver and what is
broadcast has a fixed size. Scoring covers every text whole.

Defined results: null and empty texts have no segment and get the calibrated
score of that case; null labels are ignored, several labels of one id count as
toxic if one is; without both classes in the labels every score is the share
of toxic rows (0 without labels); equal rows get equal scores; extra columns
are ignored; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import text as tx
from .tables import column_of, id_remainder, positional

BITS = 18
FOLDS = 4
SEGMENT = "array<struct<start:long,end:long,log_evalue:double>>"
SCHEMA = f"doc_id long, held_out boolean, score double, predicted int, segments {SEGMENT}"


@dataclass(frozen=True)
class Model:
    token: np.ndarray  # float32 score of each bucket
    scale: float  # lambda
    weights: np.ndarray  # logistic weights of (1, best, total)


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - BITS)).astype(np.int64)


def _count(frame: DataFrame) -> DataFrame:
    """(cell, n): in how many texts each cell (fold, toxic, bucket) occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = tx.utf8(batch.column(0))
            part = np.asarray(batch.column(1)) * 2 + np.asarray(batch.column(2))
            for lo, hi in tx.chunks(texts):
                w = tx.Words(tx.Buffer(texts[lo:hi], lower=True), tx.ALNUM)
                doc = w.text_of()
                once = tx.distinct((doc << BITS) | _bucket(w.hash))
                cells, n = np.unique((part[lo:hi][once >> BITS] << BITS) | (once & ((1 << BITS) - 1)), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(n)], names=["cell", "n"])

    return frame.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))


def token_scores(toxic: np.ndarray, other: np.ndarray, prior: float = 0.2, z_min: float = 2.5, drift: float = 0.3) -> tuple[np.ndarray, float]:
    """Score of each bucket and lambda, from occurrence counts by class."""
    total = toxic + other
    n1, n0 = toxic.sum(), other.sum()
    seen = np.flatnonzero(total)
    a = prior * total[seen]
    a0 = prior * (n1 + n0)
    delta = np.log((toxic[seen] + a) / (n1 + a0)) - np.log((other[seen] + a) / (n0 + a0))
    z = delta / np.sqrt(1 / (toxic[seen] + a) + 1 / (other[seen] + a))
    out = np.full(len(total), -drift, np.float32)
    out[seen] = np.where(np.abs(z) >= z_min, delta, 0) - drift
    p, s = other[seen] / max(n0, 1), out[seen].astype(np.float64)
    lo, hi = 1e-3, 8.0  # without positive tokens in other texts there is no root
    for _ in range(60):  # the mean of exp(lambda s) passes 1 once for lambda > 0
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if (p * np.exp(np.minimum(mid * s, 50))).sum() < 1 else (lo, mid)
    return out, lo


def maximal_segments(at: list[int], before: list[float], after: list[float]) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (start, end, score) of a sequence, from the
    positions of its positive items and the cumulative sums before and after
    each of them. Amortised linear: an item joins each segment once."""
    out: list[tuple[int, int, float, float]] = []  # start, end, sum before, sum after
    for p, lo, hi in zip(at, before, after, strict=True):
        start = p
        while True:
            j = len(out) - 1
            while j >= 0 and out[j][2] >= lo:
                j -= 1
            if j < 0 or out[j][3] >= hi:
                out.append((start, p + 1, lo, hi))
                break
            start, lo = out[j][0], out[j][2]
            del out[j:]
    return [(a, b, hi - lo) for a, b, lo, hi in out]


def segments(token: np.ndarray, texts: list[bytes | None]) -> tuple[np.ndarray, list[list[tuple[int, int, float]]]]:
    """Words of each text, and its maximal segments in word positions."""
    w = tx.Words(tx.Buffer(texts, lower=True), tx.ALNUM)
    s = token[_bucket(w.hash)]
    run = np.r_[0.0, np.cumsum(s, dtype=np.float64)]
    at = np.flatnonzero(s > 0)
    text = np.searchsorted(w.ptr, at, side="right") - 1
    found: list[list[tuple[int, int, float]]] = [[] for _ in texts]
    cut = np.flatnonzero(np.diff(text)) + 1
    for own in np.split(at, cut) if len(at) else []:
        d = int(np.searchsorted(w.ptr, own[0], side="right") - 1)
        base = int(w.ptr[d])
        found[d] = maximal_segments((own - base).tolist(), run[own].tolist(), run[own + 1].tolist())
    return np.diff(w.ptr), found


def _statistics(scale: float, n_words: np.ndarray, found: list[list[tuple[int, int, float]]], k: float = 0.1) -> tuple[np.ndarray, list[list[tuple[int, int, float]]]]:
    """(best, total) log E-value statistics of each text, and its segments of
    E-value under 1 with their log E-values."""
    best, total, kept = np.full(len(found), -12.0), np.zeros(len(found)), []
    for i, own in enumerate(found):
        base = np.log(k * max(int(n_words[i]), 1))
        value = [scale * s - base for _, _, s in own]
        if value:
            best[i] = np.clip(max(value), -12, 30)
            total[i] = np.log1p(sum(v for v in value if v > 0))
        kept.append([(a, b, -v) for (a, b, _), v in zip(own, value, strict=True) if v > 0])
    return np.stack([np.ones(len(found)), best / 10, total], 1), kept


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    b = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(b)), x.T @ (y - p) - ridge * b)
        b += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return b


def fit(docs: DataFrame, labels: DataFrame, sample: int = 20_000) -> Model:
    """Learn from at most ``sample`` labelled rows whose id is not held out."""
    rest = id_remainder("doc_id", 5)
    chosen = (labels.selectExpr("CAST(doc_id AS LONG) doc_id", "CAST(toxic AS INT) toxic")
              .where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (rest != 0))
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    rows = (docs.selectExpr("CAST(doc_id AS LONG) doc_id", "CAST(text AS STRING) text")
            .join(F.broadcast(chosen), "doc_id")  # at most ``sample`` rows of 12 bytes
            .select("text", (rest - 1).cast("long").alias("fold"), (F.col("toxic") > 0).cast("long").alias("toxic")))
    counts = np.zeros(FOLDS * 2 << BITS)
    cells = _count(rows).selectExpr("CAST(cell AS INT) cell", "CAST(n AS INT) n").toArrow()  # at most as many as counts
    counts[cells["cell"].to_numpy()] = cells["n"].to_numpy()
    del cells
    counts = counts.reshape(FOLDS, 2, 1 << BITS)
    both = counts.sum(0)
    token, scale = token_scores(both[1], both[0])
    without = []
    for f in range(FOLDS):
        less = both - counts[f]
        without.append(token_scores(less[1], less[0]) if less[1].any() and less[0].any() else (token, scale))
    folds = docs.sparkSession.sparkContext.broadcast(without)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = folds.value
        for batch in batches:
            texts, fold, y = tx.utf8(batch.column(0)), np.asarray(batch.column(1)), np.asarray(batch.column(2))
            for f in range(FOLDS):
                own = np.flatnonzero(fold == f)
                mine = [texts[i] for i in own]
                for lo, hi in tx.chunks(mine):
                    x, _ = _statistics(models[f][1], *segments(models[f][0], mine[lo:hi]))
                    yield pa.RecordBatch.from_arrays([pa.array(x[:, 1]), pa.array(x[:, 2]), pa.array(y[own[lo:hi]])], names=["best", "total", "toxic"])

    got = rows.mapInArrow(run, "best double, total double, toxic long").toPandas()
    folds.destroy()
    y = got["toxic"].to_numpy(float)
    if not 0 < y.sum() < len(y):
        share = float(y.mean()) if len(y) else 0.0
        weights = np.array([np.log(max(share, 1e-9) / max(1 - share, 1e-9)), 0.0, 0.0])
    else:
        weights = _logistic(np.stack([np.ones(len(y)), got["best"], got["total"]], 1), y)
    return Model(token, scale, weights)


def score_texts(model: Model, texts: list[bytes | None]) -> tuple[np.ndarray, list[list[tuple[int, int, float]]]]:
    """Probability and significant segments of each text."""
    scores, kept = [], []
    for lo, hi in tx.chunks(texts):
        x, own = _statistics(model.scale, *segments(model.token, texts[lo:hi]))
        scores.append(1 / (1 + np.exp(-np.clip(x @ model.weights, -30, 30))))
        kept += own
    return np.concatenate(scores) if scores else np.zeros(0), kept


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``SCHEMA`` for each row of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ["doc_id", "held_out", "score", "predicted", "segments"]
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("log_evalue", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p, own = score_texts(shared.value, tx.utf8(batch.column(2)))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32)),
                pa.array([[dict(zip(("start", "end", "log_evalue"), s, strict=True)) for s in x] for x in own], kind)], names=names)

    return (docs.selectExpr("CAST(doc_id AS LONG) doc_id", "CAST(text AS STRING) text")
            .select("doc_id", (id_remainder("doc_id", 5) == 0).alias("held_out"), "text").mapInArrow(run, SCHEMA))


def drop_toxic(docs: DataFrame, model: Model, text: str = "text", limit: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score under ``limit``, unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows, names = positional(docs)
    i_text = rows.columns.index(column_of(names, text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p, _ = score_texts(shared.value, tx.utf8(batch.column(i_text)))
            yield batch.filter(pa.array(p < limit))

    return rows.mapInArrow(run, rows.schema).toDF(*names)
