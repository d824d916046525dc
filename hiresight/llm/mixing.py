"""Mixing sources to target weights by soft membership (operator 8).

1. A labelled table (doc_id, domain) trains a multinomial logistic classifier
   on hashed words and a few text statistics. It is fitted on at most
   ``sample`` labelled rows, chosen by a hash of the id.
2. Every document gets domain posteriors, rounded to ``1 / GRID``.
3. Nonnegative rates are fitted by projected-gradient least squares, so that
   the expected domain token totals, sum(rate * tokens * posterior), match the
   targets. A step depends on a document's posteriors only, so documents are
   summed by their rounded posteriors first (at most the grid's points), and
   each step is one Spark aggregate over these sums. A document's rate is the
   fold of the steps, computed as a column.
4. A document's copies are floor(rate), plus one with the chance of the rest
   by a hash of its id.

Defined results: null and empty texts have 0 tokens, get the posteriors of
their statistics and a rate; null labels are ignored, of several domains of an
id the least counts; without labels the posteriors are even; domains that no
document belongs to cannot be reached and keep their error; equal rows get
equal rates; extra columns are ignored (``mix`` keeps them); empty tables give
empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import text as tx
from .tables import checkpointed, column_of, positional, stored

BITS = 12
DENSE = 7
GRID = 200
_SYMBOL = tx.separators(b"#*$%&|<>!")
_UPPER = tx.separators(bytes(range(0x41, 0x5B)))


def features(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows (ptr, index, value) of hashed words and statistics, and the
    number of words. Word values are log frequencies of unit length per text."""
    buf = tx.Buffer(texts)
    w = tx.Words(buf, tx.SPACE)
    n = np.diff(w.ptr)
    doc = w.text_of()
    cells, count = np.unique((doc << BITS) | (w.hash >> np.uint64(64 - BITS)).astype(np.int64), return_counts=True)
    who, index = cells >> BITS, cells & ((1 << BITS) - 1)
    value = np.log1p(count)
    norm = np.sqrt(np.bincount(who, value * value, len(texts)))
    value = value / np.maximum(norm, 1e-12)[who]
    size = np.maximum(buf.offset[1:] - buf.offset[:-1] - 1, 1)

    def share(table: np.ndarray) -> np.ndarray:
        c = np.zeros(len(buf.bytes) + 1, np.int64)
        np.cumsum(table[buf.bytes], out=c[1:])
        return (c[buf.offset[1:] - 1] - c[buf.offset[:-1]]) / size

    distinct = np.bincount(tx.distinct((doc << 40) | (w.hash >> np.uint64(24)).astype(np.int64)) >> 40, minlength=len(texts))
    at, keys = w.ngrams(2)
    pairs = np.bincount(tx.distinct((doc[at] << 40) | (keys >> np.uint64(24)).astype(np.int64)) >> 40, minlength=len(texts))
    dense = np.stack([np.ones(len(texts)), np.log1p(n) / 8, distinct / np.maximum(n, 1), pairs / np.maximum(n, 1),
                      10 * share(_SYMBOL), 4 * share(_UPPER), tx.sums(w.end - w.start, w.ptr) / np.maximum(n, 1) / 10], 1)
    # statistics come after the words
    width = np.bincount(who, minlength=len(texts))
    ptr = np.r_[0, np.cumsum(width + DENSE)]
    idx, val = np.empty(ptr[-1], np.int32), np.empty(ptr[-1], np.float32)
    place = np.arange(len(cells)) + DENSE * who
    idx[place], val[place] = index, value
    for k in range(DENSE):
        idx[ptr[1:] - DENSE + k], val[ptr[1:] - DENSE + k] = (1 << BITS) + k, dense[:, k]
    return ptr, idx, val, n


def _logits(ptr: np.ndarray, idx: np.ndarray, val: np.ndarray, weight: np.ndarray) -> np.ndarray:
    return np.add.reduceat(val[:, None] * weight[idx], ptr[:-1], axis=0) if len(ptr) > 1 else np.zeros((0, weight.shape[1]))


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


@dataclass(frozen=True)
class Classifier:
    domains: tuple[str, ...]
    weight: np.ndarray

    def posteriors(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """Integer posteriors (their sum is ``GRID``) and word counts."""
        ptr, idx, val, n = features(texts)
        p = _softmax(_logits(ptr, idx, val, self.weight)) * GRID
        q = np.floor(p).astype(np.int64)
        order = np.argsort(q - p, axis=1, kind="stable")  # largest remainders get the rest
        rank = np.argsort(order, axis=1, kind="stable")
        return q + (rank < (GRID - q.sum(1))[:, None]), n


def fit_classifier(docs: DataFrame, labelled: DataFrame, domains: list[str], sample: int = 5_000, steps: int = 300) -> Classifier:
    """Learn from at most ``sample`` rows of ``labelled`` (doc_id, domain)."""
    chosen = (labelled.selectExpr("CAST(doc_id AS LONG) doc_id", "CAST(domain AS STRING) domain")
              .where(F.col("doc_id").isNotNull() & F.col("domain").isin(list(domains)))
              .groupBy("doc_id").agg(F.min("domain").alias("domain"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    rows = (docs.selectExpr("CAST(doc_id AS LONG) doc_id", "CAST(text AS STRING) text")
            .join(F.broadcast(chosen), "doc_id").select("text", "domain"))  # at most ``sample`` ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = tx.utf8(batch.column(0))
            for lo, hi in tx.chunks(texts):
                ptr, idx, val, _ = features(texts[lo:hi])
                yield pa.RecordBatch.from_arrays([
                    batch.column(1).slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(ptr, pa.int32()), pa.array(idx)),
                    pa.ListArray.from_arrays(pa.array(ptr, pa.int32()), pa.array(val))], names=["domain", "idx", "val"])

    got = rows.mapInArrow(run, "domain string, idx array<int>, val array<float>").toArrow().combine_chunks()
    names = tuple(domains)
    weight = np.zeros(((1 << BITS) + DENSE, len(names)))
    if not got.num_rows:
        return Classifier(names, weight)
    lists = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in got.columns]
    y = np.array([names.index(d) for d in lists[0].to_pylist()])
    idx, val = lists[1].flatten().to_numpy(), lists[2].flatten().to_numpy()
    ptr = np.r_[0, np.cumsum(np.diff(lists[1].offsets.to_numpy()))]
    doc = np.repeat(np.arange(len(y)), np.diff(ptr))
    aim = np.eye(len(names))[y]
    rate = 1.0 / (np.bincount(idx, val * val, len(weight)) / len(y) + 1e-3)[:, None]
    speed = np.zeros_like(weight)
    for _ in range(steps):  # gradient descent with momentum, steps scaled by each feature's energy
        miss = _softmax(_logits(ptr, idx, val, weight)) - aim
        grad = np.stack([np.bincount(idx, val * miss[doc, k], len(weight)) for k in range(len(names))], 1) / len(y) + 1e-4 * weight
        speed = 0.9 * speed - 0.02 * rate * grad
        weight = weight + speed
    return Classifier(names, weight.astype(np.float32))


def memberships(docs: DataFrame, model: Classifier) -> DataFrame:
    """(doc_id, tokens, q): word count and posteriors (in ``1 / GRID``) of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = tx.utf8(batch.column(1))
            for lo, hi in tx.chunks(texts):
                q, n = shared.value.posteriors(texts[lo:hi])
                at = pa.array(np.arange(0, q.size + 1, q.shape[1]), pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(n, pa.int64()),
                                                  pa.ListArray.from_arrays(at, pa.array(q.ravel().astype(np.int32)))], names=["doc_id", "tokens", "q"])

    return docs.selectExpr("CAST(doc_id AS LONG) doc_id", "CAST(text AS STRING) text").mapInArrow(run, "doc_id long, tokens long, q array<int>")


@dataclass(frozen=True)
class Rates:
    """The steps of the fit, each with a weight per domain and its momentum;
    ``column`` folds them into a document's rate."""

    steps: list[list[float]]
    low: float
    high: float
    reached: list[float]  # domain token totals at these rates

    def fold(self, q: Column) -> Column:
        """Struct (r, y): the rate, and the point at which the next step starts."""
        start = F.lit(float(max(1.0, self.low)))
        if not self.steps:
            return F.struct(start.alias("r"), start.alias("y"))
        k = len(self.steps[0]) - 1

        def step(at: Column, s: Column) -> Column:
            dot = sum((q[i] * s[i] for i in range(1, k)), q[0] * s[0])
            r = F.greatest(F.lit(float(self.low)), F.least(F.lit(float(self.high)), at["y"] - dot / float(GRID)))
            return F.struct(r.alias("r"), (r + s[k] * (r - at["r"])).alias("y"))

        history = F.array(*(F.array(*map(F.lit, s)) for s in self.steps))
        return F.aggregate(history, F.struct(start.alias("r"), start.alias("y")), step)

    def column(self, q: Column) -> Column:
        return self.fold(q)["r"]


def fit_rates(members: DataFrame, targets: dict[str, float], total: float | None = None, low: float = 0.0, high: float | None = None, steps: int = 40, tolerance: float = 1e-4) -> Rates:
    """Rates in [low, high] whose expected domain token totals come closest to
    ``total`` times the (normalised) targets, by accelerated projected
    gradient. ``total`` None: the tokens there are, or more where no rate may
    fall below ``low``. ``high`` None: twice what the scarcest domain needs if
    every document were wholly of one domain; ``reached`` says what came out."""
    share = np.array([targets[d] for d in targets], float)
    share /= share.sum()
    k = len(share)
    sums = checkpointed(members.groupBy("q").agg(F.sum("tokens").cast("double").alias("t")))
    p = [F.col("q")[i] / float(GRID) for i in range(k)]

    def total_of(rows: DataFrame, values: list[Column]) -> np.ndarray:
        return np.array([x or 0.0 for x in rows.agg(*(F.sum(F.col("t") * v) for v in values)).first()], float)

    now = total_of(sums, p) * max(1.0, low)
    # the squares are measured in the metric of the domains' overlaps, in which a step of length 1 is stable
    overlap = total_of(sums, [x * y for x in p for y in p]).reshape(k, k)
    metric = np.linalg.pinv(overlap + 1e-9 * max(now.sum(), 1.0) * np.eye(k))
    if now.sum() <= 0:
        return Rates([], low, high if high is not None else max(1.0, low), [0.0] * k)
    if total is None:
        natural = now / max(1.0, low)
        total = max(natural.sum(), low * max((n / s for n, s in zip(natural, share, strict=True) if s > 0), default=0))
    aim, history, ahead = total * share, [], now
    if high is None:
        natural = total_of(sums, p)
        high = 2 * max([1.0, low, *(a / n for a, n in zip(aim, natural, strict=True) if n > 0)])
    for i in range(steps):
        if np.abs(now - aim).max() <= tolerance * total:
            break
        history.append([*(metric @ (ahead - aim)).tolist(), i / (i + 3.0)])
        rows = sums.select("q", "t", Rates(history, low, high, []).fold(F.col("q")).alias("at"))
        now, ahead = total_of(rows, [F.col("at")[x] * y for x in ("r", "y") for y in p]).reshape(2, k)
    return Rates(history, low, high, now.tolist())


def copies(rate: Column, key: Column) -> Column:
    """floor(rate), plus one where a hash of the id falls under the rest."""
    u = F.shiftrightunsigned(F.xxhash64(F.lit("mix"), key), 11).cast("double") / float(1 << 53)
    return (F.floor(rate) + F.when(u < rate - F.floor(rate), 1).otherwise(0)).cast("int")


def rate_documents(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], **options) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): tokens, one posterior ``p_<domain>``
    per domain, rate and copies, and ``share_<domain>``, the share of tokens that
    the domain reaches at these rates (the same in each row): a target that no
    rates reach shows there."""
    model = fit_classifier(docs, labelled, list(targets))
    rows = checkpointed(memberships(docs, model))
    rates = fit_rates(rows, targets, **options)
    return (rows.withColumn("rate", rates.column(F.col("q")))
            .select("doc_id", "tokens", *((F.col("q")[k] / float(GRID)).alias(f"p_{d}") for k, d in enumerate(targets)),
                    "rate", copies(F.col("rate"), F.col("doc_id")).alias("copies"),
                    *(F.lit(float(r / max(sum(rates.reached), 1e-300))).alias(f"share_{d}") for r, d in zip(rates.reached, targets, strict=True))))


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], **options) -> DataFrame:
    """Each row of ``docs`` as many times as its copies say. Every text is scored
    once: the rows are stored with their posteriors, and rates follow from those."""
    rows, names = positional(docs)
    id_, text = column_of(names, "doc_id"), column_of(names, "text")
    model = fit_classifier(rows.select(F.col(id_).alias("doc_id"), F.col(text).alias("text")), labelled, list(targets))
    shared, own = docs.sparkSession.sparkContext.broadcast(model), rows.columns
    i_text = own.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = tx.utf8(batch.column(i_text))
            parts = [shared.value.posteriors(texts[lo:hi]) for lo, hi in tx.chunks(texts)]
            q = np.concatenate([x for x, _ in parts]) if parts else np.zeros((0, len(targets)), np.int64)
            n = np.concatenate([x for _, x in parts]) if parts else np.zeros(0, np.int64)
            at = pa.array(np.arange(0, q.size + 1, len(targets)), pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n, pa.int64()), pa.ListArray.from_arrays(at, pa.array(q.ravel().astype(np.int32)))],
                                             names=[*own, "tokens", "q"])

    scored = stored(rows.mapInArrow(run, rows.withColumns({"tokens": F.lit(0).cast("long"), "q": F.array().cast("array<int>")}).schema))
    rates = fit_rates(scored.select("tokens", "q"), targets, **options)
    times = copies(rates.column(F.col("q")), F.col(id_).cast("long"))
    return scored.withColumn("copy", F.explode(F.array_repeat(F.lit(1), times))).select(*own).toDF(*names)


def label_domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) from the labels table: toxic, good or poor."""
    return labels.select("doc_id", F.when(F.col("toxic") > 0, "toxic").when(F.col("quality") > 0, "good").when(F.col("quality") <= 0, "poor").alias("domain"))
