"""LM scoring with a hashed maximum-entropy model (operator 6).

P(word | words before) = P(class | before) * P(place | class, before) * P(word |
place). Words are ranked by count and cut into ``CLASSES - 2`` classes of equal
mass; the end of a text is a class of its own, and so are all words outside the
table of frequent words. In a class, the ``PLACES - 1`` most frequent words
have places of their own and the others share the last place. Both conditional
factors are softmaxes over at most 32 outcomes whose logits are the log prior
(add-one counts) plus the weights of hashed features of the words before:
n-grams (1; 1,2) and a skip (2), in which words beyond the most frequent
ones are read as their classes. A feature names a row of 32 weights; in the
second factor every class has rows of its own. Words that share a place or the
last class have its probability by their add-one counts, unseen words included.

1. One pass over the training texts counts words; Spark sums them, so counts
   grow with the corpus and are exact.
2. Start: with weights 0 the expected outcomes of a feature row are its tokens times
   the prior, so the tasks only count observed outcomes by row (blocks of rows are
   summed in a tree of groups of at most ``FAN_IN`` messages). The training starts
   where each row by itself would have the outcomes observed, with ``RIDGE``
   outcomes of the prior added.
3. Gradient updates, in ``SLICES`` steps, each over a share of the texts (every text
   is read in one step). Features that fire together share what they know, which
   one scale per factor and template takes into account: the tasks add up the
   scales' gradient and curvature under both softmaxes, and a Newton step follows.
   Then they add up the weights' gradient under both softmaxes (observed minus
   expected outcomes of each row, in the same tree), and every weight moves by
   ``RATE`` of its gradient over its curvature. Tokens of equal features share one
   softmax. The model has ``ROWS`` feature rows in each factor, whatever the
   corpus: a broadcast of the weights is 8 MB, a task's message 16 MB at most.
4. Scoring works in numpy batches. Counts of frequent words are broadcast (a
   count threshold keeps them under ``hot_words``); all other words go to Spark
   as (text, word) rows that join the count table. So every count is exact,
   however many words there are.

Gradients are sums of whole numbers, scales are rounded, and every text's sums are
taken by itself: the model does not depend on the order of tasks, nor a score on
neighbouring texts.
Words are told apart by 64-bit hashes.

Defined results: null and empty texts are one end token; equal rows give equal
rows; a null id counts as the empty text in the fold rule; without training
texts all counts are 0 and the outcomes are even; extra columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import text as tx
from .tables import checkpointed, id_remainder
from .text import Lookup

CLASSES = PLACES = 32
END, OTHER = CLASSES - 2, CLASSES - 1
END_HASH = np.uint64(0x454E44)
#: the words before (counted back) that each feature reads
TEMPLATES = ((1,), (1, 2), (2,))
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)
#: feature rows of each factor, under 1 << 16
ROWS = 1 << 15
RIDGE, MOST_WEIGHT = 20.0, 6.0
RATE, MOST_STEP = 0.25, 1.0
SLICES, BLOCK, FAN_IN = 2, 256, 32
#: expected outcomes are summed as whole multiples of 1 / UNIT, times scales as such of 1 / GRAIN
UNIT, GRAIN, _STEP = 1 << 12, 1 << 7, 1 << 13


class Tokens:
    """Words of some texts with an end token after each text's words."""

    def __init__(self, texts: list[bytes | None]):
        w = tx.Words(tx.Buffer(texts, lower=True), tx.SPACE)
        n = len(w.hash) + w.n
        self.ptr = w.ptr + np.arange(w.n + 1)
        word = np.ones(n, bool)
        word[self.ptr[1:] - 1] = False
        self.hash = np.full(n, END_HASH)
        self.hash[word] = w.hash
        self.place = np.arange(n) - np.repeat(self.ptr[:-1], np.diff(self.ptr))

    def back(self, code: np.ndarray, k: int, start: np.uint64) -> np.ndarray:
        """The code of the word k places before each token; before the first word
        stand end tokens."""
        out = np.full(len(code), start)
        out[k:] = code[: max(len(code) - k, 0)]
        out[self.place < k] = start
        return out


@dataclass(frozen=True)
class Model:
    hot: Lookup  # the frequent words
    rank: np.ndarray  # by count, from 0
    log_count: np.ndarray  # log10 (count + 1) of each
    cls: np.ndarray
    at: np.ndarray  # place in the class
    inner: np.ndarray  # log10 P(word | place)
    places: np.ndarray  # places that each class uses
    prior: np.ndarray  # log P of the classes, then of the places of each class
    log_other: float  # log10 of (tokens + types + 1) of the last class
    tokens: int
    types: int
    rows: int  # feature rows of a factor
    weight: np.ndarray  # rows of the class factor, then those of the place factor
    scale: np.ndarray  # of each factor's templates

    def known_words(self, reads: int) -> int:
        """How many of the most frequent words features of that many words tell
        apart: so many that their rows do not crowd each other out."""
        return self.rows // 4 if reads == 1 else int(2 * self.rows ** 0.5)

    def features(self, t: Tokens, number: np.ndarray, cls: np.ndarray) -> list[np.ndarray]:
        """64-bit hashes of each token's features, one array per template. A word
        beyond ``known_words`` is read as its class."""
        by_class = tx.mix(np.arange(1, CLASSES + 1, dtype=np.uint64))[cls]
        rank = np.where(number >= 0, self.rank[number], len(self.rank)) if len(self.rank) else np.zeros(len(number), np.int64)
        back = {}
        for n in {len(reads) for reads in TEMPLATES}:
            code = np.where((number >= 0) & (rank < self.known_words(n)) | (cls == END), t.hash, by_class)
            back |= {(n, k): t.back(code, k, END_HASH) for k in {k for reads in TEMPLATES if len(reads) == n for k in reads}}
        out = []
        for i, reads in enumerate(TEMPLATES):
            h = np.full(len(number), i + 1, np.uint64)
            for r in reads:
                h = (h ^ back[len(reads), r]) * np.uint64(_MULTIPLIERS[r])
            out.append(h)
        return out

    def rows_of(self, t: Tokens, number: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]]:
        """For each factor: the tokens that have a choice, the outcome taken, the
        row of the prior, and feature rows (one array per template)."""
        cls = np.where(number >= 0, self.cls[number], OTHER) if len(self.cls) else np.full(len(number), OTHER)
        place = self.at[number] if len(self.at) else np.zeros(len(number), np.int64)
        feature = self.features(t, number, cls)
        half, own = np.uint64(32), self.rows // CLASSES
        low = [((f >> half) * np.uint64(self.rows) >> half).astype(np.int64) for f in feature]
        open_ = np.flatnonzero(self.places[cls] > 1)
        mine = cls[open_]
        high = [((f[open_] * np.uint64(_MULTIPLIERS[0]) >> half) * np.uint64(own) >> half).astype(np.int64) + self.rows + mine * own for f in feature]
        return [(np.arange(len(number)), cls, np.zeros(len(number), np.int64), low), (open_, place[open_], 1 + mine, high)]

    def blocks(self, t: Tokens, number: np.ndarray):
        """The choices of ``rows_of``, some at a time, after their factor."""
        for k, (at, taken, prior, rows) in enumerate(self.rows_of(t, number)):
            for lo in range(0, len(at), _STEP):
                s = slice(lo, lo + _STEP)
                yield k, at[s], taken[s], prior[s], [r[s] for r in rows]

    def parts(self, rows: list[np.ndarray]) -> list[np.ndarray]:
        return [self.weight.take(r, 0) for r in rows]

    def probabilities(self, k: int, prior: np.ndarray, parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Logits and their exponentials. Weights are bounded, so no shift is needed."""
        z = self.prior.take(prior, 0)
        for x, scale in zip(parts, self.scale[k], strict=True):
            z += x * np.float32(scale)
        return z, np.exp(z)

    def log_probability(self, t: Tokens, number: np.ndarray) -> np.ndarray:
        """log10 P of each token, but for words of the last class: log10 P of
        that class over its room."""
        out = np.zeros(len(number))
        for k, at, taken, prior, rows in self.blocks(t, number):
            z, e = self.probabilities(k, prior, self.parts(rows))
            out[at] += (z[np.arange(len(at)), taken] - np.log(e @ _ONES)) / np.log(10)
        if len(self.inner):
            out += np.where(number >= 0, self.inner[number], 0)
        out[number < 0] -= self.log_other
        return out


_ONES = np.ones(CLASSES, np.float32)


def count_words(training: DataFrame) -> DataFrame:
    """(key, n) of all tokens, counted per task and summed by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = tx.utf8(batch.column(0))
            for lo, hi in tx.chunks(texts, 8 << 20):
                h, _, number = tx.numbered(Tokens(texts[lo:hi]).hash)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(np.bincount(number, minlength=len(h)))], names=["key", "n"])

    return training.select("text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _pack(x: np.ndarray) -> bytes:
    """Whole numbers by byte planes, signs in the lowest bit: most planes are zero."""
    return ((x << 1) ^ (x >> 63)).reshape(-1, 1).view(np.uint8).T.tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    z = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()
    return (z >> np.uint64(1)).view(np.int64) ^ -(z & np.uint64(1)).view(np.int64)


def _tree(sums: DataFrame, tasks: int, add, schema: str) -> DataFrame:
    """Messages (block, task, ...) added up block by block, at most ``FAN_IN`` at a time."""
    while tasks > 1:
        sums = sums.groupBy("block", F.floor(F.col("task") / FAN_IN).alias("group")).applyInArrow(add, schema)
        tasks = -(-tasks // FAN_IN)
    return sums


def _by_row(texts: DataFrame, model: Model, count, limit: int) -> np.ndarray:
    """Whole numbers by feature row and outcome, summed over all tokens of ``texts``:
    ``count(model, tokens, numbers, total)`` adds those of some texts."""
    shared = texts.sparkSession.sparkContext.broadcast(model)
    schema = "block long, task long, n binary"

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        m = shared.value
        total = np.zeros(m.weight.size, np.int64)
        for batch in batches:
            texts = tx.utf8(batch.column(0))
            for lo, hi in tx.chunks(texts, limit):
                t = Tokens(texts[lo:hi])
                count(m, t, m.hot.find(t.hash), total)
        task, size = TaskContext.get().partitionId(), BLOCK * CLASSES
        for b in range(0, len(total), size):
            n = total[b : b + size]
            if n.any():
                yield pa.RecordBatch.from_arrays([pa.array([b // size]), pa.array([task], pa.int64()), pa.array([_pack(n)], pa.binary())], names=["block", "task", "n"])

    def add(frame: pa.Table) -> pa.Table:
        n = sum(_unpack(x.as_py()) for x in frame["n"])
        return pa.table({"block": frame["block"][:1], "task": pa.array([frame["task"][0].as_py() // FAN_IN]), "n": pa.array([_pack(n)], pa.binary())})

    sums = _tree(texts.mapInArrow(part, schema), texts.rdd.getNumPartitions(), add, schema)
    out = np.zeros((len(model.weight) // BLOCK, BLOCK * CLASSES), np.int64)
    for r in sums.select("block", "n").toLocalIterator():  # one block of rows at a time
        out[r["block"]] = _unpack(bytes(r["n"]))
    shared.destroy()
    return out.reshape(-1, CLASSES)


def _count_observed(m: Model, t: Tokens, number: np.ndarray, total: np.ndarray) -> None:
    for _, taken, _, rows in m.rows_of(t, number):
        for r in rows:
            total += np.bincount(r * CLASSES + taken, minlength=len(total))


def observe(texts: DataFrame, model: Model) -> np.ndarray:
    """Observed outcomes of each feature row over all tokens of ``texts``."""
    return _by_row(texts, model, _count_observed, 4 << 20)


def _contexts(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """One token for each distinct combination of feature rows (all that a softmax
    depends on), and their counts."""
    key = np.zeros(len(rows[0]), np.int64)
    for r in rows:
        key = key * (2 * ROWS) + r
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    return order[first], np.diff(np.r_[first, len(key)])


def _count_misses(m: Model, t: Tokens, number: np.ndarray, total: np.ndarray) -> None:
    for k, (_, taken, prior, rows) in enumerate(m.rows_of(t, number)):
        times_scale = np.rint(m.scale[k] * GRAIN).astype(np.int64)
        for scale, r in zip(times_scale, rows, strict=True):
            np.add.at(total, r * CLASSES + taken, scale * UNIT)
        one, times = _contexts(rows)
        for lo in range(0, len(one), _STEP):
            at, n = one[lo : lo + _STEP], times[lo : lo + _STEP, None]
            own = [r[at] for r in rows]
            _, p = m.probabilities(k, prior[at], m.parts(own))
            p /= p.sum(1, keepdims=True)  # row by row: the same whatever rows stand beside it
            expected = np.rint(p * np.float32(UNIT)).astype(np.int64) * -n
            for scale, r in zip(times_scale, own, strict=True):
                cells = r[:, None] * CLASSES + np.arange(CLASSES)
                np.add.at(total, cells.ravel(), (expected * scale).ravel())


def gradient(texts: DataFrame, model: Model) -> np.ndarray:
    """The weights' gradient over all tokens of ``texts`` (UNIT * GRAIN = 1): observed
    minus expected outcomes of each feature row under both softmaxes, times the scale of
    the template that names the row."""
    return _by_row(texts, model, _count_misses, 4 << 20)


def _row_priors(model: Model) -> np.ndarray:
    """The prior of each row: one for the class factor, one per class for the places."""
    own = np.r_[np.zeros(model.rows, np.int64), 1 + np.arange(model.rows) // (model.rows // CLASSES)]
    return np.exp(model.prior.astype(np.float64))[own]


def first_weights(seen: np.ndarray, model: Model) -> np.ndarray:
    """Where the gradient updates start: log ratios of observed to expected outcomes
    of each row, both with ``RIDGE`` outcomes of the prior added; 0 where the prior
    has no mass."""
    p = _row_priors(model)
    with np.errstate(divide="ignore", invalid="ignore"):
        w = np.log((seen + RIDGE * p) / ((seen.sum(1, keepdims=True) + RIDGE) * p))
    return np.where(p > 0, np.clip(w, -MOST_WEIGHT, MOST_WEIGHT), 0).astype(np.float32)


def moved(model: Model, slope: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """The weights after a gradient step. A weight's curvature is its outcomes
    (observed ones, ``RIDGE`` of the prior added, in one share of the texts) times
    its factor's squared scale."""
    p = _row_priors(model)
    square = np.repeat(np.maximum((model.scale**2).mean(1), 0.05), model.rows)[:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        step = RATE * (slope / (UNIT * GRAIN)) / ((seen + RIDGE * p) / SLICES * square)
    step = np.where(p > 0, np.clip(step, -MOST_STEP, MOST_STEP), 0)
    return np.clip(model.weight + step, -MOST_WEIGHT, MOST_WEIGHT).astype(np.float32)


def newton(texts: DataFrame, model: Model) -> np.ndarray:
    """The scales after a Newton step over all tokens of ``texts``."""
    shared, n = texts.sparkSession.sparkContext.broadcast(model), len(TEMPLATES)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        slope, bend = np.zeros((2, n)), np.zeros((2, n, n))
        for batch in batches:
            texts = tx.utf8(batch.column(0))
            for lo, hi in tx.chunks(texts, 4 << 20):
                t = Tokens(texts[lo:hi])
                for k, (_, taken, prior, rows) in enumerate(m.rows_of(t, m.hot.find(t.hash))):
                    for i, r in enumerate(rows):
                        slope[k, i] += m.weight.ravel().take(r * CLASSES + taken).sum(dtype=np.float64)
                    one, times = _contexts(rows)
                    for start in range(0, len(one), _STEP):
                        at, c = one[start : start + _STEP], times[start : start + _STEP].astype(np.float64)
                        parts = m.parts([r[at] for r in rows])
                        _, p = m.probabilities(k, prior[at], parts)
                        p /= (p @ _ONES)[:, None]
                        mean = [(x * p) @ _ONES for x in parts]
                        for i, x in enumerate(parts):
                            slope[k, i] -= mean[i] @ c
                            for j in range(i + 1):
                                bend[k, i, j] += (np.einsum("ij,ij,ij->i", x, parts[j], p) - mean[i] * mean[j]) @ c
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[slope.ravel(), bend.ravel()]), pa.array(np.arange(2 * n + 2 * n * n))], names=["x", "i"])

    got = texts.mapInArrow(part, "x double, i long").groupBy("i").agg(F.sum("x").alias("x")).orderBy("i").collect()
    shared.destroy()
    x = np.array([r["x"] for r in got]) if got else np.zeros(2 * n + 2 * n * n)
    slope, bend = x[: 2 * n].reshape(2, n), x[2 * n :].reshape(2, n, n)
    out = model.scale.copy()
    for k in range(2):
        h = np.tril(bend[k]) + np.tril(bend[k], -1).T
        out[k] += np.linalg.solve(h + np.eye(n), slope[k])
    return np.round(np.clip(out, 0, 2) * 4096) / 4096


def train(texts: DataFrame, model: Model) -> Model:
    """The model with weights and scales fitted to ``texts`` (text)."""
    seen = observe(texts, model)
    model = replace(model, weight=first_weights(seen, model))
    share = F.pmod(F.xxhash64(F.lit("share"), "text"), F.lit(SLICES))
    for k in range(SLICES):
        mine = texts.where(share == k).select("text")
        model = replace(model, scale=newton(mine, model))
        model = replace(model, weight=moved(model, gradient(mine, model), seen))
    return model


def _log(x: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.log(x)


def layout(keys: np.ndarray, count: np.ndarray, rest: int) -> dict[str, np.ndarray]:
    """Classes and places of the frequent words, and the priors. ``rest`` is the
    add-one mass of all other words."""
    mass = count + 1.0
    end = keys == END_HASH
    order = np.lexsort((keys, -mass, end))  # the end token last
    words = order[: len(order) - int(end.sum())]
    before = np.cumsum(mass[words]) - mass[words]
    cls, at = np.full(len(keys), END), np.zeros(len(keys), np.int64)
    if len(words):
        cls[words] = np.minimum(before * (CLASSES - 2) / mass[words].sum(), CLASSES - 3).astype(np.int64)
        first = np.searchsorted(cls[words], np.arange(CLASSES))
        at[words] = np.minimum(np.arange(len(words)) - first[cls[words]], PLACES - 1)
    by_place = np.zeros((CLASSES, PLACES))
    np.add.at(by_place, (cls, at), mass)
    by_class = by_place.sum(1)
    inner = np.log10(mass / np.maximum(by_place[cls, at], 1)) if len(keys) else np.zeros(0)
    by_class[OTHER] = rest
    if not end.any():
        by_class[END] = 1
    prior = np.zeros((1 + CLASSES, CLASSES))
    prior[0] = by_class / by_class.sum()
    prior[1:] = np.where(by_class[:, None] > 0, by_place / np.maximum(by_place.sum(1, keepdims=True), 1), 0)
    # classes without places have none to choose from
    prior[1:][by_place.sum(1) == 0] = 1 / PLACES
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.arange(len(keys))
    return {"rank": rank, "cls": cls, "at": at, "places": (by_place > 0).sum(1), "inner": inner, "prior": _log(prior).astype(np.float32)}


def fit(docs: DataFrame, hot_words: int = 1 << 18) -> tuple[Model, DataFrame]:
    """The model, and the count table (key, n) of the words that it does not hold."""
    rows = docs.selectExpr("CAST(doc_id AS LONG) doc_id", "CAST(text AS STRING) text").where(id_remainder("doc_id", 7) != 2).select("text")
    words = checkpointed(count_words(rows))
    level = F.floor(F.log2("n") * 8)
    stats = words.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("types"), F.sum("n").alias("tokens")).collect()  # some hundred rows
    least, held = 1 << 30, 0
    for r in sorted(stats, key=lambda r: -r["level"]):
        held += r["types"]
        if held > hot_words:
            break
        least = r["level"]
    hot = words.where(level >= least).toArrow()  # at most ``hot_words`` rows
    key, count = hot["key"].to_numpy().view(np.uint64), hot["n"].to_numpy()
    order = np.argsort(key)
    key, count = key[order], count[order]
    tokens, types = sum(r["tokens"] for r in stats), sum(r["types"] for r in stats)
    other = tokens - int(count.sum()) + types - len(key) + 1
    model = Model(hot=Lookup(key), log_count=np.log10(count + 1.0), **layout(key, count, other), log_other=float(np.log10(other)), tokens=tokens, types=types,
                  rows=ROWS, weight=np.zeros((2 * ROWS, CLASSES), np.float32), scale=np.full((2, len(TEMPLATES)), 0.5))
    if tokens:
        model = train(rows, model)
    return model, words.where(level < least)


def _score_batch(model: Model, texts: list[bytes | None]) -> dict[str, np.ndarray]:
    """Sums over each text's tokens, and the words outside the model's table as
    (doc, word, tf)."""
    t = Tokens(texts)
    number = model.hot.find(t.hash)
    known = number >= 0
    count = np.where(known, model.log_count[number], 0.0) if len(model.log_count) else np.zeros(len(number))
    rest = np.flatnonzero(~known)
    doc = np.repeat(np.arange(len(texts)), np.diff(t.ptr))[rest]
    order = np.lexsort((t.hash[rest], doc))
    d, h = doc[order], t.hash[rest][order]
    first = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (d[1:] != d[:-1])]) if len(order) else np.zeros(0, np.int64)
    # every text has an end token, so no text's stretch is empty
    by_text = lambda x: np.add.reduceat(x, t.ptr[:-1])
    return {"n": np.diff(t.ptr), "known": by_text(known.astype(np.int64)), "log_count": by_text(count), "model": by_text(model.log_probability(t, number)),
            "doc": d[first], "word": h[first], "tf": np.diff(np.r_[first, len(order)])}


def score(docs: DataFrame, model: Model, rare: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ["doc_id", "text_hash", "word", "tf", "n", "known", "log_count", "model"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = tx.utf8(batch.column(2))
            for lo, hi in tx.chunks(texts, 2 << 20):
                m = _score_batch(shared.value, texts[lo:hi])
                ids, hashes = batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo)
                none = pa.nulls(hi - lo, pa.int64())
                yield pa.RecordBatch.from_arrays([ids, hashes, none, none, pa.array(m["n"]), pa.array(m["known"]), pa.array(m["log_count"]), pa.array(m["model"])], names=names)
                k = pa.array(m["doc"])
                yield pa.RecordBatch.from_arrays([ids.take(k), hashes.take(k), pa.array(m["word"].view(np.int64)), pa.array(m["tf"]),
                                                  *(pa.nulls(len(k), x) for x in (pa.int64(), pa.int64(), pa.float64(), pa.float64()))], names=names)

    # two word kinds in one stream: a row per text with its sums, and a row per rare (text, word)
    rows = (docs.selectExpr("CAST(doc_id AS LONG) doc_id", "CAST(text AS STRING) text")
            .select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
            .mapInArrow(run, "doc_id long, text_hash long, word long, tf long, n long, known long, log_count double, model double"))
    # text rows have no word: a salt in place of it keeps them from meeting in one task
    counted = rows.withColumn("key", F.coalesce("word", F.xxhash64("doc_id", "text_hash", F.lit("text")))).join(
        rare.select("key", F.col("n").alias("c")), "key", "left")
    c = F.when(F.col("word").isNotNull(), F.coalesce("c", F.lit(0)))
    per = counted.groupBy("doc_id", "text_hash").agg(
        F.count("n").alias("same"), F.sum("n").alias("n"), F.sum("known").alias("known"), F.sum("log_count").alias("log_count"), F.sum("model").alias("model"),
        F.sum(F.when(c > 0, F.col("tf"))).alias("rare_known"), F.sum(F.when(c > 0, F.col("tf") * F.log10(c + 1.0))).alias("rare_log"))
    # equal rows were summed up: share the sums out again
    of = {k: (F.coalesce(k, F.lit(0)) / F.col("same")) for k in ("n", "known", "log_count", "model", "rare_known", "rare_log")}
    n = F.round(of["n"]).cast("long")
    total = F.lit(float(np.log10(model.tokens + model.types + 1)))
    return per.select(
        "doc_id", (id_remainder("doc_id", 7) == 2).alias("held_out"), n.alias("n_tokens"),
        F.round(of["known"] + of["rare_known"]).cast("long").alias("n_known"), F.lit(model.tokens).cast("long").alias("train_tokens"),
        (of["log_count"] + of["rare_log"] - n * total).alias("base_score"), (of["model"] + of["rare_log"]).alias("score"),
        F.explode(F.array_repeat(F.lit(1), F.col("same").cast("int"))).alias("__copy")).drop("__copy")
