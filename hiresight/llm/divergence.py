"""Source divergence audit by minimal-perfect-hash recount (operator 11).

How far do the sources of a language differ in their words, and which words
mark a source? Probabilities are smoothed word shares in units of 1e-9, and the
divergence of two of them is ``floor((p - q)^2 / (p + q))``, all in whole
numbers.

1. Frequency filter: each task counts, by language, the documents that hold a
   term; Spark sums by (language, term) and keeps the terms in at least
   ``min_docs`` documents. The count is exact: nothing is estimated.
2. Perfect hashes: a language's terms are dealt by hash over shards of about
   ``SHARD_TERMS``; a task builds each shard's minimal perfect hash (cascaded bit
   arrays with ranks) and stores the terms themselves in slot order.
3. Recount: the shards are broadcast, at most ``ROUND_BYTES`` at a time (the
   size is measured first; a larger vocabulary takes further passes over the
   texts). A perfect hash sends every word to some slot, so each distinct word
   of a piece is compared with the slot's stored term. Dense counts, one array
   of slots per (language, source) group, are flushed when a task holds
   ``MOST_CELLS`` of them; Spark sums the rest by (group, slot).
4. Scores: slots are dealt in blocks. A block holds all sources' counts of its
   terms; it gives each pair's part of the sum and each group's best terms.
   Sums and ranks over the blocks' results are Spark's.

Defined results: null text, language and source count as empty; a document is a
row; groups without terms and languages without kept terms still give their
pairs; ties are broken by the item's UTF-8 bytes; extra columns are ignored; an
empty table gives an empty result. Words are told apart by 64-bit hashes within
a piece; two kept terms of a language with one hash raise an error (a chance of
3e-6 with ten million terms). Counts up to 9e15 are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from . import text as tx
from .tables import checkpointed

#: ``[^\x00-\x40\x5B-\x60\x7B-\x7F]+`` terms of lower-cased text
TERM = tx.separators(bytes([*range(0x00, 0x61), *range(0x7B, 0x80)]))
UNIT = 1_000_000_000
SHARD_TERMS = 1 << 13
ROUND_BYTES = 64 << 20
MOST_CELLS = 1 << 22
BLOCK = 1 << 10
_PIECE = 4 << 20


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys: at each level the keys that
    fall alone into a bit stay there, the others go on. A key's slot is the
    number of set bits before its own."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.start = np.r_[0, np.cumsum(sizes)]
        self.before = np.r_[0, np.cumsum(np.bitwise_count(bits))[:-1]].astype(np.int64) if len(bits) else np.zeros(0, np.int64)

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (tx.mix(keys + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray, spread: float = 1.7) -> PerfectHash:
        if len(np.unique(keys)) < len(keys):
            raise ValueError("two terms share a 64-bit hash")
        sizes, levels = [], []
        while len(keys):
            size = int(spread * len(keys)) + 8
            at = cls._place(keys, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            levels.append(alone)
            keys = keys[~alone[at]]
        return cls(np.array(sizes, np.int64), np.packbits(np.concatenate(levels), bitorder="little") if levels else np.zeros(0, np.uint8))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; of a key outside the set any slot, or -1."""
        out, left = np.full(len(keys), -1), np.arange(len(keys))
        for level, size in enumerate(self.sizes.tolist()):
            if not len(left):
                break
            at = self._place(keys[left], level, size) + self.start[level]
            byte, bit = self.bits[at >> 3], (at & 7).astype(np.uint8)
            hit = (byte >> bit & 1).astype(bool)
            below = np.bitwise_count(byte & ((np.uint8(1) << bit) - np.uint8(1)))
            out[left[hit]] = (self.before[at >> 3] + below)[hit]
            left = left[~hit]
        return out


@dataclass(frozen=True)
class Shard:
    """A shard's hash with the stored terms of its slots."""

    first: int  # number of its slot 0
    hash: PerfectHash
    raw: np.ndarray
    offset: np.ndarray

    def find(self, keys: np.ndarray, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The slot of each word ``raw[start:end]`` that is a stored term, else -1."""
        out = np.full(len(keys), -1)
        slot = self.hash.slots(keys)
        known = np.flatnonzero(slot >= 0)
        known = known[self.offset[slot[known] + 1] - self.offset[slot[known]] == (end - start)[known]]
        a, of = tx.ragged(start[known], (end - start)[known])
        b, _ = tx.ragged(self.offset[slot[known]], (end - start)[known])
        differ = np.bincount(of[raw[a] != self.raw[b]], minlength=len(known))
        same = known[differ == 0]
        out[same] = slot[same] + self.first
        return out


class Piece:
    """The distinct words of some texts, and the number of each word."""

    def __init__(self, texts: list[bytes | None]):
        buf = tx.Buffer(texts, lower=True)
        self.words = tx.Words(buf, TERM)
        self.raw = buf.bytes
        self.key, at, self.number = tx.numbered(self.words.hash)
        self.start, self.end = self.words.start[at], self.words.end[at]


def _rows(docs: DataFrame, seed: int) -> DataFrame:
    empty = F.lit("")
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), empty).alias(c) for c in ("text", "lang", "source")))
    return rows.select("text", "lang", "source", F.xxhash64(F.lit(seed), "lang").alias("lid"), F.xxhash64(F.lit(seed), "lang", "source").alias("gid"))


def group_table(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The documents with numbers for language and group, and the table of the
    groups (lang, source, lid, gid), whose numbers are checked to differ."""
    for seed in range(16):
        rows = _rows(docs, seed)
        groups = checkpointed(rows.groupBy("lang", "source", "lid", "gid").agg(F.count(F.lit(1)).alias("docs")))
        n = groups.agg(F.count(F.lit(1)), F.count_distinct("gid"), F.count_distinct("lang"), F.count_distinct("lid")).first()
        if n[0] == n[1] and n[2] == n[3]:
            return rows, groups
    raise RuntimeError("no seed tells the groups apart")


def kept_terms(rows: DataFrame, min_docs: int) -> DataFrame:
    """(lid, term, key, docs) of the terms in at least ``min_docs`` rows of their language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lang = tx.utf8(batch.column(1)), batch.column(0).to_numpy()
            for lo, hi in tx.chunks(texts, _PIECE):
                p = Piece(texts[lo:hi])
                own, of = np.unique(lang[lo:hi], return_inverse=True)
                n = max(len(p.key), 1)
                once = tx.distinct(p.words.text_of() * n + p.number)  # a term counts once a document
                seen, docs = np.unique(of[once // n] * n + once % n, return_counts=True)
                word = seen % n
                yield pa.RecordBatch.from_arrays([pa.array(own[seen // n]), tx.strings(p.raw, p.start[word], p.end[word]), pa.array(p.key[word].view(np.int64)), pa.array(docs)],
                                                 names=["lid", "term", "key", "docs"])

    return rows.select("lid", "text").mapInArrow(run, "lid long, term string, key long, docs long").groupBy("lid", "term", "key").agg(
        F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs)


_INDEX = "lid long, shard int, shards int, sizes array<long>, bits binary, terms array<string>"


def build_index(terms: DataFrame) -> DataFrame:
    """One row per shard: its perfect hash and its terms in slot order."""
    # at most one row for SHARD_TERMS terms
    large = terms.groupBy("lid").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > SHARD_TERMS).collect()
    shards = F.lit(1)
    if large:
        shards = F.coalesce(F.create_map(*(F.lit(x) for r in large for x in (r["lid"], -(-r["n"] // SHARD_TERMS))))[F.col("lid")], shards)

    def build(group: pa.Table) -> pa.Table:
        key = group["key"].to_numpy().view(np.uint64)
        h = PerfectHash.build(key)
        order = np.argsort(h.slots(key))
        return pa.table({"lid": group["lid"][:1], "shard": group["shard"][:1], "shards": group["shards"][:1], "sizes": pa.array([h.sizes], pa.list_(pa.int64())),
                         "bits": pa.array([h.bits.tobytes()], pa.binary()), "terms": pa.array([group["term"].combine_chunks().take(pa.array(order))], pa.list_(pa.string()))})

    dealt = terms.withColumn("shards", shards.cast("int")).withColumn("shard", F.pmod("key", "shards").cast("int"))
    return dealt.select("lid", "shard", "shards", "key", "term").groupBy("lid", "shard").applyInArrow(build, _INDEX)


@dataclass(frozen=True)
class Place:
    lid: int
    shard: int
    shards: int
    terms: int
    size: int
    first: int


def lay_out(index: DataFrame) -> list[Place]:
    """Slot numbers of the shards (one row for about SHARD_TERMS terms): those
    of a language follow each other, and no block holds two languages."""
    rows = index.selectExpr("lid", "shard", "shards", "size(terms) n", "length(bits) + aggregate(terms, 0L, (a, t) -> a + octet_length(t)) + 8 * size(terms) b").collect()
    out, at, lid = [], 0, None
    for r in sorted(rows, key=lambda r: (r["lid"], r["shard"])):
        if r["lid"] != lid:
            at, lid = -(-at // BLOCK) * BLOCK, r["lid"]
        out.append(Place(r["lid"], r["shard"], r["shards"], r["n"], r["b"], at))
        at += r["n"]
    return out


def rounds(places: list[Place], most: int) -> Iterator[list[Place]]:
    """Runs of shards of at most ``most`` bytes (one shard at least)."""
    now: list[Place] = []
    for p in places:
        if now and sum(x.size for x in now) + p.size > most:
            yield now
            now = []
        now.append(p)
    if now:
        yield now


def _shards(index: DataFrame, wanted: list[Place]) -> dict[int, tuple[int, dict[int, Shard]]]:
    first, last = (F.struct(F.lit(p.lid).alias("lid"), F.lit(p.shard).alias("shard")) for p in (wanted[0], wanted[-1]))
    rows = index.where(F.struct("lid", "shard").between(first, last)).toArrow()  # at most ROUND_BYTES, or one shard
    base = {(p.lid, p.shard): p for p in wanted}
    out: dict[int, tuple[int, dict[int, Shard]]] = {}
    for r in range(rows.num_rows):
        p = base[rows["lid"][r].as_py(), rows["shard"][r].as_py()]
        terms = rows["terms"][r].values.cast(pa.large_string())
        length = np.array(pa.compute.binary_length(terms), np.int64)
        raw = np.frombuffer(b"".join(x.encode() for x in terms.to_pylist()), np.uint8)
        h = PerfectHash(rows["sizes"][r].values.to_numpy(), np.frombuffer(rows["bits"][r].as_py(), np.uint8))
        out.setdefault(p.lid, (p.shards, {}))[1][p.shard] = Shard(p.first, h, raw, np.r_[0, np.cumsum(length)])
    return out


class Counts:
    """Dense counts of slots, an array for each group."""

    def __init__(self, places: list[Place]):
        self.range: dict[int, tuple[int, int]] = {}
        for p in places:
            lo, hi = self.range.get(p.lid, (p.first, p.first))
            self.range[p.lid] = (min(lo, p.first), max(hi, p.first + p.terms))
        self.of: dict[int, tuple[int, np.ndarray]] = {}
        self.cells = 0

    def add(self, gid: int, lid: int, slots: np.ndarray) -> None:
        lo, hi = self.range[lid]
        if gid not in self.of:
            self.of[gid] = (lo, np.zeros(hi - lo, np.int64))
            self.cells += hi - lo
        self.of[gid][1][:] += np.bincount(slots - lo, minlength=hi - lo)

    def flush(self) -> Iterator[pa.RecordBatch]:
        for gid, (lo, n) in self.of.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), gid)), pa.array(at + lo), pa.array(n[at])], names=["gid", "slot", "n"])
        self.of, self.cells = {}, 0


def recount(rows: DataFrame, index: DataFrame, places: list[Place], round_bytes: int = ROUND_BYTES) -> DataFrame:
    """(gid, slot, n): occurrences of each kept term in each group, where any."""
    out = None
    for wanted in rounds(places, round_bytes):
        shared = rows.sparkSession.sparkContext.broadcast((_shards(index, wanted), wanted))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            shards, wanted = shared.value
            counts = Counts(wanted)
            for batch in batches:
                lang, group, texts = batch.column(0).to_numpy(), batch.column(1).to_numpy(), tx.utf8(batch.column(2))
                for lo, hi in tx.chunks(texts, _PIECE):
                    p = Piece(texts[lo:hi])
                    of = np.repeat(np.arange(lo, hi), np.diff(p.words.ptr))
                    for lid in np.unique(lang[lo:hi]).tolist():
                        if lid not in shards:
                            continue
                        number, own = shards[lid]
                        mine = np.flatnonzero(lang[of] == lid)
                        used = tx.distinct(p.number[mine])
                        shard = p.key[used].view(np.int64) % number
                        slot = np.full(len(p.key), -1)
                        for s, table in own.items():
                            w = used[shard == s]
                            slot[w] = table.find(p.key[w], p.raw, p.start[w], p.end[w])
                        slots, groups = slot[p.number[mine]], group[of[mine]]
                        groups, slots = groups[slots >= 0], slots[slots >= 0]
                        order = np.argsort(groups, kind="stable")
                        groups, slots = groups[order], slots[order]
                        cut = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1], True]) if len(groups) else []
                        for a, b in zip(cut[:-1], cut[1:], strict=True):
                            counts.add(int(groups[a]), lid, slots[a:b])
                            if counts.cells > MOST_CELLS:
                                yield from counts.flush()
            yield from counts.flush()

        got = rows.select("lid", "gid", "text").mapInArrow(run, "gid long, slot long, n long").groupBy("gid", "slot").agg(F.sum("n").alias("n"))
        out = checkpointed(got) if out is None else out.union(checkpointed(got))
    return out if out is not None else rows.sparkSession.createDataFrame([], "gid long, slot long, n long")


def shares(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(UNIT * n / total) for n <= total < 9e15, by long division in
    three steps, so that nothing overflows."""
    out = np.zeros(np.broadcast(n, total).shape, np.int64)
    left = n + np.zeros_like(out)
    for _ in range(3):
        left = left * 1000
        out = out * 1000 + left // total
        left = left % total
    return out + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


_SCORES = "gid long, other long, term string, value long"


def score_blocks(counted: DataFrame, groups: DataFrame, terms: DataFrame, top: int) -> DataFrame:
    """Per block of slots: each pair's part of the sum (gid, other, value), and
    the ``top`` terms of each group (gid, term, value). ``groups`` has lid, gid,
    total (of the group), lang_total and kept (terms of the language)."""
    block = F.floor(F.col("slot") / BLOCK)
    # every block needs all groups of its language, also those without a count
    held = terms.select("lid", block.alias("block")).distinct().join(groups, "lid").select(
        "block", F.lit(None).cast("long").alias("slot"), F.lit(None).cast("string").alias("term"), "gid", "total", "lang_total", "kept")
    none = [F.lit(None).cast("long").alias(c) for c in ("gid", "total", "lang_total", "kept")]
    about = terms.select(block.alias("block"), "slot", "term", *none).union(held)

    def score(counts: pa.Table, about: pa.Table) -> pa.Table:
        is_group = np.array(about["gid"].is_valid())
        g, t = about.filter(pa.array(is_group)).sort_by("gid"), about.filter(pa.array(~is_group)).sort_by("slot")
        gid, slot = g["gid"].to_numpy(), t["slot"].to_numpy()
        n = np.zeros((len(gid), len(slot)), np.int64)
        n[np.searchsorted(gid, counts["gid"].to_numpy()), np.searchsorted(slot, counts["slot"].to_numpy())] = counts["n"].to_numpy()
        kept = g["kept"].to_numpy()
        p = shares(n + 2, (g["total"].to_numpy() + 2 * kept)[:, None])
        q = shares(n.sum(0) + 2, np.array(g["lang_total"][0].as_py() + 2 * kept[0]))
        a, b, value, marks = [], [], [], []
        text = t["term"].to_pylist()
        for i in range(len(gid)):
            half = divergence(p[i], p[i + 1 :]).sum(1)
            a += [np.full(len(half), gid[i]), gid[i + 1 :]]
            b += [gid[i + 1 :], np.full(len(half), gid[i])]
            value += [half, half]
            f = divergence(p[i], q)
            own = np.flatnonzero((n[i] > 0) & (p[i] > q)).tolist()
            marks += [(gid[i], text[k], f[k]) for k in sorted(own, key=lambda k: (-f[k], text[k].encode()))[:top]]
        of = [np.array([m[k] for m in marks], np.int64) for k in (0, 2)]
        other = pa.array(np.concatenate([*b, of[0][:0]]))
        return pa.table({"gid": pa.array(np.concatenate([*a, of[0]])), "other": pa.concat_arrays([other, pa.nulls(len(marks), pa.int64())]),
                         "term": pa.concat_arrays([pa.nulls(len(other), pa.string()), pa.array([m[1] for m in marks], pa.string())]),
                         "value": pa.array(np.concatenate([*value, of[1]]))})

    left = counted.select(block.alias("block"), "gid", "slot", "n").groupBy("block")
    return left.cogroup(about.groupBy("block")).applyInArrow(score, _SCORES)


def audit(docs: DataFrame, min_docs: int = 10, top: int = 10, round_bytes: int = ROUND_BYTES) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` ranks the other
    sources of the language by divergence, part ``term`` the terms that the
    source uses more than its language does (ranks to ``top``)."""
    spark = docs.sparkSession
    rows, groups = group_table(docs)
    index = checkpointed(build_index(checkpointed(kept_terms(rows, min_docs))))
    places = lay_out(index)
    counted = recount(rows, index, places, round_bytes)
    laid = spark.createDataFrame([(p.lid, p.shard, p.first) for p in places], "lid long, shard int, first long")
    terms = index.join(laid, ["lid", "shard"]).select("lid", "first", F.posexplode("terms").alias("at", "term")).select("lid", (F.col("first") + F.col("at")).alias("slot"), "term")
    kept = index.groupBy("lid").agg(F.sum(F.size("terms")).alias("kept"))
    total = groups.join(counted.groupBy("gid").agg(F.sum("n").alias("total")), "gid", "left").withColumn("total", F.coalesce("total", F.lit(0).cast("long")))
    by_lang = total.groupBy("lid").agg(F.sum("total").alias("lang_total"))
    scores = checkpointed(score_blocks(counted, total.join(by_lang, "lid").join(kept, "lid"), terms, top))

    a = groups.select("lid", "lang", "source", "gid")
    b = groups.select("lid", F.col("source").alias("item"), F.col("gid").alias("other"))
    sums = scores.where("term IS NULL").groupBy("gid", "other").agg(F.sum("value").alias("value"))
    pairs = a.join(b, "lid").where("gid <> other").join(sums, ["gid", "other"], "left").select(
        "lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0).cast("long")).alias("value"))
    marks = scores.where("term IS NOT NULL").join(a, "gid").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order).alias("rank")
    return pairs.select("*", rank).union(marks.select("*", rank).where(F.col("rank") <= top))
