"""N-gram Jaccard join with a MinHash LSH forest (operator 10).

Texts link when the Jaccard similarity of their sets of five-word shingles
(lower-cased A-Z, words by white space; a text of one to four words is one
shingle) is at least 0.8.

1. Texts of equal shingle sets form a class; all later work is on classes.
2. A forest of ``trees`` tries holds each class under the leading minima of
   its tree's signature. The matched prefix is shortened from ``max_depth``
   until the chance to meet a partner of the threshold similarity in some tree
   reaches ``recall``. A longer common prefix implies the shorter one, so the
   join groups by the final prefix alone.
3. The members of a prefix group are connected through the group's least
   member (never pair by pair), which gives candidate components.
4. Exact verification inside each candidate component. Components are cut into
   blocks by set size (a link needs sizes within a factor of 0.8) and by hash;
   a task holds two blocks and counts all common shingles by matrix products.
   It returns one row per member: its number of links and its least linked
   member. Pairs are never written out.
5. Components over the verified links are the near-duplicate groups.

Every link inside a candidate component is counted, also those that share no
prefix; the only loss is the forest's (``recall`` at the threshold, more above).

Defined results: null texts and texts without words link to nothing and are
groups of their own; equal rows are copies of each other; ``class_id`` is the
least doc_id of the group (null only if all are null); extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import text as tx
from .graph import components
from .tables import checkpointed, column_of, positional

SHINGLE = 5
#: Members and shingles of a block; a task of step 4 holds two.
BLOCK_MEMBERS, BLOCK_SHINGLES = 256, 2_000_000


def target_depth(trees: int, max_depth: int, similarity: float, recall: float) -> int:
    """The longest prefix that reaches the recall."""
    depth = max_depth
    while depth > 1 and 1 - (1 - similarity**depth) ** trees < recall:
        depth -= 1
    return depth


def shingle_sets(texts: list[bytes | None], k: int = SHINGLE) -> list[np.ndarray]:
    """Each text's sorted distinct shingle hashes."""
    w = tx.Words(tx.Buffer(texts, lower=True), tx.SPACE)
    n = np.diff(w.ptr)
    at, keys = w.ngrams(k)
    ptr = np.searchsorted(at, w.ptr)
    out = [tx.distinct(keys[a:b]) for a, b in zip(ptr[:-1].tolist(), ptr[1:].tolist(), strict=True)]
    for m in range(1, k):
        own = np.flatnonzero(n == m)
        _, keys1 = w.ngrams(m, w.ptr[own])
        for i, h in zip(own.tolist(), tx.mix(keys1 + np.uint64(m)), strict=True):
            out[i] = np.array([h])
    return out


class Forest:
    """Prefix keys of shingle sets."""

    def __init__(self, trees: int, depth: int, seed: int = 11):
        r = np.random.default_rng(seed)
        self.trees, self.depth = trees, depth
        self.a = r.integers(0, 1 << 31, trees * depth, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.b = r.integers(0, 1 << 32, trees * depth, dtype=np.uint32)
        self.tree = tx.mix(np.arange(1, trees + 1, dtype=np.uint64) << np.uint64(20))

    def keys(self, sets: list[np.ndarray]) -> np.ndarray:
        """One row of ``trees`` keys for each (non-empty) set."""
        out = np.empty((len(sets), self.trees), np.uint64)
        lo = 0
        while lo < len(sets):
            hi, size = lo, 0
            while hi < len(sets) and (hi == lo or size + len(sets[hi]) <= 32_768):
                size += len(sets[hi])
                hi += 1
            out[lo:hi] = self._keys(sets[lo:hi])
            lo = hi
        return out

    def _keys(self, sets: list[np.ndarray]) -> np.ndarray:
        x = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
        start = np.r_[0, np.cumsum([len(s) for s in sets])[:-1]]
        low = np.full((len(self.a), len(sets)), 0xFFFFFFFF, np.uint32)
        step = len(x) if len(sets) > 1 else 32_768  # one very long text is worked through in pieces
        for p in range(0, len(x), step):
            piece = x[p : p + step]
            for k in range(0, len(self.a), 16):
                h = piece[None, :] * self.a[k : k + 16, None] + self.b[k : k + 16, None]
                h ^= h >> np.uint32(15)
                low[k : k + 16] = np.minimum(low[k : k + 16], np.minimum.reduceat(h, start, axis=1))
        low = low.reshape(self.trees, self.depth, len(sets)).astype(np.uint64)
        key = np.repeat(self.tree[:, None], len(sets), 1)
        for d in range(self.depth):
            key = tx.mix(key * np.uint64(0xD6E8FEB86659FD93) + low[:, d])
        return key.T


def set_id(s: np.ndarray) -> bytes:
    """128 bits that name a shingle set."""
    one = (int(s.sum(dtype=np.uint64)), int(tx.mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)))
    return np.array(one, ">u8").tobytes()


def _signatures(docs: DataFrame, forest: Forest) -> DataFrame:
    """(doc_id, text_hash, cid, n, keys) of each row; cid, n, keys are null
    without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = tx.utf8(batch.column(2))
            for lo, hi in tx.chunks(texts, 1 << 20):
                sets = shingle_sets(texts[lo:hi])
                full = [i for i, s in enumerate(sets) if len(s)]
                keys = forest.keys([sets[i] for i in full]).view(np.int64) if full else np.zeros((0, forest.trees), np.int64)
                at = np.full(len(sets) + 1, 0)
                at[1:] = np.cumsum([forest.trees if len(s) else 0 for s in sets])
                mask = np.array([not len(s) for s in sets] + [False])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo),
                    pa.array([set_id(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([len(s) if len(s) else None for s in sets], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(at, pa.int32(), mask=mask), pa.array(keys.ravel()))],
                    names=["doc_id", "text_hash", "cid", "n", "keys"])

    return (docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
            .mapInArrow(run, "doc_id long, text_hash long, cid binary, n long, keys array<long>"))


def common(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections."""
    m = len(sets)
    flat = np.concatenate(sets)
    if m == 2:
        s = np.sort(flat)
        n = int((s[1:] == s[:-1]).sum())
        return np.array([[len(sets[0]), n], [n, len(sets[1])]], np.float64)
    who = np.repeat(np.arange(m), [len(s) for s in sets])
    order = np.argsort(flat)
    s, who = flat[order], who[order]
    new = np.r_[True, s[1:] != s[:-1]]
    column = np.cumsum(new) - 1
    shared = np.diff(np.r_[np.flatnonzero(new), len(s)]) > 1
    keep = shared[column]
    column, who = (np.cumsum(shared) - 1)[column[keep]], who[keep]
    out = np.zeros((m, m), np.float32)  # counts stay below 2**24
    total = int(shared.sum())
    cut = np.searchsorted(column, np.arange(0, total + 4096, 4096))
    for k in range(len(cut) - 1):
        x = np.zeros((m, 4096), np.float32)
        x[who[cut[k] : cut[k + 1]], column[cut[k] : cut[k + 1]] - 4096 * k] = 1
        out += x @ x.T
    return out.astype(np.float64)


def _verify_group(rows: list[tuple], least: Fraction) -> list[tuple[bytes, int, bytes]]:
    """Rows are (cid, side, copies, set): for each member the copies of its
    linked partners and its least linked member (by way of others too)."""
    rows = list({r[0]: r for r in rows}.values())
    if len(rows) < 2:
        return []
    sets = [r[3] for r in rows]
    size = np.array([len(s) for s in sets], np.float64)
    inter = common(sets)
    link = (least.denominator + least.numerator) * inter >= least.numerator * (size[:, None] + size[None, :])
    np.fill_diagonal(link, False)
    side = np.array([r[1] for r in rows])
    if side.any():
        link &= side[:, None] != side[None, :]
    copies = np.array([r[2] for r in rows], np.int64)
    count = link @ copies
    parent = list(range(len(rows)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in np.flatnonzero(link.any(1)).tolist():
        for j in np.flatnonzero(link[i, :i]).tolist():
            a, b = root(i), root(j)
            if a != b:
                lo, hi = (a, b) if rows[a][0] < rows[b][0] else (b, a)
                parent[hi] = lo
    return [(r[0], int(count[i]), rows[root(i)][0]) for i, r in enumerate(rows) if count[i]]


def _verify(members: DataFrame, least: Fraction) -> DataFrame:
    """(cid, links, least) from rows (task, cid, side, copies, shingles) that
    are sorted by task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                lists = batch.column(4)
                flat, at = np.asarray(lists.values).view(np.uint64), np.asarray(lists.offsets)
                for i, head in enumerate(zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True)):
                    yield *head, flat[at[i] : at[i + 1]].copy()

        out: list[tuple[bytes, int, bytes]] = []
        task, group = None, []
        for r in chain(rows(), [(None,)]):
            if r[0] != task:
                out += _verify_group(group, least)
                task, group = r[0], []
            group.append(r[1:])
            if len(out) > 10_000 or task is None:
                c, n, p = zip(*out, strict=True) if out else ((), (), ())
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()), pa.array(n, pa.int64()), pa.array(p, pa.binary())], names=["cid", "links", "least"])
                out = []

    return members.mapInArrow(run, "cid binary, links long, least binary")


def _with_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (cid, rep, ...) with the class's shingles, from the text of a
    row whose doc_id is ``rep`` (others of that id are told apart by their set)."""
    joined = docs.select("doc_id", "text").join(wanted, F.col("doc_id").eqNullSafe(F.col("rep")))
    rest = [c for c in wanted.columns if c not in ("cid", "rep")]
    kinds = {f.name: f.dataType.simpleString() for f in wanted.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, cids = tx.utf8(batch.column(0)), batch.column(1).to_pylist()
            for lo, hi in tx.chunks(texts, 1 << 20):
                sets = shingle_sets(texts[lo:hi])
                keep = [i for i, s in enumerate(sets) if len(s) and set_id(s) == cids[lo + i]]
                if not keep:
                    continue
                own = batch.take(pa.array([lo + i for i in keep]))
                at = np.r_[0, np.cumsum([len(sets[i]) for i in keep])]
                flat = np.concatenate([sets[i] for i in keep]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [*own.columns[1:], pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat))],
                    names=["cid", *rest, "shingles"])

    return joined.select("text", "cid", *rest).mapInArrow(run, ", ".join(["cid binary", *(f"{c} {kinds[c]}" for c in rest), "shingles array<long>"]))


def _blocks(classes: DataFrame, similarity: float) -> DataFrame:
    """Classes (cid, rep, n, copies, component) with ``tasks``, an array of
    (task, side): where the class is to be compared."""
    # sizes that can link differ by at most 1 / similarity: they are of one size class or of neighbouring ones
    size_class = F.floor(F.log("n") / F.log(F.lit(1.0001 / similarity))).cast("int")
    rows = classes.withColumn("sc", size_class)
    parts = (rows.groupBy("component", "sc").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("s"))
             .groupBy("component").agg(
                 F.sum("m").alias("m"), F.sum("s").alias("s"),  # there are at most some hundred size classes
                 F.map_from_entries(F.collect_list(F.struct("sc", F.ceil(F.greatest(F.col("m") / BLOCK_MEMBERS, F.col("s") / BLOCK_SHINGLES)).cast("int")))).alias("nb")))
    one = (F.col("m") <= BLOCK_MEMBERS) & (F.col("s") <= BLOCK_SHINGLES)
    rows = rows.join(parts, "component").withColumn(
        "sub", F.pmod(F.xxhash64("cid"), F.element_at("nb", F.col("sc")).cast("long")).cast("int"))

    def task(c1, b1, c2, b2):
        return F.md5(F.concat(F.col("component"), F.concat_ws(",", c1, b1, c2, b2).cast("binary")))

    def numbers(sc):
        return F.sequence(F.lit(0), F.coalesce(F.element_at("nb", sc), F.lit(0)) - 1)

    def some(sc, f):
        return F.when(F.coalesce(F.element_at("nb", sc), F.lit(0)) > 0, F.transform(numbers(sc), f))

    def at(x, side):
        return F.struct(x.alias("task"), F.lit(side).alias("side"))

    sc, sub = F.col("sc"), F.col("sub")
    none = F.array().cast("array<struct<task:string,side:int>>")
    same = some(sc, lambda j: F.struct(
        task(sc, F.least(sub, j), sc, F.greatest(sub, j)).alias("task"),
        F.when(j == sub, 0).when(sub < j, 1).otherwise(2).alias("side")))
    up = some(sc + 1, lambda j: at(task(sc, sub, sc + 1, j), 1))
    down = some(sc - 1, lambda j: at(task(sc - 1, j, sc, sub), 2))
    alone = F.array(at(F.md5("component"), 0))
    tasks = F.when(one, alone).otherwise(F.concat(same, F.coalesce(up, none), F.coalesce(down, none)))
    return rows.select("cid", "rep", "copies", tasks.alias("tasks"))


def _groups(docs: DataFrame, similarity: float, trees: int, max_depth: int, recall: float) -> DataFrame:
    """(doc_id, text_hash, cid, n, group, class_id, n_links) of each row of docs."""
    exact = Fraction(str(similarity))
    forest = Forest(trees, target_depth(trees, max_depth, similarity, recall))
    rows = checkpointed(_signatures(docs, forest))
    classes = checkpointed(rows.where("cid IS NOT NULL").groupBy("cid").agg(
        F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("keys").alias("keys")))
    members = classes.select("cid", F.explode("keys").alias("key"))
    pivots = members.groupBy("key").agg(F.min("cid").alias("v"), F.count(F.lit(1)).alias("m")).where("m > 1").drop("m")
    star = members.join(pivots, "key").select(F.col("cid").alias("u"), "v")
    candidates = components(star).withColumnRenamed("node", "cid")
    wanted = _blocks(classes.drop("keys").join(candidates, "cid"), similarity)
    tasks = (_with_sets(docs, wanted).select("cid", "copies", "shingles", F.explode("tasks").alias("t"))
             .select(F.col("t.task").alias("task"), "cid", F.col("t.side").alias("side"), "copies", "shingles"))
    found = checkpointed(_verify(tasks.repartition("task").sortWithinPartitions("task"), exact))
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("cid").alias("u"), F.col("least").alias("v"))).withColumnRenamed("node", "cid")
    named = classes.select("cid", "rep", "copies").join(groups, "cid", "left").join(links, "cid", "left")
    least = named.where("component IS NOT NULL").groupBy("component").agg(F.min("rep").alias("least"))
    named = named.join(least, "component", "left").select(
        "cid", F.coalesce("component", "cid").alias("group"),
        F.when(F.col("component").isNull(), F.col("rep")).otherwise(F.col("least")).alias("class_id"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    return rows.drop("keys").join(named, "cid", "left").select(
        "doc_id", "text_hash", "cid", "n", "group",
        F.when(F.col("cid").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def jaccard_join(docs: DataFrame, similarity: float = 0.8, trees: int = 40, max_depth: int = 10, recall: float = 0.9995) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): ``class_id`` of its near-duplicate
    group, ``n_links`` (other rows at or over the similarity), ``n_shingles``."""
    base = docs.selectExpr("CAST(doc_id AS LONG) doc_id", "CAST(text AS STRING) text")
    return _groups(base, similarity, trees, max_depth, recall).select(
        "doc_id", "class_id", "n_links", F.coalesce("n", F.lit(0)).cast("long").alias("n_shingles"))


def keep_one(docs: DataFrame, similarity: float = 0.8, trees: int = 40, max_depth: int = 10, recall: float = 0.9995) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: that of the least
    doc_id (nulls last), of several texts of that id the least text hash, of
    equal rows any. Rows without words stay, all of them."""
    own, names = positional(docs)
    id_, text = F.col(column_of(names, "doc_id")).cast("long"), F.col(column_of(names, "text")).cast("string")
    base = own.select(id_.alias("doc_id"), text.alias("text"))
    rows = checkpointed(_groups(base, similarity, trees, max_depth, recall))
    full = rows.where("cid IS NOT NULL")
    same = full.groupBy("doc_id", "text_hash", "group").agg(F.count(F.lit(1)).alias("same"))
    first = same.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "same")).alias("w"))
    keep = first.select("w.doc_id", "w.text_hash", "w.same").union(
        rows.where("cid IS NULL").select("doc_id", "text_hash", F.lit(1).cast("long")).distinct()
    ).toDF("__id", "__hash", "__same")
    found = own.withColumn("__key", F.xxhash64(text)).join(keep, id_.eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("__hash")))
    single = found.where("__same = 1").select(*own.columns)
    repeated = (found.where("__same > 1").groupBy("__id", "__hash").agg(F.first(F.struct(*own.columns)).alias("__row"))
                .select(*(F.col("__row").getField(c).alias(c) for c in own.columns)))
    return single.union(repeated).toDF(*names)
