"""Benchmark decontamination (operator 7).

All normalised items of a block of the benchmark form one generalised suffix
automaton over word numbers. A document's words stream through it; the length
of the longest match that ends at each word tells which benchmark windows (13
consecutive item words, or a whole shorter item) end there. Words that are not
part of any known word pair reset the match, so only runs of at least a
window's length of known pairs reach the automaton.

The automaton is broadcast. Its size is bounded by ``block_words``: a larger
benchmark is worked through block by block, each pass adding its spans to the
documents' state, which is checkpointed between passes.

Defined results: null and empty texts have no words and are never
contaminated; an empty benchmark hits nothing; items without words are
ignored; equal items all count; repeated documents are judged row by row;
extra columns are ignored (``drop_contaminated`` and ``cut_spans`` return them
untouched).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import text as tx
from .tables import checkpointed, column_of, positional

WINDOW = 13
#: Words of one automaton (about 60 MB in a worker).
BLOCK_WORDS = 100_000


class SuffixAutomaton:
    """Generalised suffix automaton of item word sequences, with the windows
    that end in its states."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        self.window = window
        buf = tx.Buffer([t for _, t in items], lower=True)
        w = tx.Words(buf, tx.ALNUM)
        self.words = np.unique(w.hash)
        number = np.searchsorted(self.words, w.hash)
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        seqs = [(name, number[a:b].tolist()) for (name, _), a, b in zip(items, w.ptr[:-1], w.ptr[1:], strict=True) if b > a]
        for _, seq in seqs:
            last = 0
            for c in seq:
                last = self._extend(last, c)
        #: state -> items whose full window is that state's match of ``window`` words
        self.full: dict[int, set[str]] = {}
        #: state -> [(length, items)] of whole shorter items that end in the state or in its suffixes
        short: dict[int, dict[int, set[str]]] = {}
        for name, seq in seqs:
            if len(seq) < window:
                state = 0
                for c in seq:
                    state = self.next[state][c]
                short.setdefault(state, {}).setdefault(len(seq), set()).add(name)
                continue
            for state, size in self.match(seq):
                if size >= window:
                    self.full.setdefault(self._at(state, window), set()).add(name)
        self.short: dict[int, list[tuple[int, set[str]]]] = {}
        if short:
            for state in sorted(range(1, len(self.link)), key=self.length.__getitem__):
                got = self.short.get(self.link[state], []) + sorted(short.get(state, {}).items())
                if got:
                    self.short[state] = got
        lengths = [len(s) for _, s in seqs]
        self.shortest = min([window, *lengths]) if lengths else 0
        self.lead = np.zeros(1 << 20, bool)
        self.lead[(self.words >> np.uint64(44)).astype(np.int64)] = True
        pairs, keys = w.ngrams(2)
        self.pairs = np.unique(keys)
        self.pair_lead = np.zeros(1 << 20, bool)
        self.pair_lead[(self.pairs >> np.uint64(44)).astype(np.int64)] = True

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        to = nxt[last].get(c)
        if to is not None:  # the sequence so far is known from an earlier item
            return to if length[to] == length[last] + 1 else self._split(last, c, to)
        new = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = new
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            link[new] = q if length[q] == length[p] + 1 else self._split(p, c, q)
        return new

    def _split(self, p: int, c: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        twin = len(nxt)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        link[q] = twin
        while p != -1 and nxt[p].get(c) == q:
            nxt[p][c] = twin
            p = link[p]
        return twin

    def _at(self, state: int, size: int) -> int:
        """The state of the match's last ``size`` words."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def match(self, seq: Iterable[int]) -> Iterator[tuple[int, int]]:
        """For each word: the state and length of the longest match ending there."""
        nxt, link, length = self.next, self.link, self.length
        state = size = 0
        for c in seq:
            to = nxt[state].get(c)
            while to is None and state:
                state = link[state]
                size = length[state]
                to = nxt[state].get(c)
            if to is None:
                size = 0
            else:
                state = to
                size += 1
            yield state, size

    def _known(self, keys: np.ndarray, lead: np.ndarray, table: np.ndarray) -> np.ndarray:
        out = lead[(keys >> np.uint64(44)).astype(np.int64)]
        at = np.flatnonzero(out)
        if len(at):
            found = np.minimum(np.searchsorted(table, keys[at]), len(table) - 1)
            out[at] = table[found] == keys[at]
        return out

    def hits(self, w: tx.Words) -> tuple[np.ndarray, np.ndarray, dict[int, set[str]]]:
        """Start and end (word positions) of window occurrences, and the item
        names by text."""
        start: list[int] = []
        end: list[int] = []
        items: dict[int, set[str]] = {}
        if not self.shortest or not len(w.hash):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), items
        # runs of words of which each neighbouring pair (single words: each word) is known
        if self.shortest > 1:
            at, keys = w.ngrams(2)
            ok = at[self._known(keys, self.pair_lead, self.pairs)]
            cut = np.flatnonzero(np.diff(ok) != 1)
            first, last = ok[np.r_[0, cut + 1]] if len(ok) else ok, ok[np.r_[cut, len(ok) - 1]] + 2 if len(ok) else ok
        else:
            ok = np.flatnonzero(self._known(w.hash, self.lead, self.words))
            doc = w.text_of()[ok]
            cut = np.flatnonzero((np.diff(ok) != 1) | (np.diff(doc) != 0))
            first, last = ok[np.r_[0, cut + 1]] if len(ok) else ok, ok[np.r_[cut, len(ok) - 1]] + 1 if len(ok) else ok
        long = last - first >= self.shortest
        texts = np.searchsorted(w.ptr, first, side="right") - 1
        for a, b, doc in zip(first[long].tolist(), last[long].tolist(), texts[long].tolist(), strict=True):
            seq = np.searchsorted(self.words, w.hash[a:b]).tolist()
            for k, (state, size) in enumerate(self.match(seq), a + 1):
                if size >= self.window:
                    start.append(k - self.window)
                    end.append(k)
                    items.setdefault(doc, set()).update(self.full.get(self._at(state, self.window), ()))
                for n, names in self.short.get(state, ()):
                    if n <= size:
                        start.append(k - n)
                        end.append(k)
                        items.setdefault(doc, set()).update(names)
        return np.asarray(start, np.int64), np.asarray(end, np.int64), items


def _blocks(benchmark: DataFrame, block_words: int) -> Iterator[list[tuple[str, bytes]]]:
    """The items, in blocks of at most ``block_words`` words (one item at least)."""
    rows = benchmark.selectExpr("CAST(item_id AS STRING) item_id", "CAST(text AS STRING) text").where("text IS NOT NULL")
    block: list[tuple[str, bytes]] = []
    size = 0
    for r in rows.toLocalIterator():
        n = len(r["text"]) // 2 + 1  # no text has more words
        if block and size + n > block_words:
            yield block
            block, size = [], 0
        block.append((r["item_id"] or "", r["text"].encode()))
        size += n
    yield block


_STATE = "spans array<struct<s:long,e:long>>, items array<string>"


def _scan(frame: DataFrame, automaton, column: str) -> DataFrame:
    """Add a block's spans (word positions, end exclusive) and item names to
    the state columns ``spans`` and ``items``; other columns stay."""
    schema = frame.schema
    i_text, i_spans, i_items = (frame.columns.index(c) for c in (column, "__spans", "__items"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sam: SuffixAutomaton = automaton.value
        for batch in batches:
            texts = tx.utf8(batch.column(i_text))
            spans, items = batch.column(i_spans).to_pylist(), batch.column(i_items).to_pylist()
            words = []
            for lo, hi in tx.chunks(texts):
                w = tx.Words(tx.Buffer(texts[lo:hi], lower=True), tx.ALNUM)
                words.append(np.diff(w.ptr))
                s, e, names = sam.hits(w)
                doc = np.searchsorted(w.ptr, s, side="right") - 1
                order = np.lexsort((e, s))
                for a, b, d in zip(s[order].tolist(), e[order].tolist(), doc[order].tolist(), strict=True):
                    own, base = spans[lo + d], int(w.ptr[d])
                    if own and own[-1]["s"] <= a - base <= own[-1]["e"]:
                        own[-1]["e"] = max(own[-1]["e"], b - base)
                    else:
                        own.append({"s": a - base, "e": b - base})
                for d, got in names.items():
                    items[lo + d] = sorted({*items[lo + d], *got})
            columns = list(batch.columns)
            columns[i_spans] = pa.array(spans, batch.schema.field(i_spans).type)
            columns[i_items] = pa.array(items, batch.schema.field(i_items).type)
            columns[batch.schema.get_field_index("__n_words")] = pa.array(np.concatenate(words) if words else [], pa.int64())
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return frame.mapInArrow(run, schema)


def find_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with three more columns: ``__n_words``, ``__spans`` (hit word
    ranges, not overlapping within a block) and ``__items`` (names, sorted),
    which ``docs`` must not have."""
    clash = {"__n_words", "__spans", "__items"} & {c.lower() for c in docs.columns}
    if clash:
        raise ValueError(f"columns {sorted(clash)} are in use")
    sc = docs.sparkSession.sparkContext
    state = docs.withColumns({
        "__n_words": F.lit(0).cast("long"),
        "__spans": F.array().cast("array<struct<s:long,e:long>>"),
        "__items": F.array().cast("array<string>"),
    })
    for k, block in enumerate(_blocks(benchmark, block_words)):
        if k:
            state = checkpointed(state)
        state = _scan(state, sc.broadcast(SuffixAutomaton(block, window)), text)
    return state


def _n_hit(spans):
    """Words in the union of the spans (spans of several blocks may overlap)."""
    ordered = F.array_sort(spans)
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("e"))
    return F.aggregate(ordered, zero, lambda a, x: F.struct(
        (a["n"] + F.greatest(F.lit(0).cast("long"), x["e"] - F.greatest(x["s"], a["e"]))).alias("n"),
        F.greatest(a["e"], x["e"]).alias("e")))["n"]


def _contaminated(min_percent: int):
    return (F.col("__n_hit") > 0) & (100 * F.col("__n_hit") >= min_percent * F.col("__n_words"))


def contamination(docs: DataFrame, benchmark: DataFrame, min_percent: int = 5) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): word, hit and item counts, the hash
    of the sorted item ids, the verdict (at least ``min_percent`` of the words
    are hit) and the spans."""
    base = docs.selectExpr("CAST(doc_id AS LONG) doc_id", "CAST(text AS STRING) text")
    found = find_spans(base, benchmark).withColumn("__n_hit", _n_hit(F.col("__spans")))
    return found.select(
        "doc_id", F.col("__n_words").alias("n_words"), F.col("__n_hit").alias("n_hit"),
        F.size("__items").cast("long").alias("n_items"),
        F.sha2(F.array_join("__items", ","), 256).alias("items_sha256"),
        _contaminated(min_percent).alias("contaminated"), F.col("__spans").alias("spans"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", min_percent: int = 5) -> DataFrame:
    """The rows of ``docs`` whose hit words stay under the coverage limit, unchanged."""
    rows, names = positional(docs)
    found = find_spans(rows, benchmark, column_of(names, text)).withColumn("__n_hit", _n_hit(F.col("__spans")))
    return found.where(~_contaminated(min_percent)).select(*rows.columns).toDF(*names)


def cut_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", min_words: int = WINDOW) -> DataFrame:
    """``docs`` with every hit span of at least ``min_words`` words cut out of
    its text (one space stays in its place)."""
    rows, names = positional(docs)
    found = find_spans(rows, benchmark, column_of(names, text))
    own, i_text, i_spans = rows.columns, found.columns.index(column_of(names, text)), found.columns.index("__spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t, spans in zip(tx.utf8(batch.column(i_text)), batch.column(i_spans).to_pylist(), strict=True):
                spans = [x for x in spans if x["e"] - x["s"] >= min_words]
                if spans:
                    w = tx.Words(tx.Buffer([t], lower=True), tx.ALNUM)
                    cut, at = [], 0
                    for x in sorted(spans, key=lambda x: x["s"]):
                        a, b = int(w.start[x["s"]]) - 1, int(w.end[x["e"] - 1]) - 1
                        cut.append(t[at:max(a, at)])
                        at = max(b, at)
                    t = b" ".join([*cut, t[at:]])
                out.append(None if t is None else t.decode("utf-8", "replace"))
            columns = [pa.array(out, batch.column(i).type) if i == i_text else batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, names=own)

    return found.mapInArrow(run, rows.schema).toDF(*names)


def items_hash(items: Iterable[str]) -> str:
    """The hash that ``contamination`` gives for a set of items."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
