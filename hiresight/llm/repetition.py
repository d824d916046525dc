"""Quality rules: repetition coverage (operator 3).

Rolling 64-bit hashes of the word n-grams of several lengths, taken over whole
texts in numpy, tell how many characters lie inside duplicated n-grams, inside
the most frequent n-gram, and on duplicated lines. A text is kept if its
repetition stays within every limit of ``Limits``.

Lengths are taken in ascending order: an n-gram can occur twice only if both
its (n-1)-grams do, so only the shortest length sorts all words.

Defined results: a null or empty text has no words, fails the base rule and is
not kept; repeated rows and equal ids are judged row by row; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import text as tx

_SYMBOLS = tx.separators(b"#*$%&|<>")
_LENGTHS = tuple(range(2, 11))


@dataclass(frozen=True)
class Limits:
    """Largest allowed shares of a text's word characters (lines: of its lines,
    one repeated line beyond that is allowed, and of its characters). Word
    n-grams count every occurrence of a duplicate; a top n-gram occurs three
    times or more."""

    top_ngram: dict[int, float] = field(default_factory=lambda: {2: 0.20, 3: 0.18, 4: 0.16})
    duplicate_ngram: dict[int, float] = field(default_factory=lambda: {5: 0.30, 6: 0.28, 7: 0.26, 8: 0.24, 9: 0.22, 10: 0.20})
    duplicate_lines: float = 0.30
    duplicate_line_chars: float = 0.30
    min_words: int = 50
    symbols_per_word: float = 0.10


SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, n_lines long, dup_line_chars long, "
    + ", ".join(f"top{n}_chars long" for n in (2, 3, 4)) + ", "
    + ", ".join(f"dup{n}_chars long" for n in range(5, 11))
)


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the keys, and start and length of each run of equal keys."""
    order = np.argsort(keys)
    s = keys[order]
    start = np.flatnonzero(np.r_[True, s[1:] != s[:-1]]) if len(s) else np.zeros(0, np.int64)
    return order, start, np.diff(np.r_[start, len(s)])


def _covered(n_words: int, at: np.ndarray, n: int) -> np.ndarray:
    """Words inside the n-grams that begin at ``at``."""
    step = np.zeros(n_words + 1, np.int32)
    np.add.at(step, at, 1)
    np.add.at(step, at + n, -1)
    return np.cumsum(step[:-1]) > 0


def measure(texts: list[bytes | None]) -> dict[str, np.ndarray]:
    """The repetition figures of each text."""
    buf = tx.Buffer(texts)
    w = tx.Words(buf, tx.SPACE)
    lines = tx.Words(buf, tx.LINE)
    points = buf.code_points()
    chars = points[w.end] - points[w.start]
    doc = w.text_of()
    salt = tx.mix(np.arange(1, w.n + 1, dtype=np.uint64))
    out = {"n_words": np.diff(w.ptr), "word_chars": tx.sums(chars, w.ptr)}
    symbol = np.zeros(len(buf.bytes) + 1, np.int64)
    np.cumsum(_SYMBOLS[buf.bytes], out=symbol[1:])
    out["n_symbols"] = symbol[np.maximum(buf.offset[1:] - 1, buf.offset[:-1])] - symbol[buf.offset[:-1]]

    # lines that hold a word; later equal ones count
    has_word = np.searchsorted(w.start, lines.start) < np.searchsorted(w.start, lines.end)
    line_doc = lines.text_of()
    at = np.flatnonzero(has_word)
    keys = lines.hash[at] ^ salt[line_doc[at]]
    order = np.argsort(keys, kind="stable")
    again = np.zeros(len(at), bool)
    again[order[1:]] = keys[order[1:]] == keys[order[:-1]]
    later = at[again]
    out["n_lines"] = np.bincount(line_doc[at], minlength=w.n)
    out["n_dup_lines"] = np.bincount(line_doc[later], minlength=w.n)
    out["dup_line_chars"] = np.bincount(line_doc[later], weights=points[lines.end[later]] - points[lines.start[later]], minlength=w.n).astype(np.int64)

    total = np.r_[0, np.cumsum(chars)]
    at = None
    for n in _LENGTHS:
        at, keys = w.ngrams(n, at)
        keys ^= salt[doc[at]]
        order, start, size = _runs(keys)
        twice = size > 1
        if n in (2, 3, 4):
            often = size > 2  # twice is no frequent n-gram, however short the text
            top, first = np.zeros(w.n, np.int64), at[order[start[often]]]
            np.maximum.at(top, doc[first], size[often] * (total[first + n] - total[first]))
            out[f"top{n}_chars"] = np.minimum(top, out["word_chars"])
        dup = np.sort(at[order[np.repeat(twice, size)]])
        if n == 3 or n >= 5:
            inside = _covered(len(chars), dup, n)
            if n == 3:
                out["n_repeat_words"] = tx.sums(inside, w.ptr)
            else:
                out[f"dup{n}_chars"] = tx.sums(np.where(inside, chars, 0), w.ptr)
        # a longer duplicate starts where two neighbouring n-grams are duplicates
        last = w.ptr[1:][doc[dup]]
        at = dup[:-1][(dup[1:] == dup[:-1] + 1) & (dup[:-1] + n + 1 <= last[:-1])]
    return out


def verdict(m: dict[str, np.ndarray], limits: Limits) -> tuple[np.ndarray, np.ndarray]:
    """(base_failed, kept) of the measured texts."""
    base_failed = (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])
    chars = np.maximum(m["word_chars"], 1)
    kept = ~base_failed & (m["n_words"] >= limits.min_words)
    kept &= m["n_symbols"] <= limits.symbols_per_word * m["n_words"]
    kept &= m["n_dup_lines"] <= limits.duplicate_lines * m["n_lines"] + 1  # shares of a few lines are coarse
    kept &= m["dup_line_chars"] <= limits.duplicate_line_chars * chars
    for n, share in limits.top_ngram.items():
        kept &= m[f"top{n}_chars"] <= share * chars
    for n, share in limits.duplicate_ngram.items():
        kept &= m[f"dup{n}_chars"] <= share * chars
    return base_failed, kept


def repetition_rules(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): the figures and verdicts of
    ``SCHEMA``. Texts are measured whole; nothing is shuffled."""
    names = [f.split()[0] for f in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), tx.utf8(batch.column(1))
            for lo, hi in tx.chunks(texts):
                m = measure(texts[lo:hi])
                m["base_failed"], m["kept"] = verdict(m, limits)
                yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), *(pa.array(m[k]) for k in names[1:])], names=names)

    return docs.selectExpr("CAST(doc_id AS LONG) doc_id", "CAST(text AS STRING) text").mapInArrow(run, SCHEMA)
