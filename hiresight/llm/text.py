"""Vectorised tokenising of batches of texts in numpy.

Texts of a chunk are joined to one byte buffer; words are runs of bytes that
are not in a separator table (all separators here are ASCII, so UTF-8
sequences are never cut). A word's 64-bit hash is a random-table polynomial
over its bytes, taken from prefix sums, so no Python code runs per word.
Buffers are worked through in small pieces: memory stays a few times the
longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_MASK = (1 << 64) - 1
_PIECE = 1 << 16
_BASE = 0x9E3779B97F4A7C15 | 1


def _powers(base: int) -> np.ndarray:
    out = np.full(_PIECE + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POW, _IPOW = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))
_TABLE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def separators(pattern: bytes) -> np.ndarray:
    """A 256-entry table that is true for the given separator bytes."""
    out = np.zeros(256, bool)
    out[list(pattern)] = True
    return out


#: ``[^\x20\x09-\x0D]+`` words
SPACE = separators(b" \t\n\v\f\r")
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` words of lower-cased text
ALNUM = separators(bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
LINE = separators(b"\n")


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (in place on a copy)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Buffer:
    """Several texts as one byte buffer; ``offset[i]`` is the start of text i,
    ``offset[-1]`` the buffer's end. A newline stands around each text."""

    def __init__(self, texts: list[bytes | None], lower: bool = False):
        parts = [t or b"" for t in texts]
        raw = b"\n" + b"\n".join(parts) + b"\n"
        if lower:
            raw = raw.lower()  # bytes: A-Z only
        self.bytes = np.frombuffer(raw, np.uint8)
        self.n = len(parts)
        self.offset = np.ones(self.n + 1, np.int64)
        if self.n:
            self.offset[1:] += np.cumsum(np.fromiter((len(p) + 1 for p in parts), np.int64, self.n))

    def code_points(self) -> np.ndarray:
        """Prefix counts of code points, one entry more than bytes."""
        out = np.zeros(len(self.bytes) + 1, np.int64)
        np.cumsum((self.bytes & 0xC0) != 0x80, out=out[1:])
        return out


class Words:
    """Runs of non-separator bytes: ``start``/``end`` byte positions, ``hash``,
    and ``ptr`` (text i has the words ``ptr[i]:ptr[i+1]``)."""

    def __init__(self, buf: Buffer, sep: np.ndarray):
        word = ~sep[buf.bytes]
        edge = np.flatnonzero(word[1:] != word[:-1]) + 1
        self.start, self.end = edge[0::2], edge[1::2]
        self.ptr = np.searchsorted(self.start, buf.offset)
        self.hash = self._hash(buf.bytes, edge)
        self.n = buf.n

    @staticmethod
    def _hash(raw: np.ndarray, edge: np.ndarray) -> np.ndarray:
        at, inv = np.empty(len(edge), np.uint64), np.empty(len(edge), np.uint64)
        carry, scale, iscale = 0, 1, 1
        end_pow, end_ipow = int(_POW[_PIECE]), int(_IPOW[_PIECE])
        cuts = np.searchsorted(edge, np.arange(0, len(raw) + _PIECE, _PIECE), side="right")
        for k, p in enumerate(range(0, len(raw), _PIECE)):
            piece = raw[p : p + _PIECE]
            s = np.cumsum(_TABLE[piece] * _POW[: len(piece)], dtype=np.uint64)
            lo, hi = cuts[k], cuts[k + 1]
            if hi > lo:
                local = edge[lo:hi] - p
                at[lo:hi] = s[local - 1] * np.uint64(scale) + np.uint64(carry)
                inv[lo:hi] = _IPOW[local] * np.uint64(iscale)
            carry = (carry + int(s[-1]) * scale) & _MASK
            scale, iscale = scale * end_pow & _MASK, iscale * end_ipow & _MASK
        return mix((at[1::2] - at[0::2]) * inv[0::2])

    def text_of(self) -> np.ndarray:
        """For each word, the index of its text."""
        return np.repeat(np.arange(self.n), np.diff(self.ptr))

    def ngrams(self, n: int, at: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the word n-grams that stay inside a text (of those
        ``at`` when given) and their hashes."""
        if at is None:
            last = np.repeat(self.ptr[1:], np.diff(self.ptr))
            at = np.flatnonzero(np.arange(len(self.hash)) + n <= last)
        out = self.hash[at]
        for k in range(1, n):
            out = out * np.uint64(0xD6E8FEB86659FD93) + self.hash[at + k]
        return at, mix(out)


class Lookup:
    """Numbers of 64-bit keys in a sorted array, by a table over their top bits."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.shift = np.uint64(64 - (max(len(keys), 1).bit_length() + 1))
        bounds = np.arange(1 << int(64 - self.shift), dtype=np.uint64) << self.shift
        self.first = np.r_[np.searchsorted(keys, bounds), len(keys)].astype(np.int32)
        self.probes = int(np.diff(self.first).max(initial=0))

    def find(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int32)
        if not len(self.keys):
            return out
        bucket = (keys >> self.shift).astype(np.int64)
        at, stop = self.first[bucket], self.first[bucket + 1]
        left = np.flatnonzero(at < stop)
        for _ in range(self.probes):
            here = at[left]
            same = self.keys[here] == keys[left]
            out[left[same]] = here[same]
            at[left] += 1
            left = left[~same & (here + 1 < stop[left])]
        return out


def chunks(texts: list[bytes | None], limit: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes; a longer text stands alone."""
    lo, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > lo and size + n > limit:
            yield lo, i
            lo, size = i, 0
        size += n
    if len(texts) > lo:
        yield lo, len(texts)


def distinct(x: np.ndarray) -> np.ndarray:
    """The sorted distinct values of a whole-number array."""
    x = np.sort(x)
    return x[np.r_[True, x[1:] != x[:-1]]] if len(x) else x


def numbered(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct values by first place, first place of each, number of each item)."""
    coded = pa.array(x).dictionary_encode()
    number = coded.indices.to_numpy()
    first = np.empty(len(coded.dictionary), np.int64)
    first[number[::-1]] = np.arange(len(x) - 1, -1, -1)
    return coded.dictionary.to_numpy(), first, number


def ragged(start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places start[i] .. start[i] + length[i], and the i of each."""
    of = np.repeat(np.arange(len(start)), length)
    return np.arange(len(of)) - np.repeat(np.cumsum(length) - length, length) + start[of], of


def strings(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The strings ``raw[start[i]:end[i]]`` of a UTF-8 buffer."""
    at, _ = ragged(start, end - start)
    offsets = np.zeros(len(start) + 1, np.int64)
    np.cumsum(end - start, out=offsets[1:])
    return pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(raw[at])).cast(pa.string())


def utf8(column: pa.Array) -> list[bytes | None]:
    """A string column of an Arrow batch as UTF-8 bytes, nulls as None."""
    return column.cast(pa.large_binary()).to_pylist()


def sums(values: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """Sum of ``values[ptr[i]:ptr[i+1]]`` for each i (empty: 0)."""
    c = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=c[1:])
    return c[ptr[1:]] - c[ptr[:-1]]
