"""PII with a semi-Markov conditional random field (operator 4).

Base rules find emails, IP addresses, cards and phone numbers exactly. The
semi-Markov CRF then segments each run of words that hold a digit or an @ into
entities and other words: features of a whole candidate span (its shape,
lengths, separators, checks, neighbours) score each span and kind, and a
dynamic program over spans of at most ``MAX_LENGTH`` words picks boundaries and
kinds together. Entities that overlap no base span are added. Words without
digit or @ can only be outside of entities, so runs are independent and the
program is exact.

The model is trained here by gradient ascent on the conditional likelihood, on
at most ``sample`` runs, which base spans and long random-looking values label
from a distance. Some copies are varied (no plus sign, a port, a key in front),
so that the model does not just repeat the rules.

Defined results: null and empty texts have no spans; equal rows get equal
rows; overlapping base spans of different kinds all stay; very long words and
texts are read whole; without runs in the corpus the model adds nothing; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import text as tx

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret")
MAX_LENGTH = 6
FEATURES = 1 << 13

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base rules, sorted."""
    out: list[tuple[int, int, int]] = []
    free, at = 0, text.find("@")
    while at >= 0:  # a match has exactly one @: look left and right of each
        first = at
        while first > free and text[first - 1] in _LOCAL:
            first -= 1
        m = _DOMAIN.match(text, at + 1) if first < at else None
        # the next @ may still begin where this run began
        if m:
            out.append((first, 0, m.end()))
            free = m.end()
        else:
            free = max(free, at + 1)
        at = text.find("@", at + 1)
    for m in _IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x[-4:] if len(x) > 4 else x) <= 255 for x in m.groups()):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


# -- runs and features -----------------------------------------------------

_STRIP_LEFT, _STRIP_RIGHT = "\"'(<[{`,;:", ".,;:!?\"')>]}`"
_SECRET = re.compile(r"[A-Za-z0-9_+/=-]{16,}\Z")


def core(word: str) -> tuple[int, int]:
    """Offsets of a word's value: without quotes, punctuation and a key before =."""
    lo, hi = 0, len(word)
    eq = word.find("=")
    if 0 <= eq < hi - 1 and word[eq + 1] != "=":
        lo = eq + 1
    while lo < hi and word[lo] in _STRIP_LEFT and not (word[lo] == "(" and ")" in word):
        lo += 1
    while hi > lo and word[hi - 1] in _STRIP_RIGHT and not (word[hi - 1] == ")" and "(" in word):
        hi -= 1
    return lo, hi


def random_looking(value: str) -> bool:
    """16 or more of key characters, with at least four digits and letters."""
    digits = sum("0" <= c <= "9" for c in value)
    letters = sum(c.isascii() and c.isalpha() for c in value)
    return bool(_SECRET.match(value)) and digits >= 4 and letters >= 4


def _shape(s: str) -> str:
    out = []
    for c in s:
        k = "9" if "0" <= c <= "9" else "a" if c.isalpha() else c
        if not out or out[-1] != k or k not in "9a":
            out.append(k)
    return "".join(out)


def span_features(words: list[str], i: int, j: int, before: str, after: str) -> list[int]:
    """Hashed features of the words i to j (end exclusive) as one span."""
    own = words[i:j]
    lo, _ = core(own[0])
    _, hi = core(own[-1])
    s = own[0][lo:hi] if j == i + 1 else " ".join([own[0][lo:], *own[1:-1], own[-1][:hi]])
    digits = _NOT_DIGIT.sub("", s)
    letters = sum(map(str.isalpha, s))
    groups = [len(x) for x in re.findall("[0-9]+", s)]
    parts = s.split(".") if s.count(".") == 3 else []
    f = ["bias", f"words{j - i}", f"shape{_shape(s)}", f"groups{groups[:6]}", f"digits{min(len(digits), 24)}", f"letters{min(letters, 24) // 3}",
         f"first{s[:1] if not s[:1].isalnum() else 'x'}", f"at{s.count('@')}dots{min(s.count('.'), 5)}", f"long{min(len(s), 48) // 6}",
         f"luhn{12 <= len(digits) <= 19 and luhn(digits)}{letters > 0}",
         f"octets{len(parts) == 4 and all(p.split(':')[0].isdigit() and len(p) < 10 and int(p.split(':')[0]) < 256 for p in parts)}",
         f"mixed{len(digits) >= 4 and letters >= 4}{len(s) >= 16}{' ' in s}", f"key{lo > 0 and '=' in own[0][:lo]}",
         f"before{(words[i - 1] if i else before)[-12:].lower()}", f"left{_shape(words[i - 1])[-6:] if i else '^'}", f"right{_shape(words[j])[:6] if j < len(words) else '$'}"]
    return [zlib.crc32(x.encode("utf-8", "replace")) % FEATURES for x in f]


@dataclass
class Crf:
    """Kind 0 is outside (one word); kinds 1.. are ``KINDS``."""

    weight: np.ndarray
    follow: np.ndarray

    @staticmethod
    def empty() -> Crf:
        k = len(KINDS) + 1
        return Crf(np.zeros((FEATURES, k)), np.zeros((k, k)))

    def scores(self, spans: list[list[list[int]]]) -> list[np.ndarray]:
        """Scores [length, kind] of the spans that begin at each word."""
        out = []
        for own in spans:
            s = self.weight[np.array(own)].sum(1)
            s[1:, 0] = -np.inf
            out.append(s)
        return out

    def best(self, spans: list[list[list[int]]]) -> list[tuple[int, int, int]]:
        """The best segmentation's entities (first, end, kind)."""
        n, k = len(spans), len(self.follow)
        top = np.full((n + 1, k), -np.inf)
        top[0, 0] = 0
        back: dict[tuple[int, int], tuple[int, int]] = {}
        for i, s in enumerate(self.scores(spans)):
            come = top[i][:, None] + self.follow
            last, value = come.argmax(0), come.max(0)
            for length in range(len(s)):
                v = value + s[length]
                for y in np.flatnonzero(v > top[i + length + 1]).tolist():
                    top[i + length + 1, y] = v[y]
                    back[i + length + 1, y] = (i, int(last[y]))
        out, at, y = [], n, int(top[n].argmax())
        while at:
            i, before = back[at, y]
            if y:
                out.append((i, at, y))
            at, y = i, before
        return out[::-1]

    def learn(self, runs: list[tuple[list[list[list[int]]], list[tuple[int, int, int]]]], epochs: int = 6, rate: float = 0.3, decay: float = 1e-4) -> None:
        """AdaGrad on the log-likelihood of the labelled segmentations."""
        k = len(self.follow)
        gw, gf = np.full_like(self.weight, 1e-2), np.full_like(self.follow, 1e-2)
        for epoch in range(epochs):
            for r in np.random.default_rng(epoch).permutation(len(runs)).tolist():
                spans, gold = runs[r]
                n, scores = len(spans), self.scores(spans)
                alpha, beta = np.full((n + 1, k), -np.inf), np.full((n + 1, k), -np.inf)
                alpha[0, 0], beta[n] = 0, 0
                for i in range(n):
                    come = np.logaddexp.reduce(alpha[i][:, None] + self.follow, 0)
                    for length, s in enumerate(scores[i]):
                        alpha[i + length + 1] = np.logaddexp(alpha[i + length + 1], come + s)
                for i in range(n - 1, -1, -1):
                    go = np.logaddexp.reduce([s + beta[i + length + 1] for length, s in enumerate(scores[i])], 0)
                    beta[i] = np.logaddexp.reduce(self.follow + go[None, :], 1)
                z = np.logaddexp.reduce(alpha[n])
                true = {(i, j - i - 1): y for i, j, y in gold}
                inside = {x for i, j, _ in gold for x in range(i, j)}
                true |= {(i, 0): 0 for i in range(n) if i not in inside}
                dfollow = np.zeros_like(self.follow)
                before = 0
                for i, y in sorted((i, y) for (i, _), y in true.items()):
                    dfollow[before, y] += 1
                    before = y
                for i in range(n):
                    pair = alpha[i][:, None] + self.follow
                    for length, s in enumerate(scores[i]):
                        p = np.exp(pair + (s + beta[i + length + 1] - z)[None, :])
                        dfollow -= p
                        d = -p.sum(0)
                        if (i, length) in true:
                            d[true[i, length]] += 1
                        f = spans[i][length]
                        gw[f] += d * d
                        self.weight[f] += rate * (d - decay * self.weight[f]) / np.sqrt(gw[f])
                gf += dfollow**2
                self.follow += rate * dfollow / np.sqrt(gf)


@dataclass(frozen=True)
class Run:
    words: list[str]
    at: list[int]  # code point offsets of the words
    before: str
    after: str


def runs_of(text: str, w: list[tuple[int, int]], wanted: list[int]) -> Iterator[Run]:
    """Runs of neighbouring wanted words; ``w`` are code point ranges of all words."""
    k = 0
    while k < len(wanted):
        e = k
        while e + 1 < len(wanted) and wanted[e + 1] == wanted[e] + 1:
            e += 1
        a, b = wanted[k], wanted[e]
        yield Run([text[w[x][0] : w[x][1]] for x in range(a, b + 1)], [w[x][0] for x in range(a, b + 1)],
                  text[w[a - 1][0] : w[a - 1][1]][-20:] if a else "", text[w[b + 1][0] : w[b + 1][1]][:20] if b + 1 < len(w) else "")
        k = e + 1


_WANTED = tx.separators(b"0123456789@")


def documents_runs(texts: list[bytes | None]) -> Iterator[tuple[int, str, list[Run]]]:
    """(index, text, runs) of the texts that hold a digit or an @."""
    buf = tx.Buffer(texts)
    w = tx.Words(buf, tx.SPACE)
    hit = np.zeros(len(buf.bytes) + 1, np.int32)
    np.cumsum(_WANTED[buf.bytes], out=hit[1:])
    wanted = np.flatnonzero(hit[w.end] > hit[w.start])
    if not len(wanted):
        return
    points = buf.code_points()
    doc = np.searchsorted(w.ptr, wanted, side="right") - 1
    for own in np.split(wanted, np.flatnonzero(np.diff(doc)) + 1):
        d = int(np.searchsorted(w.ptr, own[0], side="right") - 1)
        lo, hi = int(w.ptr[d]), int(w.ptr[d + 1])
        zero = int(points[buf.offset[d]])
        # only the words around the runs are needed
        near = np.unique(np.clip(np.concatenate([own - 1, own, own + 1]), lo, hi - 1))
        place = {int(x): k for k, x in enumerate(near)}
        ranges = list(zip((points[w.start[near]] - zero).tolist(), (points[w.end[near]] - zero).tolist(), strict=True))
        text = texts[d].decode("utf-8", "replace")
        found: list[Run] = []
        for group in np.split(own, np.flatnonzero(np.diff(own) != 1) + 1):
            a, b = int(group[0]), int(group[-1])
            lo_k = place[a - 1] if a > lo else place[a]
            hi_k = place[b + 1] if b + 1 < hi else place[b]
            found += runs_of(text, ranges[lo_k : hi_k + 1], list(range(place[a] - lo_k, place[b] - lo_k + 1)))
        yield d, text, found


def spans_of(run: Run) -> list[list[list[int]]]:
    n = len(run.words)
    return [[span_features(run.words, i, j, run.before, run.after) for j in range(i + 1, min(i + MAX_LENGTH, n) + 1)] for i in range(n)]


def weak_labels(run: Run, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Entities (first, end, kind) of a run, from base spans and random-looking values."""
    out: list[tuple[int, int, int]] = []
    taken = 0
    end_of = [a + len(x) for a, x in zip(run.at, run.words, strict=True)]
    for start, kind, end in base:
        own = [k for k in range(len(run.words)) if run.at[k] < end and end_of[k] > start]
        if own and own[0] >= taken and len(own) <= MAX_LENGTH:
            out.append((own[0], own[-1] + 1, kind + 1))
            taken = own[-1] + 1
    inside = {k for i, j, _ in out for k in range(i, j)}
    for k, word in enumerate(run.words):
        lo, hi = core(word)
        if k not in inside and random_looking(word[lo:hi]):
            out.append((k, k + 1, KINDS.index("secret") + 1))
    return sorted(out)


def _varied(words: list[str], gold: list[tuple[int, int, int]]) -> Iterator[tuple[list[str], list[tuple[int, int, int]]]]:
    """Forms of the same entities that the base rules miss."""
    for i, j, y in gold:
        own = words[i:j]
        kind = KINDS[y - 1]
        if kind == "phone":
            yield [own[0].lstrip("+"), *own[1:]], [(0, j - i, y)]
            if j - i > 1:
                yield own[1:], [(0, j - i - 1, y)]
        elif kind == "ip" and j == i + 1:
            yield [own[0].rstrip(".,;") + ":8080"], [(0, 1, y)]
        elif kind == "secret":
            yield [f'token="{own[0][slice(*core(own[0]))]}",'], [(0, 1, y)]


def fit(docs: DataFrame, sample: int = 1_200) -> Crf:
    """Train on at most ``sample`` runs: those of least hash, entities and others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = tx.utf8(batch.column(0))
            rows = []
            for lo, hi in tx.chunks(texts):
                for _, text, found in documents_runs(texts[lo:hi]):
                    base = base_spans(text)
                    for r in found:
                        if len(r.words) <= 24:
                            own = [b for b in base if b[0] < r.at[-1] + len(r.words[-1]) and b[2] > r.at[0]]
                            x = json.dumps([[v[:200] for v in r.words], r.before, r.after, weak_labels(r, own)])
                            rows.append((zlib.crc32(x.encode()), x))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in rows], pa.int64()), pa.array([b for _, b in rows], pa.string())], names=["h", "run"])

    texts = docs.select(F.col("text").cast("string")).where(F.col("text").rlike("[0-9@]"))
    got = texts.mapInArrow(run, "h long, run string").distinct().orderBy("h", "run").limit(sample).collect()
    examples = []
    for row in got:
        words, before, after, gold = json.loads(row["run"])
        gold = [tuple(g) for g in gold]
        examples.append((spans_of(Run(words, [], before, after)), gold))
        for w, g in _varied(words, gold):
            examples.append((spans_of(Run(w, [], before, after)), g))
    model = Crf.empty()
    model.learn(examples)
    return model


def added_spans(model: Crf, runs: list[Run], base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The model's entities (start, kind number, end) that overlap no base span."""
    out = []
    starts = [b[0] for b in base]
    for r in runs:
        for i, j, y in model.best(spans_of(r)):
            lo, _ = core(r.words[i])
            _, hi = core(r.words[j - 1])
            start, end = r.at[i] + lo, r.at[j - 1] + hi
            if start < end and not any(b[0] < end and b[2] > start for b in base[: np.searchsorted(starts, end)]):
                out.append((start, y - 1, end))
    return out


SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def find(docs: DataFrame, model: Crf) -> DataFrame:
    """``SCHEMA`` for each row of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    nothing = hashlib.sha256(b"").hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = tx.utf8(batch.column(1))
            n = len(texts)
            counts = np.zeros((len(BASE_KINDS), n), np.int64)
            sha, spans, more = [nothing] * n, [""] * n, np.zeros(n, np.int64)
            for lo, hi in tx.chunks(texts):
                for d, text, runs in documents_runs(texts[lo:hi]):
                    base = base_spans(text)
                    added = added_spans(shared.value, runs, base)
                    for _, k, _ in base:
                        counts[k, lo + d] += 1
                    sha[lo + d] = hashlib.sha256(_joined(base).encode()).hexdigest()
                    spans[lo + d] = _joined(sorted(base + added))
                    more[lo + d] = len(added)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c) for c in counts), pa.array(sha), pa.array(spans, pa.string()), pa.array(more)], names=names)

    return docs.selectExpr("CAST(doc_id AS LONG) doc_id", "CAST(text AS STRING) text").mapInArrow(run, SCHEMA)
