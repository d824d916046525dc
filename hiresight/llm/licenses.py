"""License scans (operator 9).

1. Templates: whole texts of short licenses, headers that long ones prescribe,
   the titles of their licence files, and short notices. Terms are words and word
   pairs (``version 2``, ``lesser general``), which tell versions apart. Their
   document frequencies are counted over the whole corpus (for template terms
   only, so the table's size is fixed) and give TF-IDF weights.
2. Headers: stretches of text around template words that matter (``anchors``)
   are compared with every template by the cosine of sparse TF-IDF vectors, in
   windows of the template's length, so that a long file does not dilute a
   clause. The best window (cosine, and longer over shorter templates) is a
   header; what is left of the stretch on both sides is searched again.
   Anchors are chosen so that text without any cannot reach the threshold: by
   Cauchy-Schwarz its cosine is at most the share of a template's norm that
   its other terms have.
3. Inheritance: a licence file names the license of its directory. Every other
   file takes its own header's license, else that of the nearest ancestor
   directory that has one, found by joining the directories' ancestors with
   the licensed directories.

Defined results: null and empty texts have no header; a null path has no
directory and inherits nothing; of several licence files in a directory the
best score counts, then the least license name; of equal headers in a text the
first counts; repeated rows are judged row by row; texts of any length are read
whole; extra columns are ignored; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import text as tx
from .tables import stored

_WARRANTY = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, "
    "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE "
    "LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS "
    "OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, "
    "OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_BSD_2 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
    "and/or other materials provided with the distribution. ")
_BSD_3 = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
    "without specific prior written permission. ")


def _gnu_header(what: str, license_: str, version: str) -> str:
    """The header that the GNU licenses prescribe for version ``version`` or later."""
    return (f"{what} is free software: you can redistribute it and/or modify it under the terms of the GNU {license_} as published by the Free Software "
            f"Foundation, either version {version} of the License, or (at your option) any later version. {what} is distributed in the hope that it will be "
            f"useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {license_} "
            "for more details.")


# Public license texts, headers and notices, by SPDX identifier.
TEMPLATES: dict[str, list[str]] = {
    "AGPL-3.0": [
        _gnu_header("This program", "Affero General Public License", "3"),
        "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy "
        "of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the "
        "License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
        "language governing permissions and limitations under the License.",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "BSD-2-Clause": [
        _BSD_2 + _WARRANTY,
        "Licensed under the BSD 2-Clause License.",
        "SPDX-License-Identifier: BSD-2-Clause",
    ],
    "BSD-3-Clause": [
        _BSD_2 + _BSD_3 + _WARRANTY,
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Licensed under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC0-1.0": [
        "To the extent possible under law, the author has waived all copyright and related rights to this work under CC0 1.0 Universal.",
        "Creative Commons Legal Code CC0 1.0 Universal",
        "SPDX-License-Identifier: CC0-1.0",
    ],
    "EPL-2.0": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at "
        "https://www.eclipse.org/legal/epl-2.0/",
        "Eclipse Public License - v 2.0 THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE",
        "SPDX-License-Identifier: EPL-2.0",
    ],
    "GPL-2.0": [
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc.",
        "SPDX-License-Identifier: GPL-2.0-only",
    ],
    "GPL-2.0-or-later": [
        _gnu_header("This program", "General Public License", "2"),
        "SPDX-License-Identifier: GPL-2.0-or-later",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        _gnu_header("This program", "General Public License", "3"),
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright "
        "notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS "
        "SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
        "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER "
        "TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "SPDX-License-Identifier: ISC",
    ],
    "LGPL-2.1": [
        _gnu_header("This library", "Lesser General Public License", "2.1"),
        "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999 Copyright (C) 1991, 1999 Free Software Foundation, Inc.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ],
    "LGPL-3.0": [
        _gnu_header("This library", "Lesser General Public License", "3"),
        "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal "
        "in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies "
        "of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this "
        "permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, "
        "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL "
        "THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT "
        "OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
        "SPDX-License-Identifier: MIT",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "Mozilla Public License Version 2.0 1. Definitions 1.1. \"Contributor\" means each individual or legal entity that creates, contributes to the creation of, or owns Covered Software.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this "
        "software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ],
}

THRESHOLD = 0.7
#: Words that a header may hold between anchors beyond those of the templates.
SLACK = 4
#: Words around anchors that may belong to a header.
RIM = 3
#: Windows of a template that are compared one by one.
TRIES = 64


@dataclass(frozen=True)
class Scanner:
    words: np.ndarray  # sorted hashes of the template words
    pairs: np.ndarray  # sorted hashes of their word pairs
    idf: np.ndarray  # of the words, then of the pairs
    other: tuple[float, float]  # idf of words and pairs that no template has
    anchor: np.ndarray  # of the words
    names: list[str]
    lengths: np.ndarray  # words of each template
    counts: np.ndarray  # of each template's terms
    norms: np.ndarray
    threshold: float
    gap: int  # words without an anchor that a header may hold in one go


def _number(terms: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Number of each term, -1 if no template has it."""
    return tx.Lookup(terms).find(h).astype(np.int64)


def _pairs(w: tx.Words) -> np.ndarray:
    """The hash of each word with the next one of its text (0 for the last)."""
    out = np.zeros(len(w.hash), np.uint64)
    at, h = w.ngrams(2)
    out[at] = h
    return out


def fit(docs: DataFrame, threshold: float = THRESHOLD) -> Scanner:
    """Count the template terms' document frequencies over all of ``docs``."""
    names = [k for k, v in TEMPLATES.items() for _ in v]
    w = tx.Words(tx.Buffer([t.encode() for v in TEMPLATES.values() for t in v], lower=True), tx.ALNUM)
    pair = _pairs(w)
    words, pairs = np.unique(w.hash), np.unique(pair[pair != 0])
    size = len(words) + len(pairs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 1, np.int64)
        for batch in batches:
            texts = tx.utf8(batch.column(0))
            total[-1] += len(texts)
            for lo, hi in tx.chunks(texts):
                t = tx.Words(tx.Buffer(texts[lo:hi], lower=True), tx.ALNUM)
                one = _number(words, t.hash)
                # a template pair starts with a template word
                at = np.flatnonzero((one[:-1] >= 0) & (one[1:] >= 0)) if len(one) else np.zeros(0, np.int64)
                two = _number(pairs, t.ngrams(2, at)[1])
                doc = t.text_of()
                at, two = at[(two >= 0) & (doc[at] == doc[at + 1])], two[(two >= 0) & (doc[at] == doc[at + 1])]
                own = np.flatnonzero(one >= 0)
                once = tx.distinct(np.r_[doc[own] * size + one[own], doc[at] * size + len(words) + two])
                total[:-1] += np.bincount(once % size, minlength=size)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["term", "df"])

    got = (docs.select(F.col("text").cast("string")).mapInArrow(run, "term long, df long")
           .groupBy("term").agg(F.sum("df").alias("df")).toPandas())
    df = np.zeros(size + 1)
    df[got["term"]] = got["df"]
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 1
    counts = np.zeros((len(names), size))
    one, two = _number(words, w.hash), _number(pairs, pair)
    for k in range(len(names)):
        own = slice(w.ptr[k], w.ptr[k + 1])
        counts[k] = np.bincount(np.r_[one[own], len(words) + two[own][:-1]], minlength=size)
    vectors = counts * idf
    norms = np.linalg.norm(vectors, axis=1)
    # the commonest words are no anchors, as long as they cannot reach the threshold together with the pairs of them
    anchor = np.ones(len(words), bool)
    first, second = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
    at = np.flatnonzero(pair != 0)
    first[two[at]], second[two[at]] = one[at], one[at + 1]
    for i in np.argsort(idf[: len(words)], kind="stable"):
        anchor[i] = False
        plain = np.r_[~anchor, ~anchor[first] & ~anchor[second]]
        if (np.linalg.norm(vectors[:, plain], axis=1) / norms).max() >= threshold * 0.9:
            anchor[i] = True
    other = (float(np.median(idf[: len(words)])), float(np.median(idf[len(words) :])))
    # the longest run of plain words in a template, and some words more
    stops = np.flatnonzero(np.concatenate([np.r_[True, anchor[one[w.ptr[k] : w.ptr[k + 1]]]] for k in range(len(names))]))
    gap = int(np.diff(stops).max()) + SLACK
    return Scanner(words, pairs, idf, other, anchor, names, np.diff(w.ptr), counts, norms, threshold, gap)


class _Text:
    """The terms of one text's words lo..hi, numbered."""

    def __init__(self, s: Scanner, one: np.ndarray, pair: np.ndarray):
        self.s, self.one = s, one
        two = _number(s.pairs, pair)
        self.two = np.where(two >= 0, len(s.words) + two, -1)
        square = np.r_[s.idf**2, 0.0]
        self.norm = [np.r_[0, np.cumsum(np.where(t >= 0, square[t], other**2))] for t, other in zip((self.one, self.two), s.other, strict=True)]
        self.value = square

    def best(self, lo: int, hi: int) -> tuple[float, float, int, int, int]:
        """(rank, cosine, template, first, end) of the best window in lo..hi."""
        s, found = self.s, (0.0, 0.0, -1, 0, 0)
        for k in range(len(s.names)):
            m = min(int(s.lengths[k]), hi - lo)
            weight = np.r_[s.counts[k], 0.0] * self.value
            dot = [np.r_[0, np.cumsum(weight[t[lo:hi]])] for t in (self.one, self.two)]
            at = np.arange(hi - lo - m + 1)
            # the least norm a window can have, so the most its cosine can be
            least = np.sqrt(self.norm[0][lo + at + m] - self.norm[0][lo + at] + self.norm[1][lo + at + m - 1] - self.norm[1][lo + at])
            most = (dot[0][at + m] - dot[0][at] + dot[1][at + m - 1] - dot[1][at]) / np.maximum(least * s.norms[k], 1e-300)
            rank, tried = np.log1p(s.lengths[k]), 0
            open_ = np.flatnonzero((most >= s.threshold) & (most * rank > found[0]))
            for a in open_[np.argsort(-most[open_], kind="stable")].tolist():
                if most[a] * rank <= found[0]:
                    break
                tried += 1
                if tried > TRIES:  # many repeated words: their norms at once, then only the best window
                    norms = np.sqrt(self.squares(self.one[lo:hi], 0, m) + self.squares(self.two[lo : hi - 1], 1, m - 1))
                    exact = (dot[0][at + m] - dot[0][at] + dot[1][at + m - 1] - dot[1][at]) / (norms * s.norms[k])
                    a = int(exact.argmax())
                cosine = self.cosine(k, lo + a, lo + a + m)
                if cosine >= s.threshold and cosine * rank > found[0] + 1e-9:
                    found = (cosine * rank, cosine, k, lo + a, lo + a + m)
                if tried > TRIES:
                    break
        return found

    def squares(self, terms: np.ndarray, kind: int, m: int) -> np.ndarray:
        """The squared norm of each window of ``m`` terms, sliding over them."""
        count, total, out = [0] * len(self.value), 0.0, []
        value, other, listed = self.value.tolist(), self.s.other[kind] ** 2, terms.tolist()
        for q, t in enumerate(listed):
            total += value[t] * (2 * count[t] + 1) if t >= 0 else other
            count[t] += 1
            if q >= m:
                u = listed[q - m]
                count[u] -= 1
                total -= value[u] * (2 * count[u] + 1) if u >= 0 else other
            if q >= m - 1:
                out.append(total)
        return np.array(out)

    def cosine(self, k: int, a: int, b: int) -> float:
        s, terms = self.s, np.r_[self.one[a:b], self.two[a : b - 1]]
        known = terms[terms >= 0]
        tf = np.bincount(known, minlength=len(s.idf))
        strange = [int((t < 0).sum()) * other**2 for t, other in zip((self.one[a:b], self.two[a : b - 1]), s.other, strict=True)]
        norm = np.sqrt(((tf * s.idf) ** 2).sum() + sum(strange))
        return round(float((tf * s.idf**2) @ s.counts[k] / (norm * s.norms[k])), 9)


def headers(s: Scanner, texts: list[bytes | None]) -> list[list[tuple[str, float, int, int]]]:
    """(license, cosine, first word, end word) of the windows of each text that
    reach the threshold, in text order; windows do not overlap."""
    w = tx.Words(tx.Buffer(texts, lower=True), tx.ALNUM)
    out: list[list[tuple[str, float, int, int]]] = [[] for _ in texts]
    one = _number(s.words, w.hash)
    at = np.flatnonzero((one >= 0) & s.anchor[one])
    if not len(at):
        return out
    pair = _pairs(w)
    doc = np.searchsorted(w.ptr, at, side="right") - 1
    cut = np.flatnonzero((np.diff(at) > s.gap) | (np.diff(doc) != 0))
    for a, b, d in zip(at[np.r_[0, cut + 1]].tolist(), at[np.r_[cut, len(at) - 1]].tolist(), doc[np.r_[0, cut + 1]].tolist(), strict=True):
        # common words at a notice's rim are no anchors
        lo, hi = max(a - RIM, int(w.ptr[d])), min(b + 1 + RIM, int(w.ptr[d + 1]))
        text, left = _Text(s, one[lo:hi], pair[lo:hi]), [(0, hi - lo)]
        anchors = np.r_[0, np.cumsum((one[lo:hi] >= 0) & s.anchor[one[lo:hi]])]
        while left:
            x, y = left.pop()
            if y - x < 2 or anchors[y] == anchors[x]:
                continue
            _, cosine, k, first, end = text.best(x, y)
            if k >= 0:
                out[d].append((s.names[k], cosine, lo + first - int(w.ptr[d]), lo + end - int(w.ptr[d])))
                left += [(x, first), (end, y)]
    return [sorted(h, key=lambda x: x[2]) for h in out]


def scan(files: DataFrame, scanner: Scanner) -> DataFrame:
    """(doc_id, path, own_license, own_score, n_headers) of each row of
    ``files`` (doc_id, path, text); the best header counts, then the first."""
    shared = files.sparkSession.sparkContext.broadcast(scanner)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = tx.utf8(batch.column(2))
            found = [h for lo, hi in tx.chunks(texts) for h in headers(shared.value, texts[lo:hi])]
            best = [max(h, key=lambda x: x[1]) if h else (None, None) for h in found]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([x[0] for x in best], pa.string()), pa.array([x[1] for x in best], pa.float64()),
                pa.array([len(h) for h in found], pa.int64())], names=["doc_id", "path", "own_license", "own_score", "n_headers"])

    return (files.selectExpr("CAST(doc_id AS LONG) doc_id", "CAST(path AS STRING) path", "CAST(text AS STRING) text")
            .mapInArrow(run, "doc_id long, path string, own_license string, own_score double, n_headers long"))


def inherit(scanned: DataFrame, licence_name: str = r"(?i)^(licen[cs]e|copying)([.-].*)?$") -> DataFrame:
    """``scanned`` with ``license`` and ``inherited_from`` (the ancestor
    directory that gives it; null for an own header). The narrow scan result is
    stored, as three steps read it."""
    scanned = stored(scanned)
    path = F.regexp_replace(F.regexp_replace("path", r"/+", "/"), r"^(\./|/)", "")
    rows = scanned.withColumn("dir", F.when(F.col("path").isNotNull(), F.regexp_replace(path, r"/?[^/]*$", "")))
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    licensed = (rows.where(F.col("own_license").isNotNull() & F.col("dir").isNotNull() & name.rlike(licence_name))
                .groupBy(F.col("dir").alias("ancestor"))
                .agg(F.min(F.struct((-F.col("own_score")).alias("s"), F.col("own_license").alias("l")))["l"].alias("dir_license")))
    # one row per directory, not per file, meets the ancestors
    parts = F.split("dir", "/")
    ancestors = F.transform(F.sequence(F.lit(0), F.when(F.col("dir") == "", 0).otherwise(F.size(parts))), lambda k: F.struct(
        k.alias("depth"), F.array_join(F.slice(parts, 1, k), "/").alias("ancestor")))
    nearest = (rows.where("dir IS NOT NULL").select("dir").distinct().select("dir", F.inline(ancestors))
               .join(licensed, "ancestor").groupBy("dir")
               .agg(F.max(F.struct("depth", "ancestor", "dir_license")).alias("near")))
    joined = rows.join(nearest, "dir", "left")
    own = F.col("own_license").isNotNull()
    return joined.select(
        "doc_id", "path", "own_license", "own_score", "n_headers",
        F.coalesce("own_license", F.col("near.dir_license")).alias("license"),
        F.when(~own, F.col("near.ancestor")).alias("inherited_from"))


def document_paths(docs: DataFrame) -> DataFrame:
    """A file tree over ``documents`` (it has no paths): source, language and
    thousands of the id are directories; every fiftieth id names a licence
    file, of its source for ids that 1000 divides."""
    id_ = F.col("doc_id")
    by_source = F.concat_ws("/", F.coalesce("source", F.lit("unknown")))
    deep = F.concat_ws("/", F.coalesce("source", F.lit("unknown")), F.coalesce("lang", F.lit("und")), F.floor(id_ / 1000).cast("string"))
    path = (F.when(id_ % 1000 == 0, F.concat_ws("/", by_source, F.lit("LICENSE")))
            .when(id_ % 50 == 0, F.concat_ws("/", deep, F.lit("LICENSE")))
            .otherwise(F.concat_ws("/", deep, F.concat(F.lit("doc-"), id_.cast("string"), F.lit(".txt")))))
    return docs.select("doc_id", path.alias("path"), "text")
