import random

import numpy as np

from hiresight.llm import licenses as li


def filler(r, n):
    return " ".join(r.choices([f"w{i}" for i in range(50)] + ["the", "of", "and", "this", "with", "to"], k=n))


def files():
    r = random.Random(3)
    rows, want = [], {}
    notices = [(k, t) for k, v in li.TEMPLATES.items() for t in v]
    for i in range(200):
        body = [filler(r, r.randint(5, 80)) for _ in range(4)]
        own = None
        if i % 4 == 0:
            own, t = notices[(i // 4) % len(notices)]
            body.insert(r.randint(0, 4), t)
        rows.append((i, f"proj{i % 3}/src/d{i % 5}/f{i}.py", "\n".join(body), "x"))
        want[i] = own
    return rows, want


def test_headers_and_inheritance(spark):
    rows, want = files()
    mit, gpl = li.TEMPLATES["MIT"][2], li.TEMPLATES["GPL-3.0"][1]
    rows += [(900, "proj0/LICENSE", mit, "x"), (901, "proj0/src/d1/COPYING.txt", gpl, "x"), (902, "proj0/src/d1/LICENSE", "nothing here", "x"),
             (903, None, None, "x"), (904, "a//b/x.py", "", "x"), (905, "./a/LICENCE", mit, "x"), (None, "top.py", "text", "x"), (906, "proj1/license-notes.md", "none", "x")]
    df = spark.createDataFrame(rows, "doc_id long, path string, text string, license string").repartition(6)
    scanner = li.fit(df)
    out = {r["doc_id"]: r for r in li.inherit(li.scan(df, scanner)).collect()}
    assert len(out) == len(rows)
    for i, own in want.items():
        r = out[i]
        assert r["own_license"] == own, (r, own)
        assert r["n_headers"] == (own is not None)
        if own:
            assert r["license"] == own and r["inherited_from"] is None
        elif i % 3 == 0:
            assert (r["license"], r["inherited_from"]) == (("GPL-3.0", "proj0/src/d1") if i % 5 == 1 else ("MIT", "proj0"))
        else:
            assert r["license"] is None and r["inherited_from"] is None
    assert out[904]["license"] == "MIT" and out[904]["inherited_from"] == "a"
    assert out[903]["license"] is None and out[None]["license"] is None and out[902]["license"] == "GPL-3.0"


def scanner_of(spark):
    rows, _ = files()
    return li.fit(spark.createDataFrame(rows, "doc_id long, path string, text string, license string"))


def test_pruning_by_anchors_loses_nothing(spark):
    s = scanner_of(spark)
    r = random.Random(1)
    plain = [w for v in li.TEMPLATES.values() for t in v for w in t.lower().split()]
    seen = 0
    for _ in range(3000):  # any text without an anchor stays under the threshold
        t = " ".join(r.choices(plain, k=r.randint(2, 12))).encode()
        w = li.tx.Words(li.tx.Buffer([t], lower=True), li.tx.ALNUM)
        n = li._number(s.words, w.hash)
        keep = (n >= 0) & ~s.anchor[n]
        if keep.sum() > 1:
            text = li._Text(s, n[keep], np.zeros(keep.sum(), np.uint64))
            assert max(text.cosine(k, 0, int(keep.sum())) for k in range(len(s.names))) < s.threshold
            seen += 1
    assert seen > 300


def test_best_window_equals_all_windows(spark):
    s = scanner_of(spark)
    r = random.Random(4)
    notices = [t for v in li.TEMPLATES.values() for t in v]
    for i in range(14):
        li.TRIES = 64 if i % 2 else 0  # both ways of finding the best window
        t = " ".join([filler(r, r.randint(0, 9)), r.choice(notices), filler(r, r.randint(0, 9)), r.choice(notices)]).encode()
        w = li.tx.Words(li.tx.Buffer([t], lower=True), li.tx.ALNUM)
        text = li._Text(s, li._number(s.words, w.hash), li._pairs(w))
        n = len(w.hash)
        every = [(c * np.log1p(s.lengths[k]), c) for k in range(len(s.names)) for m in [min(int(s.lengths[k]), n)]
                 for a in range(n - m + 1) for c in [text.cosine(k, a, a + m)] if c >= s.threshold]
        assert abs(text.best(0, n)[0] - max(every)[0]) < 1e-6
    assert li.TRIES == 64


YEAR = "Copyright (c) 2019, The Oak Authors. All rights reserved.\n\n"
GNU = """ * {0} is free software{3} you can redistribute it and/or
 * modify it under the terms of the GNU {1} as published by
 * the Free Software Foundation; either version {2} of the License, or
 * (at your option) any later version.
 *
 * {0} is distributed in the hope that it will be useful,
 * but WITHOUT ANY WARRANTY; without even the implied warranty of
 * MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU
 * {1} for more details.
 *
 * You should have received a copy of the GNU {1}
 * along with {0}; if not, write to the Free Software Foundation.
 */
"""


def code(r):
    return "\n".join(f"def f{i}(x{i}): return {filler(r, 6)}" for i in range(40))


def test_files_and_headers_as_they_occur(spark):
    s = scanner_of(spark)
    r = random.Random(9)
    full = {k: max(li.TEMPLATES[k], key=len) for k in li.TEMPLATES}
    cases = {
        "LGPL-2.1": "/*\n" + GNU.format("This library", "Lesser General Public\n * License", "2.1", ";") + code(r),
        "GPL-2.0-or-later": "/* oak.c\n" + GNU.format("Oak", "General Public License", "2", ";") + code(r),
        "GPL-3.0": "/* oak.c\n" + GNU.format("This program", "General Public License", "3", ":") + code(r),
        "AGPL-3.0": "# oak.py\n" + GNU.format("This program", "Affero General Public License", "3", ":").replace(" *", "#") + code(r),
        "LGPL-3.0": "/*\n" + GNU.format("This library", "Lesser General Public License", "3", ":") + code(r),
        "BSD-2-Clause": "BSD 2-Clause License\n\n" + YEAR + full["BSD-2-Clause"],
        "BSD-3-Clause": YEAR + full["BSD-3-Clause"].replace("the copyright holder nor", "Oak Inc. nor"),
        "MIT": "The MIT License (MIT)\n\n" + YEAR + full["MIT"],
        "Apache-2.0": "# " + YEAR.strip() + "\n" + "\n".join("# " + x for x in full["Apache-2.0"].split(". ")) + "\n" + code(r),
        "MPL-2.0": "/* " + li.TEMPLATES["MPL-2.0"][0].replace(". ", ".\n * ") + " */\n" + code(r),
        "CC0-1.0": "Creative Commons Legal Code\n\nCC0 1.0 Universal\n\n    " + filler(r, 300),
        "ISC": "ISC License\n\n" + YEAR + full["ISC"],
        "EPL-2.0": "/****\n * " + full["EPL-2.0"] + "\n *\n * SPDX-License-Identifier: EPL-2.0\n */\n" + code(r),
        "GPL-2.0": "                    GNU GENERAL PUBLIC LICENSE\n                       Version 2, June 1991\n\n Copyright (C) 1989, 1991 Free Software Foundation, Inc.,\n" + filler(r, 400),
        "Unlicense": full["Unlicense"] + "\n\n" + filler(r, 60),
    }
    found = li.headers(s, [t.encode() for t in cases.values()])
    for (want, _), h in zip(cases.items(), found, strict=True):
        # every header of the text names that license: no neighbour beside it
        assert h and {x[0] for x in h} == {want}, (want, h)


def test_long_texts_ties_and_repeats(spark):
    s = scanner_of(spark)
    r = random.Random(2)
    mit = li.TEMPLATES["MIT"][3]
    long = " ".join([filler(r, 100_000), mit, filler(r, 50_000), li.TEMPLATES["Apache-2.0"][1]])
    assert [(x[0], round(x[1], 6)) for x in li.headers(s, [long.encode()])[0]] == [("MIT", 1.0), ("Apache-2.0", 1.0)]
    for dense in ("license software copyright " * 20_000, "license " * 50_000):  # anchors only, and no license
        assert li.headers(s, [dense.encode()]) == [[]]
    rows = [(1, "a/x", mit), (1, "a/x", mit), (2, "b/LICENSE", li.TEMPLATES["MIT"][0]), (2, "b/LICENSE.txt", li.TEMPLATES["Apache-2.0"][0]), (3, "b/y", "no header")]
    df = spark.createDataFrame(rows, "doc_id long, path string, text string")
    got = sorted((x["doc_id"], x["license"]) for x in li.inherit(li.scan(df, s)).collect())
    assert got == [(1, "MIT"), (1, "MIT"), (2, "Apache-2.0"), (2, "MIT"), (3, "Apache-2.0")]  # equal scores: the least name


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, path string, text string")
    assert li.inherit(li.scan(df, li.fit(df))).count() == 0
