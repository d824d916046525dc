import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest

from hiresight.llm import periodic_runs as pr
from hiresight.llm import text as tx
from hiresight.llm.queries import LLM_QUERIES

W = re.compile(r"[^\x20\x09-\x0D]+")


def smallest_period(w):
    border = [0] * len(w)
    for i in range(1, len(w)):
        k = border[i - 1]
        while k and w[i] != w[k]:
            k = border[k - 1]
        border[i] = k + (w[i] == w[k])
    return len(w) - border[-1]


def brute(w, least=12):
    """Every diagonal of the whole table, and the smallest period by borders."""
    out = []
    for q in range(1, len(w) // 2 + 1):
        i = q
        while i < len(w):
            j = i
            while j < len(w) and w[j] == w[j - q]:
                j += 1
            s, e = i - q, j
            if j > i and e - s >= max(least, 2 * q) and smallest_period(w[s:e]) == q:
                out.append((s, e - s, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def found(texts, least=12):
    w = tx.Words(tx.Buffer([t.encode() for t in texts]), tx.SPACE)
    doc, *rest = pr.find(w.hash, w.ptr, least)
    out = [[] for _ in texts]
    for d, *r in zip(doc.tolist(), *(x.tolist() for x in rest), strict=True):
        out[d].append(tuple(r))
    return out


def random_text(r):
    kind = r.randint(0, 5)
    letters = "abcdefgh"[: r.choice([1, 2, 2, 3, 8])]
    w = [r.choice(letters) for _ in range(r.randint(0, 90))]
    if kind == 1:  # a period in the middle
        p = [r.choice(letters) for _ in range(r.randint(1, 15))]
        k = r.randint(0, len(w))
        w[k:k] = p * r.randint(2, 6) + p[: r.randint(0, len(p))]
    elif kind == 2:  # powers of powers
        p = [r.choice("ab") for _ in range(r.randint(1, 4))]
        w = ((p * r.randint(1, 4) + ["c"]) * r.randint(2, 5) + ["d"]) * r.randint(1, 4) + w[:5]
    elif kind == 3:  # Fibonacci words hold runs of many periods
        a, b = ["a"], ["a", "b"]
        while len(b) < 140:
            a, b = b, b + a
        w = b[r.randint(0, 20):]
    elif kind == 4:  # Thue-Morse: powers of two are all it has
        w = [bin(i).count("1") % 2 * "x" or "y" for i in range(r.randint(1, 200))]
    return " ".join(w)


@pytest.mark.parametrize("least", [12, 2, 5, 13])
def test_equals_the_whole_table(least):
    r = random.Random(least)
    texts = [random_text(r) for _ in range(700)]
    for t, got in zip(texts, found(texts, least), strict=True):
        assert got == brute(t.split(), least), t


def test_texts_do_not_mix_and_pieces_do_not_matter():
    r = random.Random(5)
    texts = ["a b c d e f g h"] * 9 + [random_text(r) for _ in range(60)]
    together = found(texts)
    assert together == [found([t])[0] for t in texts] and not any(together[:9])
    cells, pr._CELLS = pr._CELLS, 7
    try:
        assert found(texts) == together
    finally:
        pr._CELLS = cells


def test_very_long_texts():
    began = time.time()
    n = 1_000_000
    assert found(["bat " * n])[0] == [(0, n, 1)]
    line = "to be or not to be that is the question "
    assert found([line * 100_000])[0] == [(0, n, 10)]
    r = random.Random(9)
    big = [str(r.randint(0, 50_000)) for _ in range(200_000)]
    assert (77, 600_000, 200_000) in found([" ".join(["-"] * 77 + big * 3)])[0]
    assert time.time() - began < 120


def test_operator_and_odd_input(spark):
    r = random.Random(2)
    texts = [random_text(r) for _ in range(150)] + [None, "", " \t\x0b", "É\xa0é " * 20, "one"]
    rows = [(i, t, "x", 1.0) for i, t in enumerate(texts)] + [(3, texts[3], "y", 2.0), (None, "a " * 12, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs string, collapsed double").repartition(4)
    got = sorted((str(x["doc_id"]), [tuple(q) for q in x["runs"]], x["collapsed"]) for x in pr.periodic_runs(df).collect())
    want = sorted((str(i), brute(W.findall(t or "")), collapsed(W.findall(t or ""), brute(W.findall(t or "")))) for i, t, *_ in rows)
    assert got == want
    assert pr.periodic_runs(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        pr.periodic_runs(df, 1)


def contract(rows):
    out = []
    for i, t in rows:
        w = W.findall(t or "")
        n = len(w)
        h = zlib.crc32(("" if i is None else str(i)).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
        runs = brute(w)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None, None, None)
        listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        out.append((i, len(runs), best[0], best[1], best[2], 1000 * best[1] // best[2] if runs else None,
                    hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed(w, runs).encode()).hexdigest()))
    return sorted(out, key=str)


def test_query_on_planted_periods(spark, tmp_path):
    r = random.Random(8)
    rows = [(i, " ".join(r.choice(["a", "b", "the", "of", str(r.randint(0, 99))]) for _ in range(r.randint(0, 160)))) for i in range(250)]
    rows += [(1000 + i, None if i % 2 else "") for i in range(40)] + [(None, "w x y z " * 9)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(x) for x in LLM_QUERIES["op12_periodic_runs"](spark, str(tmp_path)).collect()), key=str)
    assert got == contract(rows) and sum(x[1] > 0 for x in got) >= 15


def test_query_on_the_generated_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(x) for x in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    small = [x for x in rows if len(x[1] or "") < 6000]
    got = {x["doc_id"]: tuple(x) for x in LLM_QUERIES["op12_periodic_runs"](spark, sf).collect()}
    assert len(got) == len(rows) and sorted((got[i] for i, _ in small), key=str) == contract(small)


def test_ragged():
    at, of = tx.ragged(np.array([5, 9, 0]), np.array([2, 0, 3]))
    assert at.tolist() == [5, 6, 0, 1, 2] and of.tolist() == [0, 0, 2, 2, 2]
