import os
import random

import numpy as np
import pytest

from hiresight.llm import toxicity as tox


def ruzzo_tompa_brute(s):
    """Maximal segments by their recursive definition."""
    def best(lo, hi):
        top = max(((sum(s[a:b]), -(b - a), -a) for a in range(lo, hi) for b in range(a + 1, hi + 1)), default=(0, 0, 0))
        if top[0] <= 0:
            return []
        a, n = -top[2], -top[1]
        return best(lo, a) + [(a, a + n, top[0])] + best(a + n, hi)
    return best(0, len(s))


def test_segments_match_definition():
    r = random.Random(3)
    for _ in range(60):
        s = [r.choice([-3, -1, -1, 2, 5, 1]) + r.randint(0, 1000) / 1e6 for _ in range(r.randint(0, 22))]
        run = np.r_[0.0, np.cumsum(s)]
        at = [i for i, x in enumerate(s) if x > 0]
        got = tox.maximal_segments(at, [run[i] for i in at], [run[i + 1] for i in at])
        want = ruzzo_tompa_brute(s)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert np.allclose([x for *_, x in got], [x for *_, x in want])


def frames(spark, n=400):
    r = random.Random(1)
    voc = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(n):
        w = r.choices(voc, k=r.randint(20, 200))
        bad = i % 5 == 1
        if bad:
            k = r.randint(0, len(w))
            w[k:k] = r.choices(["zounds", "blast", "drat"], k=6)
        rows.append((i, " ".join(w), 0.5, "s"))
        labels.append((i, int(bad)))
    rows += [(1000, None, .1, "s"), (1001, "", .2, "s"), (None, "zounds blast drat zounds drat", .1, "s"), (7, rows[7][1], .5, "s"),
             (1002, "x" * 300_000 + " w1 " * 50_000, .1, "s")]
    labels += [(1, 1), (2, None), (None, 1)]
    return (spark.createDataFrame(rows, "doc_id long, text string, score double, segments string"),
            spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_operator(spark):
    docs, labels = frames(spark)
    model = tox.fit(docs, labels)
    out = tox.score(docs, model).collect()
    assert len(out) == docs.count()
    for r in out:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        if r["doc_id"] is not None and r["doc_id"] < 1000:
            assert r["predicted"] == int(r["doc_id"] % 5 == 1), r
            assert bool(r["segments"]) == (r["doc_id"] % 5 == 1)
    assert [r["predicted"] for r in out if r["doc_id"] is None] == [1]
    assert [r["predicted"] for r in out if r["doc_id"] in (1000, 1001, 1002)] == [0, 0, 0]
    kept = tox.drop_toxic(docs, model)
    assert kept.schema == docs.schema and kept.count() == len([r for r in out if not r["predicted"]])


def test_without_labels_or_rows(spark):
    docs, labels = frames(spark, 20)
    model = tox.fit(docs, labels.limit(0))
    assert {r["predicted"] for r in tox.score(docs, model).collect()} == {0}
    assert tox.score(docs.limit(0), model).count() == 0
    one = tox.fit(docs, spark.createDataFrame([(3, 0), (4, 0)], "doc_id long, toxic int"))
    assert {r["predicted"] for r in tox.score(docs, one).collect()} == {0}


SF = "/root/testdata/sf0.1"


@pytest.mark.skipif(not os.path.isdir(SF), reason="generated test data not present")
def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out = tox.score(docs, tox.fit(docs, labels)).where("held_out").join(labels, "doc_id").select("predicted", "toxic").toPandas()
    hit = ((out.predicted == 1) & (out.toxic == 1)).sum()
    assert hit / (out.predicted == 1).sum() > 0.9 and hit / (out.toxic == 1).sum() > 0.85
