import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hiresight.llm import mixing as mx

TARGETS = {"a": 0.6, "b": 0.3, "c": 0.1}


def frames(spark, n=900):
    r = random.Random(8)
    voc = {d: [f"{d}{i}" for i in range(40)] for d in TARGETS}
    rows, labels = [], []
    for i in range(n):
        d = r.choices(list(TARGETS), [1, 2, 3])[0]
        rows.append((i, " ".join(r.choices(voc[d] + [f"w{k}" for k in range(60)], k=r.randint(5, 80))), 1, "q"))
        if i % 2:
            labels.append((i, d))
    rows += [(n, None, 1, "q"), (n + 1, "", 1, "q"), (None, "a1 a2 a3", 1, "q"), (3, rows[3][1], 1, "q"), (n + 2, "b1 " * 1_000, 1, "q")]
    labels += [(1, "zz"), (None, "a"), (2, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, rate int, q string"), spark.createDataFrame(labels, "doc_id long, domain string")


def test_rates_reach_targets(spark):
    docs, labels = frames(spark)
    out = mx.rate_documents(docs, labels, TARGETS).toPandas()
    assert len(out) == docs.count() and (out.rate >= 0).all()
    assert np.allclose(out[["p_a", "p_b", "p_c"]].sum(axis=1), 1)
    total = out.tokens.sum()
    for d, share in TARGETS.items():
        assert abs((out.tokens * out.rate * out[f"p_{d}"]).sum() / total - share) < 1e-3
    assert ((out.copies - out.rate).abs() < 1).all()
    assert abs(out.copies.sum() - out.rate.sum()) < 5 * len(out) ** 0.5
    own = out[out.doc_id == 3]
    assert len(own) == 2 and own.rate.nunique() == 1
    truth = labels.toPandas().dropna().query("domain != 'zz'")
    both = out.merge(truth, on="doc_id")
    assert (both[["p_a", "p_b", "p_c"]].to_numpy().argmax(1) == both.domain.map(list(TARGETS).index)).mean() > 0.95


def test_projection_matches_direct_solver(spark):
    r = np.random.default_rng(0)
    q = r.integers(0, mx.GRID + 1, 300)
    rows = [(i, int(r.integers(1, 50)), [int(x), int(mx.GRID - x)]) for i, x in enumerate(q)]
    df = spark.createDataFrame(rows, "doc_id long, tokens long, q array<int>")
    rates = mx.fit_rates(df, {"x": 0.9, "y": 0.1}, total=float(sum(x[1] for x in rows)), low=0.5, high=3.0, steps=60)
    got = [x["r"] for x in df.select(rates.column(F.col("q")).alias("r")).collect()]
    assert min(got) >= 0.5 and max(got) <= 3.0
    t, p = np.array([x[1] for x in rows], float), np.array([x[2] for x in rows]) / mx.GRID
    reached = (t[:, None] * np.array(got)[:, None] * p).sum(0)
    assert np.allclose(reached, rates.reached)
    aim = t.sum() * np.array([0.9, 0.1])
    # no feasible direction improves: at every rate strictly inside, the residual is orthogonal
    grad = p @ np.linalg.solve((t[:, None] * p).T @ p, reached - aim)
    inside = (np.array(got) > 0.5 + 1e-9) & (np.array(got) < 3 - 1e-9)
    assert np.abs(grad[inside]).max(initial=0) < 5e-3
    assert (grad[np.array(got) <= 0.5 + 1e-9] > -1e-2).all() and (grad[np.array(got) >= 3 - 1e-9] < 1e-2).all()


def test_floor_of_one_and_mix(spark):
    docs, labels = frames(spark, 300)
    mixed = mx.mix(docs, labels, TARGETS, low=1.0, high=20.0)
    assert mixed.columns == docs.columns
    assert mixed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    out = mx.rate_documents(docs, labels, TARGETS, low=1.0, high=20.0).toPandas()
    assert mixed.count() == out.copies.sum() and (out.rate >= 1).all()
    # the same least squares, solved to the end by plain projected steps
    t, p = out.tokens.to_numpy(float), out[["p_a", "p_b", "p_c"]].to_numpy()
    natural, share = t @ p, np.array(list(TARGETS.values()))
    aim, rate = (natural / share).max() * share, np.ones(len(t))
    metric = np.linalg.inv((t[:, None] * p).T @ p)
    for _ in range(20_000):
        rate = np.clip(rate - p @ (metric @ ((t * rate) @ p - aim)), 1, 20)
    loss = [(m := (t * r) @ p - aim) @ metric @ m for r in (out.rate.to_numpy(), rate, np.ones(len(t)))]
    assert loss[0] - loss[1] < 1e-3 * (loss[2] - loss[1])


def test_without_rows_or_labels(spark):
    docs, labels = frames(spark, 20)
    assert mx.rate_documents(docs.limit(0), labels, TARGETS).count() == 0
    out = mx.rate_documents(docs, labels.limit(0), TARGETS).toPandas()
    assert len(out) == docs.count() and out.p_a.nunique() == 1
    assert mx.mix(docs.limit(0), labels, TARGETS).count() == 0


SF = "/root/testdata/sf0.1"


@pytest.mark.skipif(not os.path.isdir(SF), reason="generated test data not present")
def test_classifier_on_rows_it_has_not_seen(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    domains = mx.label_domains(labels)
    model = mx.fit_classifier(docs, domains.where("doc_id % 4 <> 0"), ["good", "poor", "toxic"])
    out = mx.memberships(docs, model).join(domains.where("doc_id % 4 = 0"), "doc_id").toPandas()
    best = np.array(["good", "poor", "toxic"])[np.stack(out.q).argmax(1)]
    assert (best == out.domain).mean() > out.domain.value_counts(normalize=True).max()
