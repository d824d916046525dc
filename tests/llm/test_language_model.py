import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from hiresight.llm import language_model as lm

W = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(t):
    return W.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [None]


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2


def corpus(n=240):
    r = random.Random(6)
    tongue = [[f"{a}{b}{e}" for a in "bcdfg" for b in "aei" for e in ends] for ends in ("t", "so", "xx.", "é")]
    rows = []
    for i in range(n):
        v = r.choice(tongue)
        rows.append((i, " ".join(r.choices(v[:8], k=r.randint(0, 40)) + r.choices(v, k=r.randint(0, 40)) + [f"rare{i}X"] * (i % 3)).title()))
    return rows + [(500, None), (501, ""), (None, "bat"), (7, rows[7][1]), (7, rows[7][1]), (502, "never seen\tthis\x0bword"), (503, "bat " * 50_000)]


def base(rows):
    c = Counter(x for i, t in rows if not held(i) for x in tokens(t))
    n, v = sum(c.values()), len(c)
    out = []
    for i, t in rows:
        w = tokens(t)
        out.append((i, held(i), len(w), sum(c[x] > 0 for x in w), n, sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w)))
    return out


def key(r):
    return (r[0] is None, r[0] or 0, r[2])


def test_base_is_exact_and_model_is_better(spark):
    rows = corpus()
    df = spark.createDataFrame([(i, t, 1.0, "k") for i, t in rows], "doc_id long, text string, score double, key string").repartition(5)
    for hot in (1 << 18, 40, 0):  # counts by broadcast, by both ways, by join
        model, rare = lm.fit(df, hot_words=hot)
        assert len(model.hot.keys) <= hot
        got = sorted((tuple(r) for r in lm.score(df, model, rare).collect()), key=key)
        want = sorted(base(rows), key=key)
        assert [g[:5] for g in got] == [w[:5] for w in want]
        assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-9, atol=1e-9)
        unseen = [(g[5], g[6]) for g in got if g[1] and g[2] < 1000]
        assert sum(s for _, s in unseen) > sum(b for b, _ in unseen) * (0.9 if hot else 1.1)


def test_scores_do_not_depend_on_neighbours_or_tasks(spark):
    rows = corpus()
    schema = "doc_id long, text string"
    df = spark.createDataFrame(rows, schema).repartition(5)
    model, rare = lm.fit(df, hot_words=60)
    other, _ = lm.fit(spark.createDataFrame(rows[::-1], schema).repartition(3), hot_words=60)
    assert np.array_equal(model.weight, other.weight) and np.array_equal(model.prior, other.prior) and np.array_equal(model.scale, other.scale)
    together = {(r["doc_id"], r["n_tokens"]): r["score"] for r in lm.score(df.coalesce(1), model, rare).collect()}
    for i in (0, 7, 501, 502, 503):  # 503 is very long
        alone = lm.score(df.where(f"doc_id = {i}"), model, rare).first()
        assert np.isclose(alone["score"], together[i, alone["n_tokens"]], rtol=1e-13, atol=0)


def test_lookup():
    r = np.random.default_rng(2)
    for n in (0, 1, 7, 5000):
        keys = np.unique(r.integers(0, 1 << 64, n, dtype=np.uint64))
        look = lm.Lookup(keys)
        probe = np.concatenate([keys, r.integers(0, 1 << 64, 300, dtype=np.uint64)])
        want = [{k: i for i, k in enumerate(keys.tolist())}.get(k, -1) for k in probe.tolist()]
        assert look.find(probe).tolist() == want
    close = np.sort(np.array([5, 6, 7, 8, (1 << 64) - 1], np.uint64))  # one bucket holds four
    assert lm.Lookup(close).find(np.array([4, 5, 8, 9, (1 << 64) - 1], np.uint64)).tolist() == [-1, 0, 3, -1, 4]


def test_updates_equal_their_definitions(spark, monkeypatch):
    monkeypatch.setattr(lm, "FAN_IN", 2)  # a tree of three levels
    rows = corpus(60)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model, _ = lm.fit(df, hot_words=60)
    texts = df.select("text").repartition(7)
    t = lm.Tokens([x.encode() if x else None for _, x in rows])
    number = model.hot.find(t.hash)
    want = np.zeros(model.weight.shape, np.int64)
    gain = lambda scale: sum((p := lm.replace(model, scale=scale)).log_probability(t, number).sum() for _ in [0]) * np.log(10)
    for at, taken, prior, feature_rows in model.rows_of(t, number):
        for r in feature_rows:
            np.add.at(want, (r, taken), 1)
    assert np.array_equal(lm.observe(texts, model), want)
    # a Newton step from scales of 0.3 goes uphill, and stands still at the top
    low = lm.replace(model, scale=np.full(model.scale.shape, 0.3))
    first = lm.newton(texts, low)
    assert gain(first) > gain(low.scale)
    top = low
    for _ in range(12):
        top = lm.replace(top, scale=lm.newton(texts, top))
    slope = [(gain(top.scale + d) - gain(top.scale - d)) / 2e-3 for i in range(top.scale.size) for d in [1e-3 * np.eye(top.scale.size)[i].reshape(top.scale.shape)]]
    inside = ((top.scale > 0) & (top.scale < 2)).ravel()
    assert np.abs(np.array(slope))[inside].max() < 20


def test_probabilities_sum_to_one(spark):
    rows = corpus(60)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    train = [t for i, t in rows if not held(i)]
    words = sorted({x for t in train for x in tokens(t)[:-1]})
    c = Counter(x for t in train for x in tokens(t))
    for hot in (1 << 18, 20):
        model, rare = lm.fit(df, hot_words=hot)
        assert model.types == len(c) and model.tokens == sum(c.values())
        total = 0.0
        for end in (False, True):  # P(. | "bat") over all words and the end of the text
            t = lm.Tokens([b"bat" if end else f"bat {w}".encode() for w in ([""] if end else words)])
            number = model.hot.find(t.hash)
            at = np.array([1]) if end else t.ptr[:-1] + 1
            p = model.log_probability(t, number)[at]
            n = np.array([c[None] if end else 0] if end else [c[w] for w in words])
            total += (10 ** (p + np.where(number[at] < 0, np.log10(n + 1.0), 0))).sum()
        # what is left is the place of unseen words in the last class
        assert 0.9 < total < 1 + 1e-4


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    model, rare = lm.fit(df)
    assert lm.score(df, model, rare).count() == 0
    one = spark.createDataFrame([(2, None)], "doc_id long, text string")
    assert [r["n_tokens"] for r in lm.score(one, model, rare).collect()] == [1]


def test_words_before_count(spark):
    # all words end alike and are equally frequent: only the words before tell the next
    r = random.Random(3)
    v = [f"{a}{b}{c}n" for a in "bdfgklm" for b in "aeiou" for c in "rst"]
    r.shuffle(v)
    follow = dict(zip(v, v[1:] + v[:1], strict=True))

    def text(step):
        w = [r.choice(v)]
        while len(w) < 60:
            w.append(step(w[-1]))
        return " ".join(w)

    rows = [(i, text(follow.get)) for i in range(700)]
    mixed = [(10_000 + i, " ".join(r.sample(t.split(), 60))) for i, t in rows[:60]]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    other = spark.createDataFrame(mixed, "doc_id long, text string")
    model, rare = lm.fit(df)
    a = {x["doc_id"]: x["score"] for x in lm.score(df, model, rare).collect() if x["held_out"] or x["doc_id"] < 60}
    b = {x["doc_id"] - 10_000: x["score"] for x in lm.score(other, model, rare).collect()}
    unseen = [x for i, x in a.items() if held(i)]
    # the same words in another order score far lower, and unseen texts are far better than by counts alone
    assert all(a[i] > x + 10 for i, x in b.items()), (a, b)
    assert sum(unseen) / len(unseen) > -60 * math.log10(len(v)) * 0.85


def test_weights_are_trained_by_the_gradient_of_both_softmaxes(spark, monkeypatch):
    rows = corpus(60)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model, _ = lm.fit(df, hot_words=60)
    scale = np.array([[0.5, 0.25, 1.0], [1.5, 0.125, 0.75]])
    model = lm.replace(model, scale=scale)
    t = lm.Tokens([x.encode() if x else None for _, x in rows])
    number = model.hot.find(t.hash)
    texts = df.select("text").repartition(7)
    got = lm.gradient(texts, model)
    want, tokens_of = np.zeros(got.shape), np.zeros((len(got), 1))
    for k, (_, taken, prior, feature_rows) in enumerate(model.rows_of(t, number)):
        z = model.prior[prior].astype(float) + sum(s * model.weight[r] for s, r in zip(scale[k], feature_rows, strict=True))
        miss = np.eye(lm.CLASSES)[taken] - np.exp(z) / np.exp(z).sum(1, keepdims=True)
        for s, r in zip(scale[k], feature_rows, strict=True):
            np.add.at(want, r, s * miss)
            np.add.at(tokens_of, r, 1)
    assert (np.abs(got / (lm.UNIT * lm.GRAIN) - want) <= 1e-3 * tokens_of).all() and np.abs(want).max() > 5
    assert np.array_equal(got, lm.gradient(texts.repartition(2), model))  # whole numbers: in any order
    # a step goes uphill, and training takes one of every share
    seen = lm.observe(texts, model)
    gain = lambda m: m.log_probability(t, number).sum()
    assert gain(lm.replace(model, weight=lm.moved(model, got, seen))) > gain(model)
    read = []
    real = lm.gradient
    monkeypatch.setattr(lm, "gradient", lambda part, m: read.append(part.count()) or real(part, m))
    trained = lm.train(texts, lm.replace(model, weight=np.zeros_like(model.weight)))
    assert len(read) == lm.SLICES and sum(read) == len(rows)
    assert not np.array_equal(trained.weight, lm.first_weights(seen, model))
