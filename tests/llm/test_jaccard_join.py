import random
from collections import defaultdict

import numpy as np

from hiresight.llm import graph
from hiresight.llm import jaccard_join as jj
from hiresight.llm.graph import components


def shingles(t):
    w = [x for x in (t or "").lower().replace("\n", " ").split(" ") if x]
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(texts):
    sets = [shingles(t) for t in texts]
    links, parent = [0] * len(texts), list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 10 * len(a & b) >= 8 * len(a | b):
                links[i] += 1
                links[j] += 1
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return [root(i) for i in range(len(texts))], links


def corpus(seed=4):
    r = random.Random(seed)
    voc = [f"w{i}" for i in range(900)]
    out = []
    for _ in range(25):
        base = r.choices(voc, k=r.randint(6, 300))
        for _ in range(r.choice([1, 1, 2, 8])):
            w = list(base)
            for _ in range(r.randint(0, 8)):
                w[r.randrange(len(w))] = r.choice(voc)
            out.append(" ".join(w))
    out += [out[0]] * 5 + [out[3].upper()] + [None, "", " \n ", "a", "a", "A b", "a b", "one two three four five"]
    out += ["x " * 3000, "x " * 3001, " ".join(r.choices(voc, k=40_000))]
    hot = r.choices(voc, k=120)
    for _ in range(150):  # one large group of near copies
        w = list(hot)
        for _ in range(r.randint(0, 5)):
            w[r.randrange(len(w))] = r.choice(voc)
        out.append(" ".join(w))
    r.shuffle(out)
    return out


def run(spark, texts):
    df = spark.createDataFrame([(i, t, "c", 1) for i, t in enumerate(texts)], "doc_id long, text string, cid string, n int")
    out = {r["doc_id"]: r for r in jj.jaccard_join(df).collect()}
    return [out[i]["class_id"] for i in range(len(texts))], [out[i]["n_links"] for i in range(len(texts))]


def test_join_matches_brute_force(spark, monkeypatch):
    texts = corpus()
    want = brute(texts)
    assert run(spark, texts) == want
    monkeypatch.setattr(jj, "BLOCK_MEMBERS", 20)  # the same with many blocks
    assert run(spark, texts) == want


def test_common_and_depth():
    r = np.random.default_rng(0)
    sets = [np.unique(r.integers(0, 9000, n, dtype=np.uint64)) for n in (5, 900, 7000, 1, 7000)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    got = jj.common(sets)
    for i in range(5):
        for j in range(5):
            assert i == j or got[i, j] == want[i][j]
    assert jj.target_depth(40, 10, 0.8, 0.9995) == 7 and jj.target_depth(2, 6, 0.8, 0.999999) == 1


def test_keep_one_and_edge_cases(spark):
    a, b = " ".join(f"a{i}" for i in range(50)), " ".join(f"b{i}" for i in range(50))
    rows = [(5, a, 1), (5, a, 1), (5, b, 2), (3, b, 3), (None, a, 4), (7, None, 5), (8, "", 6), (8, "", 6), (None, "solo text", 7), (9, a + " z", 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, __same int")
    df = df.withColumnRenamed("__same", "group")
    kept = jj.keep_one(df)
    assert kept.columns == df.columns
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    assert got == sorted([(5, a), (3, b), (7, None), (8, ""), (8, ""), (None, "solo text")], key=str)
    assert jj.keep_one(df.limit(0)).count() == 0 and jj.jaccard_join(df.limit(0)).count() == 0
    links = defaultdict(list)
    for r in jj.jaccard_join(df).collect():
        links[r["doc_id"]].append((r["class_id"], r["n_links"]))
    assert sorted(links[5]) == [(3, 1), (5, 3), (5, 3)] and links[3] == [(3, 1)] and links[9] == [(5, 3)]


def test_components(spark):
    r = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(200, 200), (201, 202)]
    r.shuffle(edges)
    df = spark.createDataFrame(edges, "u long, v long")
    got = {x["node"]: x["component"] for x in components(df).collect()}
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {201: 201, 202: 201}
    assert got == want
    assert components(df.limit(0)).count() == 0


def test_components_take_few_shuffles_and_rounds(spark, monkeypatch):
    done = []
    real = graph.checkpointed
    monkeypatch.setattr(graph, "checkpointed", lambda df: done.append(1) or real(df))
    stars = spark.createDataFrame([(i, i % 3) for i in range(3, 90)], "u long, v long")
    assert {x["node"]: x["component"] for x in components(stars).collect()} == {i: i % 3 for i in range(90)}
    assert len(done) == 1  # stars are settled: no round at all
    done.clear()
    path = spark.createDataFrame([(i, i + 1) for i in range(64)], "u long, v long")
    assert {x["component"] for x in components(path).collect()} == {0}
    assert len(done) <= 7
    one = graph._small_star(graph._large_star(real(path.toDF("v", "u"))))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 9, plan
