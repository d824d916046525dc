import random
import re

from hiresight.llm import decontaminate as dc

W = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return W.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(text, items):
    w = words(text)
    hit, found = set(), set()
    for name, t in items:
        v = words(t)
        windows = {tuple(v[i:i + 13]) for i in range(len(v) - 12)} if len(v) >= 13 else {tuple(v)} if v else set()
        for x in windows:
            for i in range(len(w) - len(x) + 1):
                if tuple(w[i:i + len(x)]) == x:
                    hit.update(range(i, i + len(x)))
                    found.add(str(name))
    return len(w), len(hit), len(found), dc.items_hash(found), bool(hit) and 20 * len(hit) >= len(w)


def cases():
    r = random.Random(5)
    voc = ["the", "of", "Zé", "x1", "b", "ñu"]
    items = [(i, " ".join(r.choices(voc, k=r.choice([2, 3, 5, 12, 13, 14, 20, 40])))) for i in range(12)]
    items += [(90, None), (91, " ,. "), (92, items[6][1]), (93, items[7][1] + " the of")]
    docs = [None, "", "...", "the of", "the"]
    for _ in range(40):
        parts = r.choices(voc, k=r.randint(0, 200))
        for _ in range(r.randint(0, 3)):
            t = words(r.choice(items)[1])
            a = r.randint(0, max(0, len(t) - 1))
            k = r.randint(0, len(parts))
            parts[k:k] = t[a:] if r.random() < .5 else t
        docs.append(r.choice([" ", ", ", "\n"]).join(parts).upper() if r.random() < .3 else " ".join(parts))
    return items, docs + [docs[-1]] * 2


def check(spark, items, docs, **kw):
    d = spark.createDataFrame([(i, t, "n") for i, t in enumerate(docs)], "doc_id long, text string, n_words string")
    b = spark.createDataFrame(items, "item_id long, text string")
    return {r["doc_id"]: tuple(r)[1:6] for r in dc.contamination(d, b).collect()}


def test_matches_brute_force(spark, monkeypatch):
    items, docs = cases()
    want = {i: brute(t, items) for i, t in enumerate(docs)}
    assert check(spark, items, docs) == want
    long = [(n, t) for n, t in items if len(words(t)) != 1 and len(words(t)) >= 13]
    assert check(spark, long, docs) == {i: brute(t, long) for i, t in enumerate(docs)}
    one = [*items, (94, "b")]
    assert check(spark, one, docs) == {i: brute(t, one) for i, t in enumerate(docs)}


def test_blocks_give_the_same(spark):
    items, docs = cases()
    d = spark.createDataFrame([(i, t) for i, t in enumerate(docs)], "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    found = dc.find_spans(d, b, block_words=60).select("doc_id", "__n_words", dc._n_hit(dc.F.col("__spans")).alias("n"), "__items")
    for r in found.collect():
        want = brute(docs[r["doc_id"]], items)
        assert (r["__n_words"], r["n"], len(r["__items"]), dc.items_hash(r["__items"])) == want[:4]


def test_drop_and_cut(spark):
    item = " ".join(f"q{i}" for i in range(20))
    filler = " ".join(f"f{i}" for i in range(1000))
    rows = [(1, filler, 5, "a"), (2, item, 6, None), (3, f"Start, {item}; end. {filler}", 7, "c"), (4, None, 8, "d")]
    d = spark.createDataFrame(rows, "doc_id long, text string, n_hit int, items string")
    b = spark.createDataFrame([(1, item)], "item_id long, text string")
    kept = dc.drop_contaminated(d, b)
    assert kept.columns == d.columns
    assert {r["doc_id"] for r in kept.collect()} == {1, 3, 4}
    cut = {r["doc_id"]: r["text"] for r in dc.cut_spans(d, b).collect()}
    assert cut[1] == filler and cut[4] is None and cut[2].strip() == ""
    assert cut[3] == f"Start,  ; end. {filler}".replace("  ;", "  ;")
    empty = spark.createDataFrame([], "item_id long, text string")
    assert dc.drop_contaminated(d, empty).count() == 4 and dc.contamination(d.limit(0), b).count() == 0
