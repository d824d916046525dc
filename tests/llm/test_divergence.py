import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from hiresight.llm import divergence as dv
from hiresight.llm import text as tx
from hiresight.llm.oracles import LLM_ORACLES
from hiresight.llm.queries import LLM_QUERIES

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, gid long, term string"


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def expected(rows, least=10, top=10):
    docs, count, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, t, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        w = TERM.findall(lower(t or ""))
        groups.add((lang, source))
        docs[lang].update(set(w))
        count[lang, source].update(w)
    kept = {lang: sorted(t for t, n in c.items() if n >= least) for lang, c in docs.items()}
    out = []

    def share(c, total, terms):
        return 1 + 10**9 * (c + 2) // (total + 2 * terms)

    def f(p, q):
        return (p - q) ** 2 // (p + q)

    for lang, source in groups:
        terms = kept.get(lang, [])
        total = {g: sum(count[g][t] for t in terms) for g in groups if g[0] == lang}

        def p(g, t):
            return share(count[g][t], total[g], len(terms))

        own = (lang, source)
        pairs = [(-sum(f(p(own, t), p(g, t)) for t in terms), g[1].encode()) for g in total if g != own]
        marks = []
        for t in terms:
            q = share(sum(count[g][t] for g in total), sum(total.values()), len(terms))
            if count[own][t] and p(own, t) > q:
                marks.append((-f(p(own, t), q), t.encode()))
        for part, items in (("pair", sorted(pairs)), ("term", sorted(marks)[:top])):
            out += [(lang, source, part, x.decode(), -v, k) for k, (v, x) in enumerate(items, 1)]
    return sorted(out)


def corpus(n=500, seed=3):
    r = random.Random(seed)
    words = [a + b + c for a in ("ba", "Ko", "é", "日本") for b in ("r", "s", "ß") for c in ("o", "AX", "i")]
    rows = []
    for i in range(n):
        lang = r.choice(["en", "en", "de", None])
        s = r.randint(0, 5)
        own = words[s * 3 : s * 3 + 9] + words[:6]
        rows.append((i, r.choice([" ", "-", "7", "\n"]).join(r.choices(own, k=r.randint(0, 25))), lang, None if s == 5 else f"s{s}", 1, "x"))
    rows += [(900 + i, "few words here", "fr", f"f{i % 3}", 2, "y") for i in range(9)]  # nothing kept
    rows += [(950, None, "en", "silent", 3, "z"), (951, "", "it", "alone", 3, "z"), (952, "ba" * 5000 + " " + "baro " * 4000, "en", "s0", 1, "x"), (0, rows[0][1], rows[0][2], rows[0][3], 1, "x")]
    return rows


def test_perfect_hash_is_minimal_and_verifies():
    r = np.random.default_rng(5)
    for n in (0, 1, 2, 50, 70_000):
        keys = np.unique(r.integers(1, 1 << 63, n, dtype=np.uint64))
        h = dv.PerfectHash.build(keys)
        assert sorted(h.slots(keys).tolist()) == list(range(len(keys)))
        assert len(h.bits) * 8 <= 5 * len(keys) + 200
    stored = [f"word{i}".encode() for i in range(3000)]
    w = tx.Words(tx.Buffer([b" ".join(stored)]), tx.SPACE)
    h = dv.PerfectHash.build(w.hash)
    order = np.argsort(h.slots(w.hash))
    kept = [stored[i] for i in order]
    shard = dv.Shard(100, h, np.frombuffer(b"".join(kept), np.uint8), np.r_[0, np.cumsum([len(x) for x in kept])])
    probe = tx.Buffer([b" ".join([*stored, *(f"other{i}".encode() for i in range(3000))])])
    v = tx.Words(probe, tx.SPACE)
    got = shard.find(v.hash, probe.bytes, v.start, v.end)
    assert (got[3000:] == -1).all() and [kept[i - 100] for i in got[:3000]] == stored
    # a key that lands on another term's slot is refused by the stored bytes
    wrong = shard.find(np.roll(w.hash, 1), probe.bytes, v.start[:3000], v.end[:3000])
    assert (wrong == -1).all()
    with pytest.raises(ValueError):
        dv.PerfectHash.build(np.array([3, 3], np.uint64))


def test_shares_are_exact():
    r = random.Random(1)
    for _ in range(2000):
        total = r.randint(1, r.choice([10, 10**6, 8 * 10**15]))
        n = r.randint(0, total)
        assert dv.shares(np.array([n]), np.array([total]))[0] == 1 + 10**9 * n // total


@pytest.mark.parametrize(("shard_terms", "round_bytes", "cells"), [(1 << 16, 64 << 20, 1 << 23), (4, 60, 10)])
def test_equals_plain_counting(spark, monkeypatch, shard_terms, round_bytes, cells):
    monkeypatch.setattr(dv, "SHARD_TERMS", shard_terms)
    monkeypatch.setattr(dv, "MOST_CELLS", cells)
    monkeypatch.setattr(dv, "BLOCK", 8)
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = sorted(tuple(x) for x in dv.audit(df, round_bytes=round_bytes).collect())
    assert got == expected(rows)
    assert {"fr", "it", ""} <= {x[0] for x in got} | {"it"} and any(x[4] == 0 for x in got if x[0] == "fr")


def test_other_limits_and_empty_table(spark):
    rows = corpus(200, seed=8)
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(tuple(x) for x in dv.audit(df, min_docs=3, top=4).collect()) == expected(rows, 3, 4)
    assert dv.audit(df.limit(0)).count() == 0
    assert dv.audit(spark.createDataFrame([(1, None, None, None)], "doc_id long, text string, lang string, source string")).count() == 0


def test_query_equals_its_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    sf = "/root/testdata/sf0.001"
    got = sorted(tuple(x) for x in LLM_QUERIES["op11_divergence"](spark, sf).collect())
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    assert got == sorted(c.execute(LLM_ORACLES["op11_divergence"]).fetchall()) and got
