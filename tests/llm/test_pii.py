import hashlib
import random
import re

import numpy as np

from hiresight.llm import pii


def brute(text):
    text = text or ""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()]
        if 12 <= len(d) <= 19 and sum(x if k % 2 == 0 else sum(divmod(2 * x, 10)) for k, x in enumerate(d[::-1])) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def test_base_rules_match_the_patterns():
    r = random.Random(9)
    parts = ["a@b.co", "x.y+z%1@m-2.example.com", "@", "a@", "@b.c", "é@x.de", "10.0.0.1", "1.2.3.4.5.6.7.8", "256.1.1.1", "001.2.3.04", "1.2.3", "0000000255.1.1.1",
             "4111111111111111", "4111 1111-1111 1111", "4111111111111112", "+1 (555) 123-4567", "+1 (((((", "+49.30.123456", "+", "+123", "-", ".", " ", "  ", "\n", "w", "12", "7 ", "é", "٣", "a.b@c.d@e.f", "@@"]
    for _ in range(3000):
        t = "".join(r.choice(parts) + r.choice(["", "", " ", ","]) for _ in range(r.randint(0, 9)))
        assert pii.base_spans(t) == brute(t), t
    for t in ("1" * 200_000, "a" * 200_000, "@" * 100_000, "+1" + "(" * 100_000, "1." * 100_000, "a@" * 50_000):
        pii.base_spans(t)  # linear time


def test_dynamic_program_and_gradient():
    r = np.random.default_rng(0)
    run = pii.Run(["12", "+1", "(555)", "123-4567", "x9"], [0, 3, 6, 12, 21], "tel", "end")
    spans = pii.spans_of(run)
    m = pii.Crf(r.normal(size=(pii.FEATURES, 6)), r.normal(size=(6, 6)))
    s = m.scores(spans)

    def every(i, before):
        if i == 5:
            yield 0.0, []
            return
        for length in range(len(s[i])):
            for y in range(6):
                if y == 0 and length:
                    continue
                for v, rest in every(i + length + 1, y):
                    yield v + m.follow[before, y] + s[i][length, y], [(i, i + length + 1, y)] + rest

    value, want = max(every(0, 0), key=lambda x: x[0])
    assert m.best(spans) == [x for x in want if x[2]]
    gold = [(1, 4, 4)]
    m = pii.Crf.empty()
    m.learn([(spans, gold)] * 5, epochs=10)
    assert m.best(spans) == gold


def corpus(spark):
    r = random.Random(4)
    hexa = "0123456789abcdef"

    def value(kind):
        if kind == "email":
            return f"w{r.randint(1, 99)}@mail{r.randint(1, 9)}.example.com"
        if kind == "ip":
            return ".".join(str(r.randint(0, 255)) for _ in range(4))
        if kind == "phone":
            return f"+1 ({r.randint(200, 999)}) {r.randint(100, 999)}-{r.randint(1000, 9999)}"
        if kind == "secret":
            return 'api_key = "' + "".join(r.choices(hexa, k=32)) + '"'
        if kind == "number":
            return r.choice(["3.", "2019", "4.0", "v2", "12,000", "i9"])
        return ["4111111111111111", "5500000000000004"][r.randint(0, 1)]

    rows = []
    for i in range(500):
        w = [f"é{r.choice('abc')}w" for _ in range(r.randint(3, 40))]
        for _ in range(r.choice([0, 1, 1, 2])):
            w.insert(r.randint(0, len(w)), value(r.choice(["email", "ip", "phone", "secret", "card", "number"])))
        rows.append((i, " ".join(w), "x"))
    rows += [(900, None, "x"), (901, "", "x"), (None, "call (555) 123-4567 now", "x"), (902, "host 10.1.2.3:9090 up", "x"), (3, rows[3][1], "x"),
             (903, "é" * 300_000 + " a@b.co", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, spans string"), rows


def test_operator(spark):
    df, rows = corpus(spark)
    model = pii.fit(df, sample=400)
    out = pii.find(df, model).collect()
    assert len(out) == len(rows)
    text = {i: t for i, t, _ in rows}
    added = {}
    for r in out:
        base = brute(text[r["doc_id"]])
        joined = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.BASE_KINDS] == [sum(x[1] == k for x in base) for k in range(4)]
        spans = [x.split(":") for x in r["spans"].split(",") if x]
        assert {f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base} <= {":".join(x) for x in spans}
        assert len(spans) == len(base) + r["n_added"]
        assert [int(x[1]) for x in spans] == sorted(int(x[1]) for x in spans)
        added[r["doc_id"]] = [(k, text[r["doc_id"]][int(a):int(b)]) for k, a, b in spans if k == "secret" or r["doc_id"] in (None, 902)]
    secrets = sum(t.count("api_key") for _, t, _ in rows if t)
    found = [v for own in added.values() for k, v in own if k == "secret"]
    assert len(found) >= 0.95 * secrets and all(len(v) == 32 for v in found)
    assert added[None] == [("phone", "(555) 123-4567")]
    clean = [r for r in out if r["spans"] == ""]
    assert all(not brute(text[r["doc_id"]]) for r in clean)
    plain = [r for r in out if r["n_added"] and "api_key" not in (text[r["doc_id"]] or "") and r["doc_id"] is not None and r["doc_id"] < 900]
    assert len(plain) <= 5  # numbers and versions are left alone
    assert pii.find(df.limit(0), pii.fit(df.limit(0))).count() == 0


def test_features_read_whole_spans():
    long = "a1" * 500
    for one, other in ((long, long[:300] + "#" + long[301:]), ("1" * 300 + "abcdef", "1" * 306), ("1." + "0" * 100 + ".1.1", "1." + "0" * 100 + ".1.1.1")):
        assert pii.span_features([one], 0, 1, "", "") != pii.span_features([other], 0, 1, "", "")
