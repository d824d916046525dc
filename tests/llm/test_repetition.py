import re
from collections import Counter

import pytest

from hiresight.llm import repetition as rp

W = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = W.findall(text)
    lines = [x for x in text.split("\n") if W.search(x)]
    out = {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
           "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)),
           "dup_line_chars": sum(map(len, lines)) - sum(map(len, set(lines)))}
    for n in range(2, 11):
        grams = [tuple(w[i:i + n]) for i in range(len(w) - n + 1)]
        c = Counter(grams)
        inside = {i + k for i, g in enumerate(grams) if c[g] > 1 for k in range(n)}
        if n == 3:
            out["n_repeat_words"] = len(inside)
        if n < 5:
            out[f"top{n}_chars"] = min(out["word_chars"], max([v * sum(map(len, g)) for g, v in c.items() if v > 2], default=0))
        else:
            out[f"dup{n}_chars"] = sum(len(w[i]) for i in inside)
    return out


CASES = [None, "", " \n\t", "one", "a a a a a a", "a b c d\na b c d\n\n \na b c d", "é ü é ü é ü #x $5 <b>", "x\r\nx\r\ny\x0b z",
         " ".join(f"w{i % 37}" for i in range(400)), " ".join(f"u{i}" for i in range(120)), "long" * 70000 + " end", "\x00 a\x85b a\x85b"]


def test_measure_matches_brute_force():
    got = rp.measure([t.encode() if t is not None else None for t in CASES])
    for i, t in enumerate(CASES):
        assert {k: int(v[i]) for k, v in got.items()} == brute(t), t


def test_operator_rows_and_verdicts(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate(CASES)] + [(None, "one", "y", 2), (3, "one", "y", 2), (3, "one", "y", 2)]
    df = rp.repetition_rules(spark.createDataFrame(rows, "doc_id long, text string, kept string, n_words int"))
    out = df.collect()
    assert df.columns[:8] == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert len(out) == len(rows)
    by = {r["doc_id"]: r for r in out}
    assert by[9]["kept"] and not by[9]["base_failed"]      # 120 different words
    assert by[8]["base_failed"] and not by[8]["kept"]      # a cycle of 37 words
    assert all(by[i]["base_failed"] and not by[i]["kept"] for i in range(8))
    assert rp.repetition_rules(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("text,kept", [
    (" ".join(f"a{i}" for i in range(60)) + "\nsame line here\nother b\nsame line here\nother c", True),
    (" ".join(f"a{i}" for i in range(60)) + "\nx" * 40, False),
    (" ".join(f"a{i}" for i in range(60)) + " #" * 30, False),
])
def test_verdicts(text, kept):
    m = rp.measure([text.encode()])
    assert bool(rp.verdict(m, rp.Limits())[1][0]) is kept
