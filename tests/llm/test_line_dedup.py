import hashlib
import random
from collections import defaultdict

import pytest

from hiresight.llm import line_dedup as ld
from hiresight.llm.queries import LLM_QUERIES

WHITE = " \t\n\x0b\x0c\r"
SCHEMA = "doc_id long, text string, pos string, body long, salt int"


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(WHITE))


def expected(rows, min_docs=10, min_chars=1, keep="none"):
    """(doc_id, kept text, lines, dropped) of each row, by a plain dictionary."""
    where = defaultdict(list)
    for d, t in rows:
        for p, line in enumerate((t or "").split("\n")):
            where[key(line)].append((d is not None, d or 0, p, t or ""))
    out = []
    for d, t in rows:
        kept = []
        all_lines = (t or "").split("\n")
        for p, line in enumerate(all_lines):
            w = where[key(line)]
            gone = len(key(line)) >= min_chars and len({x[:2] for x in w}) >= min_docs
            if keep == "first":
                gone = gone and min(w)[:3] != (d is not None, d or 0, p)
            if not gone:
                kept.append(line)
        out.append((d, "\n".join(kept), len(all_lines), len(all_lines) - len(kept)))
    return sorted(out, key=str)


def corpus(n=400, seed=1):
    r = random.Random(seed)
    pool = [f"line {i} Ünï" for i in range(60)] + ["", "  ", "x"]
    rows = []
    for i in range(n):
        lines = [r.choice(pool) if r.random() < 0.4 else f"own {i} {j}" for j in range(r.randint(0, 9))]
        if i % 3 == 0:
            lines.insert(r.randint(0, len(lines)), r.choice(["HOT line", "\t hot LINE \x0b", "hot line\r"]))
        rows.append((i, "\n".join(lines)))
    return rows + [(900, None), (901, ""), (902, "\n\n"), (None, "hot line\nhot line\nend"), (903, "hot line\n" * 3000 + "last"), (904, "\x85 hot line"), (905, "É")]


@pytest.mark.parametrize(("min_docs", "min_chars", "keep"), [(10, 1, "none"), (3, 8, "none"), (2, 1, "first")])
def test_equals_plain_dictionary(spark, min_docs, min_chars, keep):
    rows = corpus()
    df = spark.createDataFrame([(d, t, "extra", 7, 1) for d, t in rows], SCHEMA).repartition(7)
    got = ld.apply_bitmaps(df, ld.keep_bitmaps(df, min_docs, min_chars, keep))
    assert sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in got.collect()), key=str) == expected(rows, min_docs, min_chars, keep)


def test_repeated_rows_and_ids(spark):
    # nine ids hold the line, one of them in three rows: not ten documents
    rows = [(i, "a line") for i in range(9)] + [(0, "a line"), (0, "other\na line")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert ld.keep_bitmaps(df).count() == 0
    got = ld.apply_bitmaps(df, ld.keep_bitmaps(df, 9)).collect()
    assert sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in got), key=str) == expected(rows, 9)


def test_runs_are_a_bitmap(spark):
    df = spark.createDataFrame([(i, "a\nb\nmine %d\nc\n\na" % i) for i in range(12)], "doc_id long, text string")
    for r in ld.keep_bitmaps(df).collect():
        assert [(x["at"], x["len"]) for x in r["dropped"]] == [(0, 2), (3, 1), (5, 1)] and r["n_dropped"] == 4


def test_lines_move_once_and_no_python(spark):
    df = spark.createDataFrame([(i, "same line\nown %d" % i) for i in range(3000)], "doc_id long, text string").repartition(4)
    plan = ld.keep_bitmaps(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_COL") == 1 and "Python" not in plan and "Arrow" not in plan
    # the windows stand on the range partitioning itself
    below = plan.split("Window")[-1].split("REPARTITION_BY_COL")[0]
    assert below.count("Exchange") == 1 and "rangepartitioning" in below


def test_empty_table_and_wrong_arguments(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert ld.apply_bitmaps(df, ld.keep_bitmaps(df)).count() == 0
    with pytest.raises(ValueError):
        ld.keep_bitmaps(df, keep="last")
    with pytest.raises(ValueError):
        ld.keep_bitmaps(df, min_chars=0)


def test_query_digests(spark, tmp_path):
    rows = corpus(120, seed=4)
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in LLM_QUERIES["op13_line_dedup"](spark, str(tmp_path)).collect()]
    want = [(d, n, gone, hashlib.sha256(t.encode()).hexdigest()) for d, t, n, gone in expected(rows)]
    assert sorted(got, key=str) == sorted(want, key=str)
