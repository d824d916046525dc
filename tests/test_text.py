from conftest import many, one
from hiresight.functions import text


def test_clean_text_removes_tags_and_collapses_whitespace(spark):
    got = many(spark, text.clean_text("x"), ["<p>Hello</p>\n\n  <b>World</b> ", None, "", "a  b\x1dc"])
    assert got == ["Hello World", "", "", "a b c"]


def test_clean_text_lowercase_keeps_entities(spark):
    assert one(spark, text.clean_text("x", lowercase=True), "<div>R&amp;D <i>Team</i></div>") == "r&amp;d team"


def test_normalize_whitespace(spark):
    assert many(spark, text.normalize_whitespace("x"), ["  a \t b\n", None]) == ["a b", ""]


def test_extract_keywords(spark):
    got = one(spark, text.extract_keywords("x", 3), "<b>Data-driven</b> teams, -x- co-op and ML; naïve!")
    assert got == ["data-driven", "teams", "co-op", "and", "naïve"]


def test_extract_state_abbrev(spark):
    assert many(spark, text.extract_state_abbrev("x"), ["we go to ca now", "UK and XX", "in Boston"]) == ["CA", None, "IN"]


def test_clean_text_survives_pathological_runs(spark):
    # Long runs of tags / whitespace / unclosed brackets must not blow the
    # regex engine's stack (a single repeated alternation group would).
    vals = ["x" + "<b>" * 100000 + "y", "x" + " \n\t" * 200000 + "y", "<" * 10000 + "a"]
    got = many(spark, text.clean_text("x"), vals)
    assert got[:2] == ["x y", "x y"] and len(got[2]) == 10001
