"""The prefiltered scan against one search per keyword."""
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hiresight.dictionaries import INDUSTRIES, ROLE_FAMILIES, SKILLS, flatten
from hiresight.functions import keyword_scan as ks

SETTINGS = dict(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
WORDS = ["ui", "build", "uibuild", "data", "data engineer", "engineer", "eng", "a", "ab", "abc", "c++", ".net", "r&d", "r", "q", "é", "zé", "b b"]
texts = st.lists(st.sampled_from([*WORDS, " ", "x", ".", "ab", "+", "_", "1"]), max_size=10).map("".join)


def found(spark, values, column):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, x string")
    return [r["f"] and sorted(r["f"]) or r["f"] for r in df.orderBy("i").select(column.alias("f")).collect()]


def whole(word, text):
    return re.search(("(?<!\\w)" if word[0].isalnum() else "(?<=\\w)") + re.escape(word) + ("(?!\\w)" if word[-1].isalnum() else "(?=\\w)"), text)


@settings(**SETTINGS)
@given(st.lists(texts, min_size=1, max_size=25))
def test_equals_one_search_per_keyword(spark, values):
    assert found(spark, values, ks.find_keywords(F.col("x"), WORDS)) == [sorted(w for w in WORDS if w in v) for v in values]
    assert found(spark, values, ks.find_words(F.col("x"), WORDS)) == [sorted(w for w in WORDS if whole(w, v)) for v in values]


def test_every_dictionary_word_is_found_alone_and_inside(spark):
    for words in (ROLE_FAMILIES, INDUSTRIES, SKILLS):
        words = [w.lower() for w in flatten(words)]
        values = [f"{a}{w}{b}" for w in words for a, b in (("", ""), ("xx", "yy"), ("z ", " z"))]
        assert found(spark, values, ks.find_keywords(F.col("x"), words)) == [sorted({w for w in words if w in v}) for v in values]
        assert found(spark, values, ks.find_words(F.col("x"), words)) == [sorted({w for w in words if whole(w, v)}) for v in values]


def test_odd_input(spark):
    assert found(spark, ["", None, "a"], ks.find_keywords(F.col("x"), ["a", ""])) == [[""], None, ["", "a"]]
    assert found(spark, ["a", None], ks.find_keywords(F.col("x"), [])) == [[], None]
    assert found(spark, ["a", None], ks.find_words(F.col("x"), [])) == [[], None]
    repeats = spark.createDataFrame([("a b",)], "x string").select(ks.count_found(ks.find_keywords(F.col("x"), ["a", "a", "c"]), ["a", "a", "c"]))
    assert repeats.first()[0] == 2


def test_the_text_is_scanned_once(spark):
    from hiresight.operators import enrich

    df = spark.createDataFrame([("t", "d", "c", None, None, None, None)], "title string, description string, company_name string, "
                               "company_domain string, role_family string, skills array<string>, industry_tag string")
    plan = enrich.enrich(df).where("role_family IS NOT NULL AND industry_tag = 'Retail'")._jdf.queryExecution().optimizedPlan().toString()
    # title and body for the family, title + body for skills, name, domain and head for the industry
    assert plan.count("regexp_extract_all") == 6
