import pytest
from pyspark.sql import functions as F

from hiresight.operators import enrich as E


def roles(spark, pairs):
    df = spark.createDataFrame([(i, t, d) for i, (t, d) in enumerate(pairs)], "i long, title string, description string")
    return [r["role_family"] for r in E.with_role_family(df).orderBy("i").collect()]


def test_role_family(spark):
    got = roles(spark, [("Software Developer", "Write services"), ("Data Analyst", "Answer questions"),
                        ("Product Designer", "Draw screens"), ("Sales Representative", "Call shops")])
    assert got == ["Tech/Engineering", "Data/AI", "Product/Design", "Sales"]


def test_role_family_ties_go_to_first_family(spark):
    # 'engineer' (Tech) and 'analytics' (Data) both hit the title: 10-10.
    assert roles(spark, [("Analytics Engineer", ""), ("Machine Learning Engineer", "")]) == ["Tech/Engineering"] * 2


def test_role_family_substring_semantics(spark):
    # 'ui' inside 'build' scores for Product/Design.
    assert roles(spark, [("Somebody", "we build things")]) == ["Product/Design"]


def industries(spark, rows):
    df = spark.createDataFrame([(i, n, d) for i, (n, d) in enumerate(rows)], "i long, company_name string, description string")
    return [(r["industry"]["industry_tag"], r["industry"]["confidence"]) for r in E.with_industry(df).orderBy("i").collect()]


def test_industry(spark):
    got = industries(spark, [("Lumen Software", "cloud, saas"),
                             ("Northside Health", "patient, medical"),
                             ("Oak and Sons", "we do odd jobs")])
    # software in the name (5) + cloud, saas (2) = 7
    assert got[0][0] == "Technology" and got[0][1] == pytest.approx(0.7)
    # health in the name (5) + patient, medical (2) = 7
    assert got[1][0] == "Healthcare" and got[1][1] == pytest.approx(0.7)
    assert got[2] == (None, 0.0)


def skills(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    return [r["skills"] for r in E.with_skills(df, F.col("t")).orderBy("i").collect()]


SKILL_TEXT = """<ul><li>Our batch jobs: Spark, Airflow; some SQL.</li>
<li>Services run in Docker (on Kubernetes), written in Python or Go.</li></ul>"""


def test_skills_extraction(spark):
    got = skills(spark, [SKILL_TEXT])[0]
    for s in ["Python", "SQL", "Airflow", "Spark", "Kubernetes", "Docker", "Go"]:
        assert s in got
    assert got == sorted(got)


def test_skills_word_boundary_quirks(spark):
    got = skills(spark, ["C++ and Java.", "R&D team", "go to market", "JavaScript only", ".NET shop", "x.NET shop",
                         "PYTHON <b>sql</b>", "Node.js and CI/CD", "", "Hugging\n\nFace"])
    assert got[0] == ["Java"]                 # '\bC\+\+\b' needs a word char after '++'
    assert got[1] == ["R"]
    assert got[2] == ["Go"]
    assert got[3] == ["JavaScript"]
    assert got[4] == []                       # '\b\.NET' needs a word char before '.'
    assert got[5] == [".NET"]
    assert got[6] == ["Python", "SQL"]
    assert got[7] == ["CI/CD", "Node.js"]
    assert got[8] == []
    assert got[9] == ["Hugging Face"]


def test_enrich_keeps_existing_values(spark):
    df = spark.createDataFrame(
        [("Data Scientist", "Python", "Acme Software", None, "Preset", ["X"], "Retail")],
        "title string, description string, company_name string, company_domain string, role_family string, skills array<string>, industry_tag string")
    r = E.enrich(df).first()
    assert (r["role_family"], r["skills"], r["industry_tag"]) == ("Preset", ["X"], "Retail")


def test_guarded_operators_fill_one_column(spark):
    schema = "title string, description string, company_name string, company_domain string, role_family string, skills array<string>, industry_tag string"
    row = ("Data Analyst", "SQL <b>and</b> cloud", "Lumen Software", None, None, None, "")
    df = spark.createDataFrame([row], schema)
    full = E.enrich(df).first()
    assert full["role_family"] == "Data/AI" and full["skills"] == ["SQL"] and full["industry_tag"] == "Technology"
    for fn, column in ((E.enrich_role_family, "role_family"), (E.enrich_skills, "skills"), (E.enrich_industry, "industry_tag")):
        r = fn(df).first()
        assert r[column] == full[column]
        assert all(r[c] == row[i] for i, c in enumerate(df.columns) if c != column)
    assert E.enrich_industry(df.withColumn("company_name", F.lit("Oak")), description_chars=5).first()["industry_tag"] in (None, "")


def test_cleaned_descriptions_give_the_same(spark):
    from hiresight.functions.text import clean_text
    schema = "title string, description string, company_name string, company_domain string, role_family string, skills array<string>, industry_tag string"
    rows = [(t, d, "Oak", None, None, None, None) for t in ("Data <i>Analyst", None, " Go  dev") for d in ("R <b>and</b> SQL > x", None, "", "Python\n\nJava")]
    df = spark.createDataFrame(rows, schema).withColumn("description", clean_text("description"))
    assert E.enrich(df, cleaned=True).collect() == E.enrich(df).collect()
