import pytest

from conftest import many
from hiresight.functions import location as L

US = ["Denver, CO", "Portland, OR 97201", "Nashville, TN", "Work from home, United States", "Phoenix, AZ"]
NON_US = ["Lyon, France", "Osaka, Japan", "Madrid, Spain", "Dublin, Ireland", "Home office, Asia"]
AMBIGUOUS = ["Work from home", "Several offices", "Worldwide", "Flexible"]


def parsed(spark, values, strict=True):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, x string")
    return [r.asDict() for r in L.with_location(df, "x", strict).orderBy("i").drop("i", "x").collect()]


def test_us_locations(spark):
    for v, r in zip(US, parsed(spark, US)):
        assert r["is_us"], v
    assert [r["state"] for r in parsed(spark, US)][:3] == ["CO", "OR", "TN"]


def test_non_us_and_ambiguous_rejected_when_strict(spark):
    for r in parsed(spark, NON_US + AMBIGUOUS):
        assert not r["is_us"]


def test_lenient_accepts_ambiguous_at_low_confidence(spark):
    rows = parsed(spark, AMBIGUOUS + [""], strict=False)
    assert [r["is_us"] for r in rows] == [True] * 4 + [False]
    assert rows[0]["confidence"] == pytest.approx(0.3)


def test_remote_flag(spark):
    got = many(spark, L.is_remote("x"), ["Remote, France", "Denver, CO (Remote)", "Work from home", "Denver, CO"])
    assert got == [True, True, True, False]


def test_state_code(spark):
    got = many(spark, L.extract_state_code("x"), ["Denver, CO", "Portland, OR 97201", "Toledo, Ohio", "Lyon, France"])
    assert got == ["CO", "OR", "OH", None]


def test_quirks(spark):
    rows = parsed(spark, ["Denver, CO (Hybrid)", "Hamburg, DE", "Pune, IN, India",
                          "Wheeling, West Virginia", "Portland, OR; Denver, CO",
                          "Nevada City, NV 89001-4413", "Oregon", "Lausanne", "Remote, US",
                          "Greater Cleveland, OH 44101"])
    assert not rows[0]["is_us"]
    assert rows[1]["state"] == "DE"
    assert rows[2]["state"] == "IN"
    assert rows[3]["state"] == "VA"          # 'virginia' comes first in table order
    assert (rows[4]["state"], rows[4]["city"]) == ("CO", "Portland, OR; Denver")
    assert (rows[5]["state"], rows[5]["postal_code"]) == ("NV", "89001")      # by name: the ZIP+4 hides the code
    assert rows[6]["city"] == "Oregon"
    assert rows[7]["is_us"] and rows[7]["confidence"] == pytest.approx(0.7)   # contains 'usa'
    assert not rows[8]["is_us"]
    assert (rows[9]["city"], rows[9]["postal_code"]) == ("Cleveland", "44101")


def test_validate(spark):
    df = spark.createDataFrame([("Denver, CO",), ("Lyon, France",), ("Flexible",)], "x string")
    got = [r[0] for r in df.select(L.validate_us_location("x", True)).collect()]
    assert got == [True, False, False]
