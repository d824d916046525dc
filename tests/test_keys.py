import hashlib

from hiresight.functions import keys


def h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def test_job_key_matches_definition(spark):
    df = spark.createDataFrame([("greenhouse", " Acme Corp ", "12345", "Data Engineer ")], "s string, c string, i string, t string")
    got = df.select(keys.generate_job_key("s", "c", "i", "t")).first()[0]
    assert got == f"greenhouse_{h('acme corp')[:8]}_{h('12345|data engineer')[:8]}"


def test_job_keys_unique_and_stable(spark):
    rows = [("greenhouse", "Acme", "1", "Eng"), ("greenhouse", "Acme", "2", "Eng"), ("lever", "Acme", "1", "Eng"),
            ("greenhouse", "Acme", "1", "Eng")]
    df = spark.createDataFrame(rows, "s string, c string, i string, t string")
    ks = [r[0] for r in df.select(keys.generate_job_key("s", "c", "i", "t")).collect()]
    assert ks[0] == ks[3] and len(set(ks)) == 3


def test_company_id(spark):
    df = spark.createDataFrame([("Acme Corp", "acme.com")], "n string, d string")
    a, b = df.select(keys.generate_company_id("n"), keys.generate_company_id("n", "d")).first()
    assert a == h("acme corp")[:16]
    assert b == h("acme corp|acme.com")[:16]
