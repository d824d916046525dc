"""Stages keep every column of their input, whatever its name."""
import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from hiresight.llm import decontaminate, jaccard_join, mixing, sharding, toxicity

NAMES = ["__spans", "__items", "__n_words", "__n_hit", "__id", "__key", "__hash", "__same", "__row", "__q", "__copy", "__won", "q", "copy", "tokens",
         "won", "c0", "c1", "a.b", "lang", "Source"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, f"word{i} is one of some {i * 7} others that stand in text number {i} here", *(f"{n}-{i}" for n in NAMES)) for i in range(40)]
    rows += [(100, "copied words stand here in two documents of one group now", *NAMES), (101, "copied words stand here in two documents of one group now", *NAMES),
             (102, None, *NAMES), (103, "", *NAMES), (None, "no id at all but words enough to be kept by all", *NAMES)]
    df = spark.createDataFrame(rows).toDF("doc_id", "text", *NAMES)
    return df.select(F.col("`a.b`").alias("first"), "doc_id", *(f"`{n}`" for n in NAMES), "text").repartition(3)


def same_values(out, docs):
    assert out.columns[: len(docs.columns)] == docs.columns
    before = {tuple(r) for r in docs.collect()}
    got = [tuple(r)[: len(docs.columns)] for r in out.collect()]
    assert got and set(got) <= before
    return got


def labels(spark, docs):
    return spark.createDataFrame([(i, i % 2, int(i % 5 == 0)) for i in range(40)], "doc_id long, quality int, toxic int")


def test_toxicity(spark, docs):
    same_values(toxicity.drop_toxic(docs, toxicity.fit(docs, labels(spark, docs))), docs)


def test_near_duplicates(spark, docs):
    got = same_values(jaccard_join.keep_one(docs), docs)
    assert len(got) == docs.count() - 1


def test_decontamination(spark, docs):
    bench = spark.createDataFrame([("b", "word3 is one of some 21 others that stand in text number 3 here")], "item_id string, text string")
    got = same_values(decontaminate.drop_contaminated(docs, bench), docs)
    assert len(got) == docs.count() - 1
    cut = decontaminate.cut_spans(docs, bench)
    assert cut.columns == docs.columns and cut.count() == docs.count()
    with pytest.raises(ValueError, match="in use"):
        decontaminate.find_spans(docs, bench)


def test_mixing_and_sharding(spark, docs):
    mixed = mixing.mix(docs, mixing.label_domains(labels(spark, docs)), {"good": 0.9, "poor": 0.1}, low=1.0)
    assert set(same_values(mixed, docs)) == {tuple(r) for r in docs.collect()}
    placed = sharding.place(docs, sharding.Tree.even(4))
    same_values(placed, docs)
    assert placed.columns[-2:] == ["shard", "size"]
    kinds = dict(sharding.place(docs.withColumn("Shard", F.lit("x")).withColumn("size", F.lit("y")), sharding.Tree.even(4)).dtypes)
    assert kinds["shard"] == "int" and kinds["size"] == "bigint" and "Shard" not in kinds


def test_names_that_differ_in_case(spark, docs):
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        both = docs.select("doc_id", "text", F.upper("text").alias("Text"))
        same_values(sharding.place(both, sharding.Tree.even(4)), both)
        same_values(jaccard_join.keep_one(both), both)
        same_values(toxicity.drop_toxic(both, toxicity.fit(both, labels(spark, both))), both)
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_an_unreachable_target_shows(spark):
    docs = spark.createDataFrame([(i, "good words " * 30) for i in range(30)], "doc_id long, text string")
    domains = spark.createDataFrame([(i, "a") for i in range(20)] + [(25, "b")], "doc_id long, domain string")
    out = mixing.rate_documents(docs, domains, {"a": 0.5, "b": 0.5}).first()
    assert abs(out["share_a"] + out["share_b"] - 1) < 1e-9 and out["share_b"] < 0.4


def test_stages_return_the_columns_of_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("a.b", F.lit(1))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns and out.count() > 0
