import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from granary.llm import secrets, toxicity


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        out.append((name, docs.cache()))
    return dict(out)


def ids(df):
    return Counter(r.doc_id for r in df.select("doc_id").collect())


def test_order_and_columns(stages):
    names = ["toxicity", "near_duplicates", "secrets", "mixing", "packing"]
    assert [n for n, _ in corpus_pipeline.STAGES] == names
    assert all(stages[n].columns == stages["documents"].columns for n in names[:-1])


def test_each_stage_decides(spark, sf_dir, stages):
    before, after = ids(stages["documents"]), ids(stages["toxicity"])
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert not after - before
    gone = before - after
    assert all(labels.get(d) != 0 for d in gone)
    assert sum(labels.get(d) == 1 for d in gone) >= 0.6 * sum(x == 1 for x in labels.values())
    texts = [r.text for r in stages["near_duplicates"].collect()]
    assert len(texts) == len(set(texts)) and set(texts) == {r.text for r in stages["near_duplicates"].collect()}
    assert ids(stages["secrets"]) == ids(stages["near_duplicates"])
    assert set(ids(stages["mixing"])) == set(ids(stages["secrets"]))
    assert set(ids(stages["packing"])) == set(ids(stages["mixing"]))


def test_run(spark, sf_dir, stages):
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).drop("sequence_id", "offset").collect())) == sorted(map(tuple, stages["packing"].drop("sequence_id", "offset").collect()))


def test_masked(spark, odd, clashing, nothing):
    rows = ["a password=abcdef012345678901234567 b", "token = 0123456789abcdef0123456789 é", "é𝔘 AKIA" + "A" * 20 + " secret:abcdef end", "nothing", None, "secret=abcdef"]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(rows)], odd.schema)
    got = {r.doc_id: r.text for r in secrets.masked(docs).collect()}
    assert got == {0: "a [SECRET] b", 1: "[SECRET] é", 2: "é𝔘 [SECRET] [SECRET] end", 3: "nothing", 4: None, 5: "[SECRET]"}
    assert secrets.masked(nothing).collect() == []
    same = secrets.masked(clashing)
    assert same.columns == clashing.columns and sorted(map(repr, same.collect())) == sorted(map(repr, clashing.collect()))


def test_accepted(spark, odd, clashing, nothing):
    labels = spark.createDataFrame([(4, 1, 0), (8, 1, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.accepted(clashing, labels)
    assert got.columns == clashing.columns and {r.doc_id for r in got.collect()} <= {r.doc_id for r in odd.collect()}
    assert toxicity.accepted(nothing, labels).collect() == []
