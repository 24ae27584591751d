import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from granary.llm import toxicity
from granary.llm.queries import QUERIES


def test_grades_are_ordered_and_share_weights(spark, odd):
    g = np.random.default_rng(0)
    bad = [f"x{c}q" for c in "abcdefghijkl"]
    good = [f"{a}{b}{c}" for a in "abcdef" for b in "ghijk" for c in "lmnopqrstu"]
    rows, wanted = [], []
    for i in range(1500):
        k = int(g.choice([0, 0, 0, 1, 3, 8]))
        rows.append((i, " ".join([*g.choice(good, 30), *g.choice(bad, k, replace=False)]), None, None, None))
        wanted.append(k)
    docs = spark.createDataFrame(rows, odd.schema)
    labels = spark.createDataFrame([(i, 1, int(k > 0)) for i, k in enumerate(wanted)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, labels)
    assert (np.diff(model.thresholds) > 0).all() and len(model.thresholds) == toxicity.GRADES - 1
    index = dict(zip(model.names.tolist(), model.weights.tolist(), strict=True))
    severity = np.array([model.above(sum(index.get(m, 0) for m in toxicity.features(r[1]).tolist())).sum() for r in rows])
    means = [severity[np.array(wanted) == k].mean() for k in (0, 1, 3, 8)]
    assert means == sorted(means) and means[0] < 0.5 < means[1] and means[3] > 2
    got = {r.doc_id: r.severity for r in toxicity.scored(docs, model).collect()}
    assert all(abs(got[i] - s) < 1e-9 for i, s in enumerate(severity.tolist()))
    assert len(toxicity.train(docs, labels, keep=5).names) <= 5


def test_evidence_against_a_plain_count(spark):
    rows = [(1, [1, 2, 3]), (1, [1, 3]), (1, [1]), (0, [2, 4]), (0, [2]), (0, []), (0, [4])]
    got = {r.mark: r for r in toxicity.evidence(spark.createDataFrame(rows, "toxic int, marks array<int>"), 3, 4).collect()}
    for mark in (1, 2, 3, 4):
        yes, no = (sum(mark in m for t, m in rows if t == side) for side in (1, 0))
        share = (yes + no + 0.5) / 8
        assert got[mark].yes == yes
        assert got[mark].evidence == pytest.approx(abs(yes / 3 - no / 4) / math.sqrt(share * (1 - share) * (1 / 3 + 1 / 4)))
        assert got[mark].odds == pytest.approx(math.log((yes + 0.5) / 4) - math.log((no + 0.5) / 5))


def test_held_out_recall(spark):
    """Train without the labels of a third of the documents, and judge by those."""
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    held = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    model = toxicity.train(docs, labels.where(~held))
    got = toxicity.scored(docs, model).join(labels.where(held).select("doc_id", F.col("toxic").alias("label")), "doc_id").groupBy("label").agg(F.avg("toxic"), F.count("*")).collect()
    share = {r[0]: r[1] for r in got}
    assert share[1] >= 0.9 and share[0] <= 0.02


def test_op5(spark, sf_dir):
    got = QUERIES["op5_ordinal_toxicity"](spark, sf_dir)
    assert got.columns == ["doc_id", "grade", "severity", "p_toxic", "toxic"]
    rows = got.collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(0 <= r.severity <= toxicity.GRADES - 1 and 0 <= r.p_toxic <= 1 and r.toxic == int(r.p_toxic > 0.5) for r in rows)


def test_odd_documents(spark, odd, clashing, nothing):
    labels = spark.createDataFrame([(1, 1, 0), (4, 1, 1), (5, None, None), (None, 1, 1), (77777, 0, 1), (6, 1, 7)], "doc_id long, quality int, toxic int")
    for docs in (odd, clashing.withColumn("toxic", F.lit(1))):
        model = toxicity.train(docs, labels)
        got = toxicity.scored(docs, model, "lang").collect()
        assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in docs.collect())
    for l in (labels.limit(0), labels.where("toxic = 0")):
        model = toxicity.train(odd, l)
        assert {r.toxic for r in toxicity.scored(odd, model).collect()} == {0}
    assert toxicity.scored(nothing, model).collect() == []
