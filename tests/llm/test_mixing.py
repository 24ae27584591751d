import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from granary.llm import mixing
from granary.llm.queries import QUERIES

TOKENS = [9000.0, 500.0, 300.0, 200.0, 0.0]


def test_exponent_meets_entropy():
    a = mixing.exponent(TOKENS, 0.8, 1e9)
    assert mixing.entropy(mixing.weights(TOKENS, a)) == pytest.approx(0.8 * math.log(4), abs=1e-9)
    assert mixing.exponent([5.0, 5.0, 5.0]) == 1 and mixing.exponent([7.0, 0.0]) == 1


def test_exponent_keeps_to_repeats():
    a = mixing.exponent(TOKENS, 0.99, 3.0)
    w = mixing.weights(TOKENS, a)
    b = mixing.whole_budget(TOKENS, w)
    assert max(x * b / t for x, t in zip(w, TOKENS, strict=True) if t) == pytest.approx(3.0, abs=1e-6)
    assert min(x * b / t for x, t in zip(w, TOKENS, strict=True) if t) == pytest.approx(1.0)


def check(rows, docs, repeats=mixing.REPEATS):
    """Whole epochs, no overlap, no gap, and budgets that are met."""
    sizes = {}
    for r in docs:
        sizes.setdefault(r.source, []).append((r.doc_id, len((r.text or "").split())))
    streams, used = defaultdict(list), defaultdict(Counter)
    for r in rows:
        streams[r.source].append((r.start, r.n_tokens))
        used[r.source, r.epoch][r.doc_id] += 1
    total = {s: sum(n for _, n in x) for s, x in sizes.items()}
    for source, places in streams.items():
        end = 0
        for start, n in sorted(places):
            assert start == end
            end += n
        whole = end // total[source] if total[source] else 1
        for epoch in range(whole):
            assert used[source, epoch] == Counter(d for d, _ in sizes[source])
        assert max(e for s, e in used if s == source) <= whole
        weight = {r.weight for r in rows if r.source == source}.pop()
        if total[source]:
            budget = max(total[s] / w for s, w in {(r.source, r.weight) for r in rows} if w)
            assert end <= weight * budget + 1e-6 and end > weight * budget - max(n for _, n in sizes[source]) - 1
            assert end <= repeats * total[source] + 1
    assert set(streams) == set(sizes)


@pytest.mark.parametrize("block", [3, 1024])
def test_op10(spark, sf_dir, block, monkeypatch):
    monkeypatch.setattr(mixing.Mixture.__init__, "__defaults__", (mixing.ENTROPY, mixing.REPEATS, None, block))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    check(QUERIES["op10_temperature_mixing"](spark, sf_dir).collect(), docs.collect())
    skewed = docs.withColumn("source", F.when(F.col("doc_id") % 10 < 7, "hot").when(F.col("doc_id") % 10 < 9, F.col("source")))
    rows = mixing.schedule(skewed).collect()
    check(rows, skewed.collect())
    assert len(rows) > docs.count()


def test_rows_are_those_of_the_schedule(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("source", F.when(F.col("doc_id") % 10 < 7, "hot")).withColumn("key", F.lit(1)).withColumn("whole_row", F.lit("x"))
    m = mixing.Mixture(docs, block=8)
    want = Counter(r.doc_id for r in m.schedule().collect())
    out = m.apply(docs)
    assert out.columns == docs.columns
    assert Counter(r.doc_id for r in out.collect()) == want


def test_a_small_budget(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = mixing.schedule(docs, budget=5000.0).collect()
    assert 0 < sum(r.n_tokens for r in rows) <= 5000 and {r.epoch for r in rows} == {0}


def test_odd_documents(spark, odd, clashing, nothing):
    rows = mixing.schedule(odd).collect()
    check(rows, odd.collect())
    assert {r.doc_id for r in mixing.mixed(clashing).collect()} == {r.doc_id for r in odd.collect()}
    assert mixing.mixed(nothing).collect() == mixing.schedule(nothing).collect() == []
    twice = odd.unionByName(odd)
    assert Counter(r.doc_id for r in mixing.mixed(twice).collect()).keys() == {r.doc_id for r in odd.collect()}
