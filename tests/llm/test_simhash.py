import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from granary.llm import simhash
from granary.llm.queries import QUERIES


def plain_fingerprint(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(marks, most=3):
    """marks: (doc_id, fingerprint) -> smallest doc_id reachable."""
    root = list(range(len(marks)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    values = np.array([f for _, f in marks], np.uint64)
    for i in range(len(marks)):
        for j in np.flatnonzero(np.bitwise_count(values[i:] ^ values[i]) <= most) + i:
            a, b = find(i), find(int(j))
            if a != b:
                root[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(marks):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(d, f"{f:016x}", least.get(find(i))) for i, (d, f) in enumerate(marks)]


def key(row):
    return tuple((x is None, x) for x in row)


def test_op3_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    want = plain_components([(r.doc_id, plain_fingerprint(r.text)) for r in docs])
    got = QUERIES["op3_simhash_neardup"](spark, sf_dir).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_odd_documents(spark, odd, clashing, nothing):
    want = sorted(plain_components([(r.doc_id, plain_fingerprint(r.text)) for r in odd.collect()]), key=key)
    for docs in (odd, clashing):
        assert sorted(map(tuple, simhash.near_duplicates(docs).collect()), key=key) == want
    assert simhash.near_duplicates(nothing).collect() == []
    twice = odd.unionByName(odd.withColumn("doc_id", F.lit(None).cast("long")))
    assert simhash.near_duplicates(twice).count() == 2 * odd.count()


@pytest.mark.parametrize("most", [0, 1, 2, 3])
def test_neighbour_links(most):
    """Two clouds about random centres: the linear way finds the components that all pairs give."""
    g = np.random.default_rng(most)
    centres = g.integers(0, 1 << 63, 40, dtype=np.uint64)
    x = np.unique([c ^ np.uint64(sum(1 << int(b) for b in g.choice(12, g.integers(0, 6), replace=False))) for c in centres for _ in range(12)])
    for links in (simhash._neighbour_links(x, most), simhash.bucket_links(np.stack([x, np.zeros_like(x)], axis=1), most)):
        got = {n: n for n in range(len(x))} | dict(zip(*map(np.ndarray.tolist, simhash.forest(*links)), strict=True)) if len(links[0]) else {n: n for n in range(len(x))}
        want = [c for *_, c in plain_components(list(enumerate(x.tolist())), most)]
        assert [got[n] for n in range(len(x))] == want


@pytest.mark.parametrize("heavy", [10**9, 3])
def test_links_cut_heavy_buckets(spark, monkeypatch, heavy):
    monkeypatch.setattr(simhash, "HEAVY", heavy)
    monkeypatch.setattr(simhash, "PAIRWISE", 8)
    g = np.random.default_rng(7)
    centres = g.integers(0, 1 << 63, 6, dtype=np.uint64)
    x = np.unique([c ^ np.uint64(sum(1 << int(b) for b in g.choice(64, g.integers(0, 4), replace=False))) for c in centres for _ in range(60)])
    nodes = spark.createDataFrame([(simhash._signed(int(v)), 0) for v in x], "a long, b long")
    edges = simhash.links(nodes, ["a"], 2, 3).collect()
    at = {simhash._signed(int(v)): i for i, v in enumerate(x)}
    got = {n: n for n in range(len(x))} | dict(zip(*map(np.ndarray.tolist, simhash.forest(*(np.array([at[e[i]] for e in edges]) for i in (0, 2)))), strict=True))
    assert [got[n] for n in range(len(x))] == [c for *_, c in plain_components(list(enumerate(x.tolist())))]


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (502, 501), (7, 7)], "x long, y long")
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {501: 500, 502: 500}


def test_keep_one(spark, odd, nothing):
    g = np.random.default_rng(3)
    words = [f"w{i}" for i in range(4000)]
    rows, groups = [], {}
    for group in range(30):
        base = [words[i] for i in g.integers(0, 4000, 300)]
        for copy in range(4):
            text = list(base)
            for at in g.choice(300, copy, replace=False):
                text[at] = "changed"
            rows.append((len(rows), " ".join(text), "en", "s", 0))
            groups[len(rows) - 1] = group
    docs = spark.createDataFrame(rows, odd.schema).withColumn("first", F.lit(1))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted({groups[i] for i in ids}) == list(range(30)) and len(ids) <= 31
    assert simhash.keep_one(nothing).collect() == []
    once = simhash.keep_one(odd.unionByName(odd)).collect()
    assert len(once) < odd.count() and len({r.text for r in once if r.text}) == len([r for r in once if r.text])


def plain_set(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def plain_groups(rows):
    """(doc_id, text) -> the smallest doc_id of each component over all pairs at 0.8 or more."""
    sets, root = [plain_set(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if jaccard(sets[i], sets[j]) >= 0.8:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(d, least.get(find(i), d))
    return sorted(least.values())


def kept(spark, odd, rows):
    return sorted(r.doc_id for r in simhash.keep_one(spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], odd.schema)).collect())


def test_documents_below_the_threshold_stay(spark, odd, sf_dir):
    """Pairs of Jaccard similarity 0.5 to 0.8 aren't near copies; the tables' own ones are those of all pairs."""
    g = np.random.default_rng(11)
    rows = []
    for _ in range(40):
        base = [f"w{i}" for i in g.integers(0, 4000, 300)]
        copy = list(base)
        for at in g.choice(300, 10, replace=False):
            copy[at] = "changed"
        rows += [(len(rows), " ".join(base)), (len(rows) + 1, " ".join(copy))]
    assert all(0.5 < jaccard(plain_set(rows[i][1]), plain_set(rows[i + 1][1])) < 0.8 for i in range(0, 80, 2))
    assert kept(spark, odd, rows) == list(range(80))
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert kept(spark, odd, rows) == plain_groups(rows)


@pytest.mark.parametrize(("crowd", "rounds"), [(32, 3), (2, 3), (2, 0)])
def test_all_near_copies_are_found(spark, odd, monkeypatch, crowd, rounds):
    """Appended and replaced passages and scattered changes around 0.8, also where keys are crowded, against all pairs."""
    monkeypatch.setattr(simhash, "CROWD", crowd)
    monkeypatch.setattr(simhash, "ROUNDS", rounds)
    g = np.random.default_rng(12)
    word = lambda n: [f"w{i}" for i in g.integers(0, 3000, n)]
    rows, pairs = [], {}
    for i in range(240):
        base = word(int(g.integers(60, 400)))
        n = len(base)
        size = int(n * g.uniform(0.02, 0.24))
        if i % 3 == 0:
            copy = base + word(size)
        elif i % 3 == 1:
            at, size = int(g.integers(0, n - size // 2)), size // 2
            copy = base[:at] + word(size) + base[at + size :]
        else:
            copy = list(base)
            for at in g.choice(n, max(1, size // 10), replace=False):
                copy[at] = "changed"
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(copy))]
        pairs[i] = jaccard(plain_set(rows[-2][1]), plain_set(rows[-1][1]))
    base = word(150)
    for _ in range(60):  # one group around a text, its members at 0.6 to 1 from each other
        copy = list(base)
        for at in g.choice(150, int(g.integers(0, 6)), replace=False):
            copy[at] = f"c{int(g.integers(0, 9))}"
        rows.append((len(rows), " ".join(copy)))
    assert sum(0.8 <= j < 0.9 for j in pairs.values()) > 60 and sum(j < 0.8 for j in pairs.values()) > 20
    assert kept(spark, odd, rows) == plain_groups(rows)


def test_a_repeated_line_makes_no_near_copies(spark, odd):
    g = np.random.default_rng(13)
    word = lambda n: " ".join(f"w{i}" for i in g.integers(0, 4000, n))
    rows = []
    for times, own in [(30, 100)] * 10 + [(20, 200)] * 10:
        line = word(12)
        rows += [(len(rows) + i, "\n".join([line] * times) + "\n" + word(own)) for i in range(2)]
    assert kept(spark, odd, rows) == list(range(40))


def test_near_copies_are_candidates_by_fingerprint(spark):
    """Rows of close fingerprints are found by the index of the fingerprints; what it doesn't find is left to the prefix filter."""
    rows = [(1, 0b1), (2, 0b1), (3, 0b11110 << 20), (4, 0b110), (5, 0b1111111)]
    nodes = spark.createDataFrame(rows, "row long, f long")
    found = {frozenset((r.x, r.y)) for r in simhash.marked_pairs(nodes).collect()}
    bits = dict(rows)
    assert frozenset((1, 2)) in found and frozenset((1, 4)) in found
    assert all(((bits[x] ^ bits[y]).bit_count()) <= 7 for x, y in map(sorted, found)) and not any(3 in pair for pair in found)
