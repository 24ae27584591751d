import duckdb
import pytest

from granary.llm import licenses
from granary.llm.queries import ORACLES, QUERIES


def plain(text, templates=licenses.TEMPLATES, threshold=licenses.THRESHOLD):
    """All blocks against all templates, and all words against all phrases."""
    text = text or ""
    words = licenses.plain_words(text)
    places, base = [], set()
    for phrase, label in {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}.items():
        ws = phrase.split()
        at = [i for i in range(len(words)) if words[i : i + len(ws)] == ws]
        places += at
        base |= {label} if at else set()
    names, share = set(), 0.0
    for name, t in templates.items():
        want = set(licenses.plain_words(t))
        span = licenses.longest(t, threshold)
        if len(want & set(words)) < threshold * len(want) - 1e-9:
            continue
        most = max(len(want & set(words[i : i + span])) for i in range(len(words)))
        if most >= threshold * len(want) - 1e-9:
            names.add(name)
            share = max(share, most / len(want))
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(base | names)), 1.0 if base else share


GRANT = licenses.TEMPLATES["mit-grant"]
WRAPPED = "\n".join(" * " + " ".join(GRANT.split()[i : i + 7]) for i in range(0, len(GRANT.split()), 7))
ODD = ["CC-BY cc_by ccby cc\nby", "GENERAL\tPublic, License general public licenses", "all rights reserved all rights reserved!", "éall rights reserved", "Released under the\nMIT License.", "under license MIT the RELEASED", "released under MIT license", "a license, Licensed the Version 2 0 Apache under", "x " * 5000 + "\nLicensed under CC BY-NC 4.0", "Permission granted free of charge to any person obtaining a copy of this software and associated files hereby is", "K cc K by", WRAPPED, "#\n# Released under the\n#\n# MIT License.", "intro " * 500 + licenses.TEMPLATES["mit-text"].replace(" ", "\n") + " end" * 300, "released " + "x " * 20 + "under the mit license", "released x under y the mit", (licenses.TEMPLATES["isc-text"] + "\n\n") * 3, "the of to and a in " * 2000]


@pytest.mark.parametrize("which", ["documents", "odd", "clashing", "notices"])
def test_op6(spark, sf_dir, odd, which, request):
    if which == "notices":
        docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(ODD + ODD)], odd.schema)
    else:
        docs = spark.read.parquet(f"{sf_dir}/documents.parquet") if which == "documents" else request.getfixturevalue(which)
    got = (QUERIES["op6_license_join"](spark, sf_dir) if which == "documents" else licenses.scan(docs)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr((r.doc_id, *plain(r.text))) for r in docs.collect())


def test_no_documents(nothing):
    assert licenses.scan(nothing).collect() == []


def test_wrapped_notices_have_labels(spark, odd):
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate([WRAPPED, "Released under the\nMIT License.", "(c) x\n" + licenses.TEMPLATES["bsd"].replace("forms", "forms\n"), "released " + "x " * 20 + "under the mit"])], odd.schema)
    got = {r.doc_id: r.labels for r in licenses.scan(docs).collect()}
    assert got == {0: "mit-grant", 1: "mit", 2: "bsd", 3: ""}


def test_op6_against_sql(spark, sf_dir, odd, tmp_path):
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate([*ODD, *ODD, None, ""])], odd.schema).unionByName(odd)
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    for folder, files in ((sf_dir, "documents.parquet"), (str(tmp_path), "documents.parquet/*.parquet")):
        con = duckdb.connect()
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/{files}'")
        want = con.execute(ORACLES["op6_license_join"])
        got = QUERIES["op6_license_join"](spark, folder)
        assert [c[0] for c in want.description] == got.columns
        assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want.fetchall()))


def test_order_is_by_corpus_frequency(spark, odd):
    templates = {"mit": "Released under the MIT License."}
    docs = spark.createDataFrame([(1, "the MIT the released, The under", None, None, None), (2, "THE MIT", None, None, None)], odd.schema)
    counts = licenses.frequencies(licenses.word_places(docs, templates), templates)
    assert counts == {"released": 1, "under": 1, "the": 4, "mit": 2, "license": 0}
    assert [(*r[:4], *r[4:7]) for r in licenses.prefixes(templates, counts, 0.6)] == [("license", "mit", 0, [], 5, 3, 9), ("released", "mit", 1, ["license"], 5, 3, 9), ("under", "mit", 2, ["license", "released"], 5, 3, 9)]


def test_words():
    assert licenses.plain_words("Ab9É-x_y") == ["ab9É", "x", "y"]
    assert all(w.isascii() and w.isalnum() for w in licenses.vocabulary(licenses.TEMPLATES))
