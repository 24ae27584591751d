import zlib

import numpy as np
import pytest

from granary.llm import language
from granary.llm.queries import QUERIES


def test_gradients_against_differences():
    rng = np.random.default_rng(0)
    net = language.Network(["a", "b", "c"], units=3)
    for layer in net.layers:
        layer.table, layer.inner, layer.outer = (w.astype(float) for w in layer.weights)
    x, y = rng.integers(0, 5, (6, 4)).astype(np.uint8), np.array([0, 1, 2, 1])
    _, found = net.gradients(x, y)
    for w, g in zip(net.layers[0].weights + net.layers[1].weights + [net.bias], found, strict=True):
        for _ in range(4):
            at = tuple(int(rng.integers(0, min(s, 5))) for s in w.shape)
            old, losses = w[at], []
            for move in (0.01, -0.01):
                w[at] = old + move
                losses.append(net.gradients(x, y)[0])
            w[at] = old
            assert g[at] == pytest.approx((losses[0] - losses[1]) / 0.02, abs=2e-4)


def test_pooling_covers_every_position():
    net = language.Network(["a", "b"])
    raw = [bytes(np.random.default_rng(i).integers(0, 256, n, dtype=np.uint8)) for i, n in enumerate((1, 63, 64, 65, 1000, 64 * 5))]
    for got, b in zip(net.pooled(raw), raw, strict=True):
        padded = b.ljust(-(-len(b) // 64) * 64, b" ")
        p, _ = net.probabilities(np.frombuffer(padded, np.uint8).reshape(-1, 64).T.copy())
        every = p.transpose(2, 0, 1).reshape(-1, 2)[: len(b)]
        assert got == pytest.approx(every.mean(axis=0), abs=1e-5)
        assert got.sum() == pytest.approx(1, abs=1e-4)


def test_op7_on_held_out_documents(spark):
    d = "/root/testdata/sf0.01"
    got = QUERIES["op7_bigru_language"](spark, d)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    rows = {r.doc_id: r for r in got.collect()}
    docs = spark.read.parquet(f"{d}/documents.parquet").collect()
    assert len(rows) == len(docs)
    assert all(rows[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in docs)
    held = [rows[r.doc_id].lang_pred == r.lang for r in docs if rows[r.doc_id].held_out]
    assert sum(held) / len(held) >= 0.95
    assert all(0 <= r.score <= 1 for r in rows.values())


def test_letters():
    assert not any(map(language.has_letter, ["", " ", "123", "²½ Ⅷ ①", "_-:", "৩", "\u0301"]))
    assert all(map(language.has_letter, ["a", "1é", "日", "ʰ", "ª"]))


def test_letters_in_documents(spark, odd):
    docs = spark.createDataFrame([(1, "²½ Ⅷ ①", "en", None, None), (2, "plain words here", "en", None, None), (3, "_ 5", "xx", None, None)], odd.schema)
    net = language.train(docs, rounds=3)
    assert net.labels == ["en"]
    assert [r.lang_pred for r in language.predicted(docs, net).orderBy("doc_id").collect()] == ["und", "en", "und"]


def test_every_language_is_learned(spark, odd):
    """More languages than a hundred, one of them with a third of the rows."""
    rows = [(i, f"{chr(0x4E00 + k)} word{k} ", f"l{k:03}", None, None) for i, k in enumerate([*range(130)] * 4 + [7] * 260)]
    docs = spark.createDataFrame(rows, odd.schema)
    net = language.train(docs, rows=3, windows=1, rounds=2)
    assert net.labels == sorted({r[2] for r in rows})


def test_sample_is_bounded_and_whole(spark, odd, monkeypatch):
    seen = {}
    monkeypatch.setattr(language.Network, "fit", lambda self, x, y, rounds: seen.update(x=x, y=y) or self)
    text = "".join(chr(97 + i // 4000) * 1 for i in range(26 * 4000))
    docs = spark.createDataFrame([(i, text, "aa" if i % 3 else "bb", None, None) for i in range(300)], odd.schema)
    language.train(docs, rows=20, windows=50)
    assert np.bincount(seen["y"]).tolist() == [1000, 1000]
    assert len(np.unique(seen["x"])) == 26  # from all of a long text, its end included


def test_odd_documents(spark, odd, clashing, nothing):
    for docs in (odd, clashing):
        net = language.train(docs, rounds=5)
        got = {r.doc_id: (r.lang_pred, r.score) for r in language.predicted(docs, net).collect()}
        assert len(got) == docs.count()
        for r in docs.collect():
            assert got[r.doc_id][0] == ("en" if any(c.isalpha() for c in r.text or "") else "und")
    assert language.train(nothing) is None
    assert {(r.lang_pred, r.score) for r in language.predicted(odd, None).collect()} == {("und", 0.0)}
    assert language.predicted(nothing, net).collect() == []
