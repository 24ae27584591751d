import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from granary.llm.common import vocabulary_path, work_folder
from granary.llm.elias_fano import EliasFano, read_corpus, write_corpus
from granary.llm.packing import best_fit, pack, residue
from granary.llm.queries import QUERIES


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(vocabulary_path())
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 1]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


@pytest.mark.parametrize("values", [[], [0], [5], [0, 0, 0], [1, 3, 3, 900_000, 900_000], list(range(0, 5000, 7))])
def test_elias_fano_round_trip(values):
    universe = values[-1] if values else 0
    e = EliasFano.encode(np.array(values), universe)
    assert e.values().tolist() == values
    assert [e.select(i) for i in range(len(values))] == values == e.select(np.arange(len(values))).tolist() == e.values().tolist()
    assert e.select(np.arange(len(values))[::-3]).tolist() == values[::-3]
    with pytest.raises(IndexError):
        e.select(len(values))


def test_elias_fano_is_near_minimal():
    values = np.sort(np.random.default_rng(1).integers(0, 10**7, 10_000))
    e = EliasFano.encode(values, int(values[-1]))
    assert e.values().tolist() == values.tolist()
    assert [e.select(i) for i in (0, 17, 9_999)] == values[[0, 17, 9_999]].tolist()
    assert 8 * (len(e.lower) + len(e.upper)) <= 10_000 * (3 + np.log2(10**7 / 10_000))


def expected_corpus(rows, library):
    out, start = [], 0
    for doc_id, text in sorted(rows):
        ids = library(text)
        out.append((doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    return out


def test_op1_against_library(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(tuple(r) for r in QUERIES["op1_elias_fano"](spark, sf_dir).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    assert got == expected_corpus([tuple(r) for r in docs], library)


def test_odd_documents(spark, odd, clashing, nothing, library):
    want = expected_corpus([(r.doc_id, r.text or "") for r in odd.collect()], library)
    for docs in (odd, clashing):
        folder = work_folder(spark, "test")
        write_corpus(docs, folder, segment_ids=50)
        assert sorted(map(tuple, read_corpus(spark, folder).collect())) == want
    folder = work_folder(spark, "test")
    write_corpus(nothing, folder)
    assert read_corpus(spark, folder).collect() == []


def check_packing(rows, texts, library, capacity=4096):
    ids = {d: library(t) for d, t in texts}
    sequences = {}
    for r in rows:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert r.start == r.piece * capacity and r.length == len(part) and r.ids_crc32 == crc(part)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    assert sum(r.length for r in rows) == sum(len(ids[d]) for d, _ in texts)
    return len(sequences), -(-sum(r.length for r in rows) // capacity)


def test_op8_on_documents(spark, sf_dir, library):
    texts = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    used, least = check_packing(QUERIES["op8_residual_packing"](spark, sf_dir).collect(), texts, library)
    assert used <= least * 1.02 + 1


def test_packing_tree(spark, odd, clashing, nothing, library):
    texts = [(r.doc_id, r.text) for r in odd.collect()]
    for docs in (odd.repartition(9, "doc_id"), clashing.repartition(40, "doc_id")):
        used, least = check_packing(pack(docs, fan=2).collect(), texts, library)
        assert used <= least + 1
    assert pack(nothing).collect() == []


def test_best_fit():
    bins, places, fills = best_fit([5, 5, 3, 7, 10, 2], 10)
    assert fills == [10, 10, 10, 2] or sum(fills) == 32
    for b in set(bins):
        end = 0
        for place, size in sorted((p, s) for p, s, x in zip(places, [5, 5, 3, 7, 10, 2], bins, strict=True) if x == b):
            assert place == end
            end += size
        assert end == fills[b] <= 10
    assert residue([10, 3, 8, 6, 9], 10, 2) == [1, 3, 2]
