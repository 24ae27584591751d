import hashlib
import zlib

import pytest

from granary.llm import ogg
from granary.llm.queries import QUERIES


def plain_crc(data):
    value = 0
    for byte in data:
        value ^= byte << 24
        for _ in range(8):
            value = (value << 1 ^ 0x04C11DB7 if value >> 31 else value << 1) & 0xFFFFFFFF
    return value


def test_crc():
    for data in (b"", b"a", b"OggS" * 50, bytes(range(256))):
        assert ogg.crc(data) == plain_crc(data)


@pytest.mark.parametrize("sizes", [[0], [1], [255], [254, 0, 256], [70_000, 3], [255 * 255], [576] * 300, [65_024, 1, 65_025, 0, 0]])
def test_packets_survive_pages(sizes):
    packets = [bytes([i % 251]) * n for i, n in enumerate(sizes)]
    ends = [sum(sizes[: i + 1]) for i in range(len(sizes))]
    other = ogg.pages([b"x" * 600, b""], 9, [0, 5], most=2)
    mine = ogg.pages(packets, 7, ends)
    mixed = [p for i in range(max(len(mine), len(other))) for pages in (mine, other) if i < len(pages) for p in [pages[i][1]]]
    streams = ogg.demux(b"".join(mixed))
    assert streams[7].packets == packets and streams[9].packets == [b"x" * 600, b""]
    assert streams[7].granules[-1] == ends[-1] and streams[7].seconds(10)[-1] == ends[-1] / 10
    assert all(g is None or g == e for g, e in zip(streams[7].granules, ends, strict=True))


def test_damage_is_found():
    data = ogg.record("some text " * 9000)
    assert ogg.samples_of(data)[0] == 90_000
    for at in (0, 4, 5, 20, 23, 40, len(data) // 2, len(data) - 1):
        with pytest.raises(ogg.OggError):
            ogg.samples_of(data[:at] + bytes([data[at] ^ 1]) + data[at + 1 :])
    for cut in (data[:-1], data[: len(data) // 2], data[30:], data + data):
        with pytest.raises(ogg.OggError):
            ogg.samples_of(cut)


def test_recordings_have_packets_that_span_pages():
    data = ogg.record("some text " * 20_000)
    flags, at = [], 0
    while at < len(data):
        n = data[at + 26]
        flags.append(data[at + 5])
        at += 27 + n + sum(data[at + 27 : at + 27 + n])
    assert sum(f & 1 for f in flags) >= 3  # pages that begin with the rest of a packet
    assert ogg.samples_of(data)[1] == ogg.payload("some text " * 20_000)


def expected(text):
    raw = (text or "").encode()
    payload = raw + b"\xff" * (-len(raw) % 576 or (0 if raw else 576))
    return len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:])


@pytest.mark.parametrize("which", ["documents", "odd", "clashing"])
def test_op2(spark, sf_dir, which, request):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet") if which == "documents" else request.getfixturevalue(which)
    got = (QUERIES["op2_ogg"](spark, sf_dir) if which == "documents" else ogg.media_digest(docs)).collect()
    assert sorted((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in got) == sorted((r.doc_id, *expected(r.text)) for r in docs.collect())
    by_payload = {}
    for r in got:
        assert by_payload.setdefault((r.payload_sha256, r.n_bytes), (r.media_bytes, r.media_sha256, r.feature)) == (r.media_bytes, r.media_sha256, r.feature)
        assert r.media_bytes > r.payload_bytes


def test_no_documents(nothing):
    assert ogg.media_digest(nothing).collect() == []
