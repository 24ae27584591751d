"""Ogg containers in a binary column: multiplexing, and what a reader needs to trust one.

A physical stream is a sequence of pages; each belongs to one logical stream (its serial number), holds packets as runs of
lacing values (255 means "goes on"), a granule position (samples finished by the page's last complete packet) and a
CRC-32 of the page with its checksum field zero.  `demux` verifies each checksum and sequence number, takes the logical
streams apart, reassembles packets across pages and derives timestamps from granule positions.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import bounded, slices, stored, texts

#: Samples in a packet of the sample stream.
PACKET = 576
RATE = 8000
#: Lacing values on a page of samples: not a multiple of a packet's three, so packets go on from page to page.
PAGE_LACING = 254
_HEADER = struct.Struct("<4sBBqIIIB")
_CONTINUED, _FIRST, _LAST = 1, 2, 4
_PCM = struct.Struct("<8sHHIIBB")
_REVERSED = bytes(int(f"{i:08b}"[::-1], 2) for i in range(256))


def crc(page: bytes) -> int:
    """Ogg's CRC-32 (polynomial 0x04c11db7, most significant bit first, zero start): zlib's, with bits mirrored."""
    mirrored = zlib.crc32(page.translate(_REVERSED), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int.from_bytes(mirrored.to_bytes(4, "little").translate(_REVERSED), "big")


def _page(flags: int, granule: int, serial: int, sequence: int, lacing: bytes, body: bytes) -> bytes:
    head = _HEADER.pack(b"OggS", 0, flags, granule, serial, sequence, 0, len(lacing)) + lacing
    return head[:22] + struct.pack("<I", crc(head + body)) + head[26:] + body


def pages(packets: list[bytes], serial: int, granules: list[int], alone: int = 1, most: int = 255) -> list[tuple[int, bytes]]:
    """(granule, page) of a logical stream. The first ``alone`` packets get pages of their own; a page has at most ``most`` lacing values."""
    out: list[tuple[int, bytes]] = []
    lacing, body, flags, granule, sequence = bytearray(), [], _FIRST, -1, 0

    def flush(last: bool, continued: bool) -> None:
        nonlocal lacing, body, flags, granule, sequence
        out.append((granule, _page(flags | (_LAST if last else 0), granule, serial, sequence, bytes(lacing), b"".join(body))))
        lacing, body, granule, sequence = bytearray(), [], -1, sequence + 1
        flags = _CONTINUED if continued else 0

    for i, (packet, end) in enumerate(zip(packets, granules, strict=True)):
        need, at = len(packet) // 255 + 1, 0
        while need:
            if len(lacing) == most:
                flush(False, at > 0)
            n = min(need, most - len(lacing))
            part = packet[at : at + 255 * n]
            body.append(part)
            at += len(part)
            need -= n
            lacing += bytes([255]) * (n if need else n - 1)
            if not need:
                lacing.append(len(packet) % 255)
                granule = end
        if i < alone and i + 1 < len(packets):
            flush(False, False)
    if lacing or not out:
        flush(True, False)
    return out


@dataclass
class Stream:
    """A logical stream: its packets, each with the granule position it ends at where its page tells (else None)."""

    serial: int
    packets: list[bytes] = field(default_factory=list)
    granules: list[int | None] = field(default_factory=list)
    pages: int = 0
    ended: bool = False

    def seconds(self, rate: int = RATE) -> list[float | None]:
        return [None if g is None else g / rate for g in self.granules]


class OggError(ValueError):
    pass


def demux(data: bytes) -> dict[int, Stream]:
    """Logical streams by serial number. A bad capture pattern, checksum, page order or unfinished packet raises OggError."""
    streams: dict[int, Stream] = {}
    open_packets: dict[int, list[bytes]] = {}
    at, size = 0, len(data)
    while at < size:
        if size - at < 27:
            raise OggError("a page is cut off")
        magic, version, flags, granule, serial, sequence, checksum, n = _HEADER.unpack_from(data, at)
        if magic != b"OggS" or version:
            raise OggError(f"no page at byte {at}")
        lacing = data[at + 27 : at + 27 + n]
        start = at + 27 + n
        end = start + sum(lacing)
        if end > size:
            raise OggError("a page is cut off")
        if crc(data[at : at + 22] + b"\0\0\0\0" + data[at + 26 : end]) != checksum:
            raise OggError(f"checksum of the page at byte {at}")
        if bool(flags & _FIRST) == (serial in streams):
            raise OggError("a stream must begin once")
        stream = streams.setdefault(serial, Stream(serial))
        held = open_packets.setdefault(serial, [])
        if sequence != stream.pages or stream.ended or bool(flags & _CONTINUED) != bool(held):
            raise OggError(f"page order in stream {serial}")
        stream.pages += 1
        whole = len(stream.packets)
        for value in lacing:
            held.append(data[start : start + value])
            start += value
            if value < 255:
                stream.packets.append(b"".join(held))
                stream.granules.append(None)
                held.clear()
        if len(stream.packets) > whole and granule >= 0:
            stream.granules[-1] = granule
        stream.ended = bool(flags & _LAST)
        at = end
    if any(open_packets.values()) or not all(s.ended for s in streams.values()):
        raise OggError("a packet or stream isn't finished")
    return streams


def payload(text: str) -> bytes:
    """UTF-8, with bytes 255 up to a positive multiple of PACKET."""
    raw = text.encode("utf-8", "surrogatepass")
    return raw + b"\xff" * (PACKET - len(raw) % PACKET if len(raw) % PACKET or not raw else 0)


def record(text: str) -> bytes:
    """Two logical streams: unsigned 8-bit samples at RATE (a header packet, then packets of PACKET samples), and one that
    says how many bytes are text. Serial numbers come from the content, so equal texts are stored alike."""
    samples = payload(text)
    n = len(text.encode("utf-8", "surrogatepass"))
    serial = zlib.crc32(samples)
    other = serial ^ 0x80000000
    head = _PCM.pack(b"PCM     ", 0, 0, 1, RATE, 8, 1)
    packets = [samples[i : i + PACKET] for i in range(0, len(samples), PACKET)]
    sound = pages([head, *packets], serial, [0, *range(PACKET, len(samples) + 1, PACKET)], most=PAGE_LACING)
    note = pages([b"NOTE    ", b"bytes=%d" % n], other, [0, len(samples)])
    # first pages of all streams come first; the rest in order of time
    rest = sorted([(g, 0, i, p) for i, (g, p) in enumerate(sound[1:])] + [(g, 1, i, p) for i, (g, p) in enumerate(note[1:])])
    return b"".join([sound[0][1], note[0][1], *(p for *_, p in rest)])


def samples_of(data: bytes) -> tuple[int, bytes, str]:
    """From a stored recording alone: bytes of text, the samples, and a description."""
    streams = demux(data)
    sound = next(s for s in streams.values() if s.packets[0].startswith(b"PCM     "))
    note = next(s for s in streams.values() if s.packets[0].startswith(b"NOTE    "))
    _, _, _, channels, rate, bits, _ = _PCM.unpack(sound.packets[0])
    samples = b"".join(sound.packets[1:])
    if sound.granules[-1] != len(samples):
        raise OggError("the granule position isn't the number of samples")
    times = [t for t in sound.seconds(rate) if t is not None]
    silence = samples.count(b"\xff")
    said = f"streams={len(streams)};pages={sum(s.pages for s in streams.values())};packets={len(sound.packets)};rate={rate};channels={channels};bits={bits};seconds={times[-1]:.6f};mean={sum(samples) / len(samples):.4f};fill={silence}"
    return int(note.packets[1].partition(b"=")[2]), samples, said


def _store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        media = [record(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(media, pa.binary())], names=["doc_id", "media"])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        out: list[list] = [[] for _ in range(7)]
        for data in batch.column("media").to_pylist():
            n, samples, said = samples_of(data)
            values = n, len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-32:]), len(data), hashlib.sha256(data).hexdigest(), said
            for column, value in zip(out, values, strict=True):
                column.append(value)
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, out, kinds)], names=["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])


def to_media(docs: DataFrame) -> DataFrame:
    """doc_id, media: every whole text (null: empty) as an Ogg recording. No shuffle; a task holds one batch of texts."""
    bounded(docs.sparkSession)
    return texts(docs).mapInArrow(_store, "doc_id long, media binary")


def media_features(media: DataFrame) -> DataFrame:
    """What the stored bytes say, all read back from them; a damaged recording fails the job with its reason.

    ``feature``: streams, pages, packets, rate, channels, bits, seconds (the last timestamp), mean sample, samples of 255.
    """
    bounded(media.sparkSession)
    kinds = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return media.select("doc_id", "media").mapInArrow(_features, kinds)


def media_digest(docs: DataFrame) -> DataFrame:
    """Store every text as a recording in the shared folder and describe what is read from there.

    Equal texts give equal values; an empty or null text is one packet of 255s; an empty table gives no rows.
    """
    return media_features(stored(to_media(docs), "media", **{"parquet.block.size": str(16 << 20)}))
