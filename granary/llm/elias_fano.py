"""Token ids on disk with Elias-Fano document boundaries.

File format: a folder of Parquet files whose rows are *segments* in ascending (shard, segment) order.  A segment
holds the concatenated ids of some whole documents (``ids``: two little-endian bytes each), their ``doc_ids`` and
the monotone sequence of their boundaries in Elias-Fano form (``low_bits``, ``lower``, ``upper``); ``before`` counts the
shard's ids before the segment.  A shard is one range of doc_id, so only one number a shard is needed to
turn a local offset into a global one, and no 64-bit offset of any document is stored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bounded, slices, small_side, texts, vocabulary_path, word_ids

END_ID = 1
#: Ids after which a segment closes; one longer document makes a segment of its own.
SEGMENT_IDS = 1 << 15
SEGMENTS = "shard long, segment long, before long, doc_ids array<long>, n_ids long, low_bits int, lower binary, upper binary, ids binary"


class EliasFano:
    """A non-decreasing sequence of n integers in [0, universe] in about n (2 + log2(universe / n)) bits.

    ``select(i)`` is value i: the position of the i-th set bit of ``upper``, less i, gives the high bits. One 32-bit
    count for every 512 bits is held to find that bit; nothing of 64 bits is stored.
    """

    BLOCK = 64  # bytes

    def __init__(self, n: int, low_bits: int, lower: bytes, upper: bytes):
        self.n, self.low_bits = n, low_bits
        self.lower, self.upper = np.frombuffer(lower, np.uint8), np.frombuffer(upper, np.uint8)
        ones = np.bitwise_count(self.upper)
        starts = np.arange(0, len(ones), self.BLOCK)
        self.samples = np.concatenate([[0], np.cumsum(np.add.reduceat(ones, starts, dtype=np.uint32), dtype=np.uint32)]) if len(ones) else np.zeros(1, np.uint32)

    @classmethod
    def encode(cls, values: np.ndarray, universe: int) -> EliasFano:
        values = np.asarray(values, np.int64)
        n = len(values)
        low = max(0, int(universe // n).bit_length() - 1) if n else 0
        upper = np.zeros(((int(universe) >> low) + n + 8) // 8, np.uint8) if n else np.zeros(0, np.uint8)
        at = (values >> low) + np.arange(n)
        np.bitwise_or.at(upper, at >> 3, (1 << (at & 7)).astype(np.uint8))
        bits = ((values[:, None] >> np.arange(low)) & 1).astype(np.uint8)
        return cls(n, low, np.packbits(bits.ravel(), bitorder="little").tobytes(), upper.tobytes())

    def select(self, places: int | np.ndarray) -> int | np.ndarray:
        """The values at some places; only the blocks of ``upper`` that hold their bits are read."""
        i = np.atleast_1d(np.asarray(places, np.int64))
        if len(i) and not (0 <= i.min() and i.max() < self.n):
            raise IndexError(places)
        block = np.searchsorted(self.samples, i, side="right") - 1
        wanted, at = np.unique(block, return_inverse=True)
        rows = np.zeros((len(wanted), self.BLOCK), np.uint8)
        for row, b in zip(rows, wanted.tolist(), strict=True):
            part = self.upper[b * self.BLOCK : (b + 1) * self.BLOCK]
            row[: len(part)] = part
        ones = np.flatnonzero(np.unpackbits(rows.ravel(), bitorder="little"))
        before = np.searchsorted(ones, np.arange(len(wanted)) * self.BLOCK * 8)
        found = ones[before[at] + i - self.samples[block]] + (wanted - np.arange(len(wanted)))[at] * self.BLOCK * 8
        bits = i[:, None] * self.low_bits + np.arange(self.low_bits)
        low = ((self.lower[bits >> 3] >> (bits & 7).astype(np.uint8)) & 1).astype(np.int64) << np.arange(self.low_bits) if self.low_bits else np.zeros((len(i), 0), np.int64)
        out = (found - i) << self.low_bits | low.sum(axis=1)
        return out if np.ndim(places) else int(out[0])

    def values(self) -> np.ndarray:
        """All of them at once."""
        if not self.n:
            return np.zeros(0, np.int64)
        high = np.flatnonzero(np.unpackbits(self.upper, bitorder="little"))[: self.n] - np.arange(self.n)
        bits = np.unpackbits(self.lower, bitorder="little")[: self.n * self.low_bits].reshape(self.n, self.low_bits)
        return (high << self.low_bits) | (bits.astype(np.int64) << np.arange(self.low_bits)).sum(axis=1)


def _segment(shard: int, number: int, before: int, doc_ids: list, parts: list[bytes]) -> dict:
    ends = np.cumsum([len(x) // 2 for x in parts])
    total = int(ends[-1])
    index = EliasFano.encode(ends, total)
    return {"shard": shard, "segment": number, "before": before, "doc_ids": doc_ids, "n_ids": total, "low_bits": index.low_bits, "lower": index.lower.tobytes(), "upper": index.upper.tobytes(), "ids": b"".join(parts)}


def _writer(path: str, end_id: int, segment_ids: int):
    end = int(end_id).to_bytes(2, "little")
    schema = pa.schema([("shard", pa.int64()), ("segment", pa.int64()), ("before", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("n_ids", pa.int64()), ("low_bits", pa.int32()), ("lower", pa.binary()), ("upper", pa.binary()), ("ids", pa.binary())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard = word_ids(path).of, TaskContext.get().partitionId()
        number = before = size = 0
        doc_ids: list = []
        parts: list[bytes] = []
        for batch in slices(batches):
            done = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1).to_pylist()), strict=True):
                doc_ids.append(doc_id)
                parts.append(ids + end)
                size += len(parts[-1]) // 2
                if size >= segment_ids:
                    done.append(_segment(shard, number, before, doc_ids, parts))
                    number, before, size, doc_ids, parts = number + 1, before + size, 0, [], []
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=schema)
        if parts:
            yield pa.RecordBatch.from_pylist([_segment(shard, number, before, doc_ids, parts)], schema=schema)

    return write


def write_corpus(docs: DataFrame, folder: str, vocabulary: str | None = None, end_id: int = END_ID, segment_ids: int = SEGMENT_IDS) -> None:
    """Encode every whole text and write the ids in ascending doc_id order (null ids first, equal ones by text).

    Null texts count as empty; rows that are there twice are written twice; other columns aren't read; an empty table makes a folder without
    rows.  One shuffle by ranges of doc_id, sized by Spark; a task holds one segment and one Arrow batch, whatever its range holds.
    """
    spark = docs.sparkSession
    bounded(spark)
    ordered = texts(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    segments = ordered.mapInArrow(_writer(vocabulary or vocabulary_path(), end_id, segment_ids), SEGMENTS)
    segments.write.options(**{"compression": "zstd", "parquet.block.size": str(16 << 20)}).parquet(folder)


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: dict[str, list] = {"doc_id": [], "start": [], "n_tokens": [], "ids_crc32": []}
        for row in batch.to_pylist():
            n = len(row["doc_ids"])
            index = EliasFano(n, row["low_bits"], row["lower"], row["upper"])
            ends = index.select(np.arange(n))
            starts = np.concatenate([[0], ends[:-1]])
            ids = np.frombuffer(row["ids"], "<u2").astype("<u4")
            out["doc_id"] += row["doc_ids"]
            out["start"] += (starts + row["base"] + row["before"]).tolist()
            out["n_tokens"] += (ends - starts).tolist()
            out["ids_crc32"] += [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out.values()], names=list(out))


def read_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """One row a document from the files alone: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    An empty corpus gives no rows. Only one number a shard is summed in one place and sent to all tasks: as many as
    the writing job had tasks.
    """
    bounded(spark)
    segments = spark.read.schema(SEGMENTS).parquet(folder)
    shards = segments.groupBy("shard").agg(F.sum("n_ids").alias("n_ids"))
    running = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = shards.select("shard", F.coalesce(F.sum("n_ids").over(running), F.lit(0)).alias("base"))
    return segments.join(small_side(bases), "shard").mapInArrow(_reader, "doc_id long, start long, n_tokens long, ids_crc32 long")
