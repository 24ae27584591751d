"""Hierarchical residual packing of token sequences.

Each partition cuts its documents into pieces and packs them best-fit, largest first.  Of two bins that are at most half
full one would have been filled further, so a partition leaves at most one such bin: that one, and the few bins with the
widest gaps, are its residue, and all other bins are emitted.  Residues of neighbouring partitions then meet in a tree; in
each round residual bins are items of another best-fit.  A group of `fan` residues holds at most `fan` bins that are half
full or less, so the `fan` widest hosts of each are all that any later round can use: what goes up stays small.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, slices, stored, texts, vocabulary_path, word_ids

CAPACITY = 4096
FAN = 16
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, leaf long, bin long, place long, fill long"
_ARROW = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("leaf", pa.int64()), ("bin", pa.int64()), ("place", pa.int64()), ("fill", pa.int64())])


def best_fit(sizes: list[int], capacity: int) -> tuple[list[int], list[int], list[int]]:
    """Largest first into the fullest bin with room: for each size its bin and place there; the bins' fills.

    Bins are kept in stacks by remaining room and the rooms in use in a sorted list, so a step costs a binary search.
    """
    bins, places, fills = [0] * len(sizes), [0] * len(sizes), []
    rooms: list[int] = []
    stacks: dict[int, list[int]] = {}
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        size = sizes[i]
        at = bisect.bisect_left(rooms, size)
        if at < len(rooms):
            room = rooms[at]
            chosen = stacks[room].pop()
            if not stacks[room]:
                del stacks[room], rooms[at]
        else:
            room, chosen = capacity, len(fills)
            fills.append(0)
        bins[i], places[i] = chosen, fills[chosen]
        fills[chosen] += size
        if left := room - size:
            if left not in stacks:
                stacks[left] = []
                bisect.insort(rooms, left)
            stacks[left].append(chosen)
    return bins, places, fills


def residue(fills: list[int], capacity: int, fan: int) -> list[int]:
    """Positions of the bins that a later round can use: those at most half full, and the `fan` others with the widest gaps."""
    small = [i for i, f in enumerate(fills) if 2 * f <= capacity]
    hosts = sorted((i for i, f in enumerate(fills) if capacity < 2 * f < 2 * capacity), key=lambda i: (fills[i], i))
    return small + hosts[:fan]


def _packer(path: str, capacity: int, end_id: int):
    end = int(end_id).to_bytes(2, "little")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, leaf = word_ids(path).of, TaskContext.get().partitionId()
        doc_ids, pieces, starts, lengths, crcs = [], [], [], [], []
        for batch in slices(batches):
            for doc_id, coded in zip(batch.column(0).to_pylist(), encode(batch.column(1).to_pylist()), strict=True):
                ids = np.frombuffer(coded + end, "<u2").astype("<u4")
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    doc_ids.append(doc_id)
                    pieces.append(piece)
                    starts.append(start)
                    lengths.append(len(part))
                    crcs.append(zlib.crc32(part.tobytes()))
        if not lengths:
            return
        bins, places, fills = best_fit(lengths, capacity)
        columns = [doc_ids, pieces, starts, lengths, crcs, [leaf] * len(bins), bins, places, [fills[b] for b in bins]]
        table = pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(columns, _ARROW, strict=True)], schema=_ARROW)
        yield from table.to_batches(max_chunksize=20_000)

    return pack


def _merger(capacity: int, fan: int):
    schema = pa.schema([("leaf", pa.int64()), ("bin", pa.int64()), ("into_leaf", pa.int64()), ("into_bin", pa.int64()), ("shift", pa.int64()), ("fill", pa.int64()), ("open", pa.bool_())])

    def merge(table: pa.Table) -> pa.Table:
        rows = sorted(table.select(["leaf", "bin", "fill"]).to_pylist(), key=lambda r: (r["leaf"], r["bin"]))
        bins, places, fills = best_fit([r["fill"] for r in rows], capacity)
        firsts: dict[int, dict] = {}
        for row, b, place in zip(rows, bins, places, strict=True):
            if place == 0:
                firsts[b] = row
        still = set(residue(fills, capacity, fan))
        out = [{"leaf": r["leaf"], "bin": r["bin"], "into_leaf": firsts[b]["leaf"], "into_bin": firsts[b]["bin"], "shift": place, "fill": fills[b], "open": b in still and place == 0} for r, b, place in zip(rows, bins, places, strict=True)]
        return pa.Table.from_pylist(out, schema=schema)

    return merge


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None, end_id: int = 1, fan: int = FAN) -> DataFrame:
    """One row a piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null texts are empty (one end id); only documents longer than a sequence are cut; documents that are there twice are
    packed twice; an empty table gives no rows.  Other columns of docs are not read.  Partitions are those of the
    scan: texts aren't shuffled. The packed pieces are stored before the tree, so bins never change under a retry.
    """
    spark = docs.sparkSession
    bounded(spark)
    pieces = stored(texts(docs).mapInArrow(_packer(vocabulary or vocabulary_path(), capacity, end_id), PIECES), "packed")
    bins = pieces.groupBy("leaf", "bin").agg(F.max("fill").alias("fill"))
    # a partition's residue: bounded by its one small bin and `fan` hosts, found without sorting the full bins
    half = bins.where(2 * F.col("fill") <= capacity)
    hosts = bins.where((2 * F.col("fill") > capacity) & (F.col("fill") < capacity)).groupBy("leaf").agg(F.slice(F.array_sort(F.collect_list(F.struct("fill", "bin"))), 1, fan).alias("hosts"))
    hosts = hosts.select("leaf", F.explode("hosts").alias("h")).select("leaf", "h.bin", "h.fill")
    items = stored(half.select("leaf", "bin", "fill").unionByName(hosts).select(F.col("leaf").alias("node"), "leaf", "bin", "fill"), "residue")
    moves = []
    while True:
        nodes = items.agg(F.countDistinct("node")).first()[0]
        if nodes <= 1:
            break
        step = items.withColumn("node", F.floor(F.col("node") / fan)).groupBy("node").applyInArrow(_merger(capacity, fan), "leaf long, bin long, into_leaf long, into_bin long, shift long, fill long, open boolean")
        step = stored(step, "round")
        moves.append(step.where((F.col("leaf") != F.col("into_leaf")) | (F.col("bin") != F.col("into_bin"))).select("leaf", "bin", "into_leaf", "into_bin", "shift"))
        high = fan ** len(moves)
        items = step.where("open").select(F.floor(F.col("leaf") / high).alias("node"), "leaf", "bin", "fill")
    out = pieces
    for move in moves:
        near = move.select(F.col("leaf").alias("_leaf"), F.col("bin").alias("_bin"), "into_leaf", "into_bin", "shift")
        out = out.join(near, (out["leaf"] == near["_leaf"]) & (out["bin"] == near["_bin"]), "left").select("doc_id", "piece", "start", "length", "ids_crc32", F.coalesce("into_leaf", "leaf").alias("leaf"), F.coalesce("into_bin", "bin").alias("bin"), (F.col("place") + F.coalesce("shift", F.lit(0))).alias("place"))
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", (F.shiftleft("leaf", 32) + F.col("bin")).alias("sequence_id"), F.col("place").alias("offset"))
