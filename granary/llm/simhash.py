"""SimHash near duplicates, found by deletion-variant signatures of fingerprint segments.

A fingerprint is cut into so few segments that two documents close enough differ by at most one bit in one of them.  Every
segment is indexed once for each of its bits with that bit wiped out, so two such documents meet under an equal key; within
a key the fingerprints are compared in full.  Only distinct fingerprints are indexed (copies share one), a task holds one
bucket at a time and gives back a spanning forest of the links, not the links, and a bucket that could be large is cut further
along the fingerprint's other bits before it reaches a task.

Near copies by Jaccard similarity (keep_one) are candidates of the same index first, each verified on shingle sets; a prefix filter
over the sets then finds every pair that can be similar enough, and what isn't connected yet is verified, too.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded, slices, small_side, stored, texts

SEED = 42
#: Shingles whose bits are summed at a time, whatever the text's length.
CHUNK = 1 << 15
#: A segment value with more distinct fingerprints than this has its buckets cut further.
HEAVY = 8192
#: Up to so many members all are compared in blocks; beyond, links of up to three bits meet at their common neighbours.
PAIRWISE = 16_384
#: Fingerprints that at least one in so many rows has aren't shuffled for.
FEW = 2000
EDGES = "a1 long, b1 long, a2 long, b2 long"
#: Rows of two longs in an Arrow batch of the index.
INDEX_ROWS = 50_000


def _shingles(text: str, words: int) -> list[bytes]:
    split = text.encode("utf-8", "surrogatepass").lower().split()
    if not split:
        return []
    if len(split) <= words:
        return [b" ".join(split)]
    return split if words == 1 else list(map(b" ".join, zip(*(split[i:] for i in range(words)), strict=False)))


def fingerprint(text: str, words: int = 3, seed: int = SEED, unique: bool = False) -> int:
    """64-bit SimHash over the shingles of ASCII-blank-separated words, ASCII capitals lower-cased.

    Fewer words than a shingle has: the whole sequence is the one shingle; no word: 0.  A bit is 1 if over half of the
    shingles' XXH64 values have it; repeats count unless ``unique``.
    """
    shingles = _shingles(text, words)
    if not shingles:
        return 0
    if unique:
        shingles = list(set(shingles))
    digest, n = xxhash.xxh64_intdigest, len(shingles)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, CHUNK):
        part = np.fromiter((digest(s, seed) for s in shingles[i : i + CHUNK]), "<u8", min(CHUNK, n - i))
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, kinds: list[dict], *more: str) -> DataFrame:
    """doc_id, the columns ``more`` and a long column f0, f1, ... for each kind: keyword arguments of fingerprint()."""
    source = texts(docs, *more)
    names = ["doc_id", *more]
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in source.schema if f.name in names), *(f"f{i} long" for i in range(len(kinds)))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            whole = batch.column("text").to_pylist()
            found = [pa.array([_signed(fingerprint(t, **kind)) for t in whole], pa.int64()) for kind in kinds]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), *found], names=[*names, *(f"f{i}" for i in range(len(kinds)))])

    bounded(docs.sparkSession)
    return source.mapInArrow(run, schema)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the graph with edges (a, b): each node that isn't the smallest of its component, and that smallest one."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = at[: len(a)], at[len(a) :]
    labels = np.arange(len(nodes))
    while True:
        low = np.minimum(labels[left], labels[right])
        new = labels.copy()
        for side in (left, right, labels[left], labels[right]):
            np.minimum.at(new, side, low)
        new = new[new]
        if (new == labels).all():
            child = np.flatnonzero(labels != np.arange(len(nodes)))
            return nodes[child], nodes[labels[child]]
        labels = new


def bucket_links(members: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest, as positions, of the links among members: unsigned pairs (a, b) that differ in at most ``most`` bits."""
    n = len(members)
    left = right = np.zeros(0, np.int64)
    if n > PAIRWISE and most <= 3 and not members[:, 1].any():
        return _neighbour_links(members[:, 0], most)
    a, b, lone = members[:, 0], members[:, 1], not members[:, 1].any()
    block = max(1, (1 << 22) // n)
    for i in range(0, n, block):
        bits = np.bitwise_count(a[i : i + block, None] ^ a[None, i:])
        if not lone:
            bits = bits + np.bitwise_count(b[i : i + block, None] ^ b[None, i:])
        x, y = np.nonzero(bits <= most)
        keep = x < y
        if keep.any():
            left, right = forest(np.concatenate([left, x[keep] + i]), np.concatenate([right, y[keep] + i]))
    return left, right


def _neighbour_links(x: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of up to three bits in linear space and time in len(x): two values at most three bits apart have a common value
    one bit from one and two from the other; all that stand within one bit of a value are linked to each other, and
    those at two bits to all of them."""
    varying = np.bitwise_or.reduce(x ^ x[0])
    masks = [np.uint64(1 << i) for i in range(64) if int(varying) >> i & 1]
    near = np.concatenate([x, *(x ^ m for m in masks)])
    who = np.tile(np.arange(len(x)), len(masks) + 1)
    order = np.argsort(near, kind="stable")
    near, who = near[order], who[order]
    first = np.concatenate([[True], near[1:] != near[:-1]])
    values, host = near[first], who[first]
    if most == 3:
        left, right = who, host[np.cumsum(first) - 1]
        steps = [masks[i] | masks[j] for i in range(len(masks)) for j in range(i)]
    elif most == 2:
        left, right, steps = who, host[np.cumsum(first) - 1], []
    else:
        values, host, left, right, steps = np.sort(x), np.argsort(x, kind="stable"), np.zeros(0, np.int64), np.zeros(0, np.int64), masks if most else []
    left, right = forest(left, right) if len(left) else (left, right)
    for mask in steps:
        want = x ^ mask
        at = np.minimum(np.searchsorted(values, want), len(values) - 1)
        hit = np.flatnonzero(values[at] == want)
        if len(hit):
            left, right = forest(np.concatenate([left, hit]), np.concatenate([right, host[at[hit]]]))
    return left, right


def _linker(most: int):
    """Rows (key, a, b) in order of key: in each key's run a spanning forest of its links."""

    def linked(keys: np.ndarray, members: np.ndarray) -> pa.RecordBatch | None:
        new = np.concatenate([[True], keys[1:] != keys[:-1]])
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(keys)))
        lefts, rights = [], []
        small = sizes <= 32
        longest = sizes[small].max(initial=1)
        keep = np.repeat(small & (sizes > 1), sizes)
        at = np.flatnonzero(keep)
        k, m = keys[at], members[at]
        for step in range(1, int(longest)):
            hit = np.flatnonzero(k[step:] == k[:-step])
            if not len(hit):
                break
            bits = np.bitwise_count(m[hit] ^ m[hit + step]).sum(axis=1, dtype=np.int64)
            hit = hit[bits <= most]
            lefts.append(at[hit])
            rights.append(at[hit + step])
        for s, n in zip(starts[~small], sizes[~small], strict=True):
            x, y = bucket_links(members[s : s + n], most)
            lefts.append(x + s)
            rights.append(y + s)
        left, right = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (lefts, rights))
        if not len(left):
            return None
        # a fingerprint stands at many places: name places by what stands there
        ends = members[np.concatenate([left, right])]
        if ends[:, 1].any():
            names, same = np.unique(ends, axis=0, return_inverse=True)
        else:
            names, same = np.unique(ends[:, 0], return_inverse=True)
            names = np.stack([names, np.zeros_like(names)], axis=1)
        x, y = forest(same[: len(left)], same[len(left) :])
        names = names.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(v) for v in (names[x, 0], names[x, 1], names[y, 0], names[y, 1])], names=["a1", "b1", "a2", "b2"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size, done = 0, 1 << 17
        for batch in batches:
            if not len(batch):
                continue
            keys = batch.column(0).to_numpy()
            held.append((keys, np.stack([batch.column(i).to_numpy().view(np.uint64) for i in (1, 2)], axis=1)))
            size += len(keys)
            if size < done or held[0][0][0] == keys[-1]:
                continue
            keys, members = (np.concatenate(v) for v in zip(*held, strict=True))
            cut = int(np.searchsorted(keys, keys[-1]))  # the last run may go on
            if out := linked(keys[:cut], members[:cut]):
                yield out
            held, size = [(keys[cut:], members[cut:])], len(keys) - cut
        if held:
            keys, members = (np.concatenate(v) for v in zip(*held, strict=True))
            if out := linked(keys, members):
                yield out

    return run


def _cuts(lanes: int, segments: int) -> list[tuple[int, int, int]]:
    """(lane, first bit, bits) of every segment."""
    bounds = [round(64 * i / segments) for i in range(segments + 1)]
    return [(lane, lo, hi - lo) for lane in range(lanes) for lo, hi in zip(bounds, bounds[1:], strict=False)]


def _value(lane: str, low: int, bits: int) -> Column:
    return F.shiftrightunsigned(lane, low).bitwiseAND(F.lit((1 << bits) - 1).cast("long"))


def _keys(k: int, value: Column, bits: int) -> list[Column]:
    """The value of segment k, once with each of its bits wiped out."""
    return [F.lit((k << 48) | (w << 40)).cast("long").bitwiseOR(value.bitwiseAND(F.lit(((1 << bits) - 1) & ~(1 << w)).cast("long"))) for w in range(bits)]


def links(nodes: DataFrame, lanes: list[str], segments: int, most: int) -> DataFrame:
    """Edges (a1, b1)-(a2, b2) between nodes, distinct pairs (a, b), that differ in at most ``most`` bits: forests (over links, not links themselves) whose union
    connects all that are linked and meet in the index.

    ``lanes``: the columns that are cut into ``segments`` segments each and indexed.  With one lane, a, that is also all that is
    compared (b = 0), two segments and up to three bits, all links are found and no bucket is unbounded: where a segment's
    value has more than HEAVY fingerprints, its buckets are cut along the bytes of the other half, of which one at least is
    equal too.  Such a bucket has 39 of 64 bits fixed, and its links are found in time linear in its size.
    """
    spark = nodes.sparkSession
    cuts = [(k, lanes[lane], low, bits) for k, (lane, low, bits) in enumerate(_cuts(len(lanes), segments))]
    index = nodes.select(F.explode(F.array(*[key for k, lane, low, bits in cuts for key in _keys(k, _value(lane, low, bits), bits)])).alias("key"), "a", "b")

    def run(rows: DataFrame) -> DataFrame:
        return stored(rows.repartition("key").sortWithinPartitions("key").mapInArrow(_linker(most), EDGES), "links")

    if lanes != ["a"] or segments != 2 or most > 3:
        return run(index).distinct()
    segment = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), _value(lane, low, bits).alias("v")) for k, lane, low, bits in cuts]))
    heavy = stored(nodes.select(segment.alias("s")).groupBy("s.k", "s.v").count().where(F.col("count") > HEAVY).select("k", "v"), "heavy")
    if not heavy.take(1):
        return run(index).distinct()
    parts = [heavy.where(F.col("k") == k).select(F.explode(F.array(*_keys(k, F.col("v"), bits))).alias("key")) for k, _, _, bits in cuts]
    heavy_keys = reduce(DataFrame.unionByName, parts).distinct()
    cut = [F.xxhash64("key", F.lit(i), F.expr(f"shiftrightunsigned(a, cast(32 * (1 - shiftright(key, 48)) + {8 * i} as int)) & 255")) for i in range(4)]
    hot = index.join(heavy_keys, "key", "left_semi").select(F.explode(F.array(*cut)).alias("key"), "a", "b")
    return run(index.join(heavy_keys, "key", "left_anti")).unionByName(run(hot)).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): root is the smallest node reachable over edges (x, y); nodes that are their own root are left out.

    Alternating large-star and small-star steps, each an aggregation and an equality join, written to the shared
    folder, until nothing changes: the number of rounds grows with the logarithm of the component size.
    """

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.unionByName(e.select(F.col("y").alias("x"), F.col("x").alias("y"))) if large else e
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        near = both.join(least, "x")
        if large:
            return near.where(F.col("y") > F.col("x")).select(F.col("y").alias("x"), F.col("m").alias("y")).where("x > y").distinct()
        return near.select("x", "y", "m").select(F.explode(F.array(F.struct("x", F.col("m").alias("y")), F.struct(F.col("y").alias("x"), F.col("m").alias("y")))).alias("e")).select("e.x", "e.y").where("x > y").distinct()

    state = lambda e: tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("x", "y"))).first())
    edges = stored(edges.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).where("x > y").distinct(), "edges")
    before = state(edges)
    while before[0]:
        edges = stored(star(star(edges, True), False), "stars")
        if (now := state(edges)) == before:
            break
        before = now
    return edges.select(F.col("x").alias("node"), F.col("y").alias("root"))


def near_duplicates(docs: DataFrame, words: int = 3, most: int = 3, segments: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: the smallest doc_id reachable over links of at most ``most`` bits.

    Exact for most < 2 * segments. Null and empty texts have fingerprint zero and are linked like others; equal texts
    share a component; rows with a null doc_id keep their row (a component of them alone has a null id); an empty table gives no rows.
    """
    if most >= 2 * segments:
        raise ValueError("too few segments: one must differ by at most one bit")
    marks = stored(fingerprints(docs, [{"words": words}]), "fingerprints")
    nodes = marks.groupBy("f0").agg(F.min("doc_id").alias("first"), F.count("*").alias("rows")).select(F.col("f0").alias("a"), F.lit(0).cast("long").alias("b"), "first", "rows")
    nodes = stored(nodes, "nodes")
    roots = components(links(nodes.select("a", "b"), ["a"], segments, most).select(F.col("a1").alias("x"), F.col("a2").alias("y")))
    placed = nodes.join(roots.withColumnRenamed("node", "a"), "a", "left").select("a", "first", "rows", F.coalesce("root", "a").alias("root"))
    least = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    named = stored(placed.join(least, "root").select(F.col("a").alias("f0"), "component_id", "rows"), "named")
    # a fingerprint of a large share of all rows meets them where they are: there are fewer than FEW of these
    common = named.where(F.col("rows") * FEW > marks.count()).select("f0", F.col("component_id").alias("common_id"), F.lit(True).alias("is_common"))
    rows = marks.join(F.broadcast(common), "f0", "left")
    rest = rows.where("is_common IS NULL").join(named.select("f0", "component_id"), "f0").select("doc_id", "f0", "component_id")
    found = rows.where("is_common").select("doc_id", "f0", F.col("common_id").alias("component_id")).unionByName(rest)
    return found.select("doc_id", F.lpad(F.lower(F.hex("f0")), 16, "0").alias("fingerprint"), "component_id")


#: Near copies: sets of so many-word shingles with a Jaccard similarity of SHARE[0] / SHARE[1] or more.
WORDS, SHARE = 5, (4, 5)
#: Counters of the order of shingles: they decide how fast, not what is found.
SLOT_BITS = 18
SLOTS = 1 << SLOT_BITS
#: The sets of a crowd, those with one shingle in their prefixes, are met in turns if they are more than this: first by one of them only (one of
#: VARIANTS, so that most pairs of sets meet the same one under all their shingles), then by the NEAREST of those that they aren't connected with, ROUNDS times, and
#: then by all of these.  All but CROWD are only about how fast what is connected is found.
CROWD, VARIANTS, NEAREST, ROUNDS = 32, 4, 2, 3
#: Bits of a set's parity sketch; two sketches differ in no more bits than the sets have members that aren't shared.
PARITY = 512


def shingle_set(text: str, words: int = WORDS, seed: int = SEED) -> np.ndarray:
    """XXH64 values of the distinct shingles of fingerprint(), as ordered signed integers."""
    shingles = _shingles(text, words)
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(s, seed) for s in shingles), "<u8", len(shingles)).view(np.int64))


def _slot(values: np.ndarray) -> np.ndarray:
    return (values.view(np.uint64) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def slot_counts(docs: DataFrame) -> np.ndarray:
    """How many shingles of all documents fall into each of SLOTS slots: frequent shingles have full ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SLOTS, np.int64)
        for batch in slices(batches):
            for text in batch.column("text").to_pylist():
                np.add.at(counts, _slot(shingle_set(text)), 1)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["slot", "n"])

    bounded(docs.sparkSession)
    found = texts(docs).select("text").mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(SLOTS, np.int64)
    counts[found.column("slot").to_numpy()] = found.column("n").to_numpy()
    return counts


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, arrays)]), pa.int32()), pa.array(np.concatenate([*arrays, np.zeros(0, np.int64)])))


def prefixes(docs: DataFrame, row: str, counts: np.ndarray) -> DataFrame:
    """doc_id, row, f (fingerprint()), a, b (a digest of the shingle set), n (its size), sketch, prefix: as many of its shingles, rarest first, that a set
    similar enough must hold one of them in its own prefix."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            digests, sizes, sketches, firsts, marks = [], [], [], [], []
            for text in batch.column("text").to_pylist():
                marks.append(_signed(fingerprint(text)))
                values = shingle_set(text)
                digests.append(xxhash.xxh3_128_digest(values.tobytes()))
                sizes.append(len(values))
                sketches.append(np.packbits((np.bincount(values & (PARITY - 1), minlength=PARITY) & 1).astype(np.uint8)).tobytes())
                shared = -(-len(values) * SHARE[0] // SHARE[1])
                firsts.append(values[np.lexsort((values, sent.value[_slot(values)]))[: len(values) - shared + 1]])
            both = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            columns = [batch.column("doc_id"), batch.column(row), pa.array(marks, pa.int64()), pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(sizes, pa.int64()), pa.array(sketches, pa.binary()), _lists(firsts)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "row", "f", "a", "b", "n", "sketch", "prefix"])

    bounded(spark)
    return texts(docs, row).mapInArrow(run, "doc_id long, row long, f long, a long, b long, n long, sketch binary, prefix array<long>")


def _may_be_near(n: tuple[np.ndarray, np.ndarray], at: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Of pairs of sets of n members that share the one at place ``at`` of their orders: whether the first shared one can be that.

    Neither set may be too small for the other, and from there on enough members must be left.
    """
    part, whole = SHARE
    return (whole * np.minimum(*n) >= part * np.maximum(*n)) & ((part + whole) * np.minimum(n[0] - at[0], n[1] - at[1]) >= part * (n[0] + n[1]))


def _runs(batches: Iterator[pa.RecordBatch], done: int = 1 << 17) -> Iterator[pa.Table]:
    """Rows in order of ``key``, cut only between keys."""
    held, size = [], 0
    for batch in batches:
        if not len(batch):
            continue
        held.append(batch)
        size += len(batch)
        last = batch.column("key")[-1].as_py()
        if size < done or held[0].column("key")[0].as_py() == last:
            continue
        table = pa.Table.from_batches(held)
        cut = int(np.searchsorted(table.column("key").to_numpy(), last))  # the last run may go on
        yield table.slice(0, cut)
        held, size = table.slice(cut).combine_chunks().to_batches(), len(table) - cut
    if held:
        yield pa.Table.from_batches(held)


def _first_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, row, n, at) in order of key -> pairs (x, y, null, ...) to verify, and the rows of crowded keys with y null."""
    for table in _runs(batches):
        keys, rows, n, at = (table.column(c).to_numpy() for c in ("key", "row", "n", "at"))
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        sizes = np.diff(np.append(starts, len(keys)))
        crowded = np.repeat(sizes > CROWD, sizes)
        lefts, rights = [], []
        free = np.flatnonzero(~crowded & np.repeat(sizes > 1, sizes))
        for step in range(1, CROWD):
            x = np.flatnonzero(keys[free[step:]] == keys[free[:-step]]) if step < len(free) else []
            if not len(x):
                break
            lefts.append(free[x])
            rights.append(free[x + step])
        for first, size in zip(starts[sizes > CROWD], sizes[sizes > CROWD], strict=True):
            members = np.arange(first, first + size)
            drawn = (rows[members].astype(np.uint64) * np.uint64(VARIANTS) + np.uint64(int(keys[first]) % VARIANTS)) * np.uint64(0x9E3779B97F4A7C15)
            lefts.append(np.full(size, members[(drawn ^ (drawn >> np.uint64(31))).argmin()]))
            rights.append(members)
        x, y = (np.concatenate([*v, np.zeros(0, np.int64)]).astype(np.int64) for v in (lefts, rights))
        keep = _may_be_near((n[x], n[y]), (at[x], at[y])) & (rows[x] != rows[y])
        pairs = np.unique(np.sort(np.stack([rows[x[keep]], rows[y[keep]]], axis=1), axis=1), axis=0)
        hot, none = np.flatnonzero(crowded), len(pairs)
        for i in range(0, none, INDEX_ROWS):
            part = pairs[i : i + INDEX_ROWS]
            yield pa.RecordBatch.from_arrays([pa.array(part[:, 0]), pa.array(part[:, 1]), *[pa.nulls(len(part), pa.int64())] * 3], names=["x", "y", "key", "n", "at"])
        for i in range(0, len(hot), INDEX_ROWS):
            part = hot[i : i + INDEX_ROWS]
            yield pa.RecordBatch.from_arrays([pa.array(rows[part]), pa.nulls(len(part), pa.int64()), *[pa.array(v[part]) for v in (keys, n, at)]], names=["x", "y", "key", "n", "at"])


def _crowd_pairs(nearest: int | None):
    """Rows (key, row, n, at, root, sketch) in order of key -> pairs (x, y) of one key and different roots that may be near: all, or for
    each row outside of the key's largest root those with the ``nearest`` least different sketches."""
    part, whole = SHARE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches):
            keys, row, n, at, root = (table.column(c).to_numpy() for c in ("key", "row", "n", "at", "root"))
            sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint64).reshape(-1, PARITY // 64)
            starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            for first, end in zip(starts, np.append(starts[1:], len(keys)), strict=True):
                _, group, sizes = np.unique(root[first:end], return_inverse=True, return_counts=True)
                # the largest group's members last: they aren't compared with each other
                members = first + np.argsort(group == sizes.argmax(), kind="stable")
                others = len(members) - int(sizes.max())
                block = max(1, (1 << 20) // len(members))
                for i in range(0, others, block):
                    x, y = np.meshgrid(np.arange(i, min(i + block, others)), np.arange(i if nearest is None else 0, len(members)), indexing="ij")
                    ahead = x < y if nearest is None else x != y
                    x, y = members[x[ahead]], members[y[ahead]]
                    keep = (root[x] != root[y]) & _may_be_near((n[x], n[y]), (at[x], at[y]))
                    x, y = x[keep], y[keep]
                    unlike = np.bitwise_count(sketch[x] ^ sketch[y]).sum(axis=1, dtype=np.int64)
                    both = n[x] + n[y]
                    keep = unlike <= both - 2 * -(-part * both // (part + whole))
                    x, y, unlike = x[keep], y[keep], unlike[keep]
                    if nearest is not None and len(x):
                        order = np.lexsort((row[y], unlike, x))
                        x, y = x[order], y[order]
                        keep = np.arange(len(x)) - np.searchsorted(x, x) < nearest
                        x, y = x[keep], y[keep]
                    x, y = row[x], row[y]
                    for j in range(0, len(x), INDEX_ROWS):
                        a, b = x[j : j + INDEX_ROWS], y[j : j + INDEX_ROWS]
                        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["x", "y"])

    return run


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (x, y) -> a spanning forest of a task's links."""
    x = y = np.zeros(0, np.int64)
    for batch in batches:
        if len(batch):
            x, y = forest(*(np.concatenate([old, batch.column(c).to_numpy()]) for old, c in ((x, "x"), (y, "y"))))
    yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], names=["x", "y"])


def _verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, row: str, known: DataFrame | None = None) -> DataFrame:
    """Forests over the pairs (x, y) of rows whose shingle sets are similar enough.

    Sketches rule out most other pairs, and those that the links ``known`` connect needn't be looked at; only texts that stand in a
    pair that is left are cut again.
    """
    spark, (part, whole) = docs.sparkSession, SHARE
    pairs = pairs.distinct()
    for side in ("x", "y"):
        pairs = pairs.join(nodes.select(F.col("row").alias(side), F.col("n").alias(f"n{side}"), F.col("sketch").alias(f"s{side}")), side)
    unlike = F.expr(" + ".join(f"bit_count(CAST(conv(hex(substring(sx, {i}, 7)), 16, 10) AS BIGINT) ^ CAST(conv(hex(substring(sy, {i}, 7)), 16, 10) AS BIGINT))" for i in range(1, PARITY // 8 + 1, 7)))
    most = F.expr(f"nx + ny - 2 * (({part} * (nx + ny) + {part + whole - 1}) DIV {part + whole})")
    pairs = stored(pairs.where(unlike <= most).select("x", "y"), "pairs")
    if known is not None:
        roots = components(known)
        for side in ("x", "y"):
            pairs = pairs.join(roots.select(F.col("node").alias(side), F.col("root").alias(f"r{side}")), side, "left")
        pairs = stored(pairs.where(F.coalesce("rx", "x") != F.coalesce("ry", "y")).select("x", "y"), "apart")
    wanted = pairs.select(F.col("x").alias(row)).unionByName(pairs.select(F.col("y").alias(row))).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [shingle_set(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(row), _lists(found)], names=["row", "s"])

    bounded(spark)
    sets = stored(texts(docs, row).join(small_side(wanted), row, "left_semi").select(row, "text").mapInArrow(run, "row long, s array<long>"), "sets")
    both = pairs.join(sets.withColumnsRenamed({"row": "x", "s": "sx"}), "x").join(sets.withColumnsRenamed({"row": "y", "s": "sy"}), "y")
    near = F.size(F.array_intersect("sx", "sy")).cast("long") * (part + whole) >= (F.size("sx").cast("long") + F.size("sy")) * part
    return stored(both.where(near).select("x", "y").mapInArrow(_forests, "x long, y long"), "near")


def marked_pairs(nodes: DataFrame) -> DataFrame:
    """Candidates (x, y) by SimHash: rows of one fingerprint f, and of fingerprints that links() of up to three bits connect; a star or forest each."""
    marks = stored(nodes.groupBy("f").agg(F.min("row").alias("first")), "marks")
    same = nodes.join(marks, "f").where("row <> first").select(F.col("first").alias("x"), F.col("row").alias("y"))
    linked = links(marks.select(F.col("f").alias("a"), F.lit(0).cast("long").alias("b")), ["a"], 2, 3).select("a1", "a2")
    for end, out in (("a1", "p"), ("a2", "q")):
        linked = linked.join(marks.select(F.col("f").alias(end), F.col("first").alias(out)), end)
    return same.unionByName(linked.select(F.least("p", "q").alias("x"), F.greatest("p", "q").alias("y")))


def near_links(nodes: DataFrame, docs: DataFrame, row: str) -> DataFrame:
    """Links (x, y) that connect all rows of ``nodes`` (row, f, n, sketch, prefix; distinct sets) whose similarity reaches SHARE, directly or by others.

    Candidates by SimHash are verified first; pairs that these links connect aren't verified again.  Every similar pair shares a shingle in its prefixes.  Where few do, all pairs are verified.  Where many do, one of them is
    compared with all first, then each with the nearest that it isn't connected with, and at last with all that are still left.
    """
    spark = docs.sparkSession

    def in_order(rows: DataFrame) -> DataFrame:
        return rows.repartition("key").sortWithinPartitions("key")

    index = nodes.select("row", "n", F.posexplode("prefix").alias("at", "key")).select("key", "row", "n", F.col("at").cast("long").alias("at"))
    first = stored(in_order(index).mapInArrow(_first_pairs, "x long, y long, key long, n long, at long"), "first-pairs")
    known = _verified(marked_pairs(nodes), nodes, docs, row)
    near = known.unionByName(_verified(first.where("y IS NOT NULL").select("x", "y"), nodes, docs, row, known))
    crowd = first.where("y IS NULL").select("key", F.col("x").alias("row"), "n", "at")
    if not crowd.take(1):
        return near
    crowd = stored(crowd.join(nodes.select("row", "sketch"), "row"), "crowd")
    turns: list[int | None] = [*[NEAREST] * ROUNDS, None]
    while turns:
        nearest = turns.pop(0)
        roots = components(near).withColumnRenamed("node", "row")
        apart = crowd.join(roots, "row", "left").select("key", "row", "n", "at", F.coalesce("root", "row").alias("root"), "sketch")
        pairs = stored(in_order(apart).mapInArrow(_crowd_pairs(nearest), "x long, y long"), "crowd-pairs")
        if not pairs.take(1):
            return near
        more = _verified(pairs, nodes, docs, row)
        if nearest is None or more.take(1):
            near = near.unionByName(more)
        else:
            turns = [None]
    return near


def keep_one(docs: DataFrame) -> DataFrame:
    """Documents without near copies: of each group that links of Jaccard similarity 0.8 or more over five-word shingles connect, one row stays.

    Exact: SimHash gives the first candidates, a prefix filter misses no pair of the rest, and every link is verified on the sets of shingles (repeats don't count).  Equal
    texts are one group, however short, and so are all texts without a word (null counts as empty).  The row with the smallest
    doc_id stays, a null doc_id last; of repeated rows one stays.  Columns and their values are those of docs, whatever their names.
    """
    row = "_row"
    while row in docs.columns:
        row += "_"
    whole = stored(docs.withColumn(row, F.monotonically_increasing_id()), "near-in")
    marks = stored(prefixes(whole, row, slot_counts(whole)), "prefixes")
    best = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("best")
    nodes = stored(marks.groupBy("a", "b").agg(F.min("row").alias("first"), best), "nodes")
    distinct = marks.join(nodes.select(F.col("first").alias("row")), "row", "left_semi")
    roots = components(near_links(distinct, whole, row))
    placed = nodes.join(roots.withColumnRenamed("node", "first"), "first", "left").select(F.coalesce("root", "first").alias("root"), "best")
    stay = placed.groupBy("root").agg(F.min("best").alias("best")).select(F.col("best.row").alias(row))
    return whole.join(stay, row, "left_semi").select(*[whole[f"`{c}`"] for c in docs.columns])
