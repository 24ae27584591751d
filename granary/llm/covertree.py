"""Exact top-k inner products by dual-tree search over cover trees.

Candidates are dealt to cells around the top nodes of a cover tree over a sample, cut into blocks of bounded size within a
cell, and each block is indexed once, in a cover tree that is written down.  Queries are indexed in a cover tree of their own
and both trees are walked together: a pair of nodes is pruned when the largest inner product that centres, covering radii and
norms allow is below the worst kth score of the query node's queries.  Walks come in rounds: every one begins with the kth scores
that the rounds before have found anywhere.  Scores are integers, so results don't depend on the order of the walk.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded, stored

SCALE = 1024
#: Members of a leaf, candidates in a block, queries that are compared at a time, candidates likewise (first FEW, then twice as many each time).
LEAF, BLOCK, ROWS, FEW, POINTS = 48, 4096, 512, 64, 4096
#: Bytes of the vectors of queries that are sent to all tasks at once.
SENT = 64 << 20
#: Vectors that the cells are made of, and the most cells of a dimension: they decide how fast, not what is found.
SAMPLE, CELLS = 4096, 256
#: Components from here on are whole numbers anyway.
WHOLE = float(1 << 53)


class CoverTree:
    """Points in the order of the tree, nodes in arrays: a node's descendants are points[first:last], all within ``radius`` of its centre.

    A node of covering distance c has children of covering distance c / 2 whose centres, points of the set, are further than that
    from each other; nodes of at most ``leaf`` points are leaves, and so are nodes of equal points. A node's children stand one after
    the other, leaves first.
    """

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        points = np.asarray(points, np.float64)
        self.order = np.arange(len(points))
        self.leaves: list[int] = []  # how many of a node's children are leaves
        centre, radius, first, last, child, children = [], [], [], [], [], []

        def node(members: np.ndarray, own: int, far: np.ndarray, at: int) -> None:
            for column, value in ((centre, own), (radius, float(far.max())), (first, at), (last, at + len(members)), (child, 0), (children, 0), (self.leaves, 0)):
                column.append(value)
            held.append(members)

        held: list[np.ndarray | None] = []
        if len(points):
            everyone = np.arange(len(points))
            node(everyone, 0, self._far(points, everyone, 0), 0)
        i = 0
        while i < len(held):
            members, held[i] = held[i], None
            if len(members) <= leaf or radius[i] == 0:
                self.order[first[i] : last[i]] = members
            else:
                groups = self._split(points, members, centre[i], radius[i] / 2)
                groups.sort(key=lambda g: len(g[0]) > leaf and g[2].max() > 0)
                child[i], children[i], at = len(held), len(groups), first[i]
                self.leaves[i] = sum(len(g[0]) <= leaf or g[2].max() == 0 for g in groups)
                for own, chosen, far in groups:
                    node(own, chosen, far, at)
                    at += len(own)
            i += 1
        self.points = points[self.order]
        self.centres, self.radius = points[np.array(centre, int)], np.array(radius)
        self.first, self.last, self.child, self.children, self.leaves = (np.array(x, np.int64) for x in (first, last, child, children, self.leaves))
        own = np.sqrt(np.einsum("ij,ij->i", self.points, self.points))
        self.norm = np.sqrt(np.einsum("ij,ij->i", self.centres, self.centres))
        self.largest = np.array([own[a:b].max() for a, b in zip(self.first, self.last, strict=True)])

    @staticmethod
    def _far(points: np.ndarray, members: np.ndarray, centre: int) -> np.ndarray:
        d = points[members] - points[centre]
        return np.sqrt(np.einsum("ij,ij->i", d, d))

    def _split(self, points: np.ndarray, members: np.ndarray, centre: int, cover: float) -> list[tuple[np.ndarray, int, np.ndarray]]:
        groups, left, chosen = [], members, centre  # the node's own point is its first child
        while len(left):
            far = self._far(points, left, chosen)
            near = far <= cover
            groups.append((left[near], chosen, far[near]))
            left = left[~near]
            chosen = int(left[0]) if len(left) else -1
        return groups

    def below(self, nodes: np.ndarray) -> np.ndarray:
        """The nodes that are leaves, and the children of the others."""
        inner = self.children[nodes] > 0
        parts = [np.arange(self.child[n], self.child[n] + self.children[n]) for n in nodes[inner]]
        return np.concatenate([nodes[~inner], *parts])

    def cut(self, most: int) -> np.ndarray:
        """Centres of at most ``most`` nodes that cover all: the widest is opened again and again while there is room."""
        nodes = [0] if len(self.radius) else []
        while inner := [n for n in nodes if self.children[n]]:
            widest = max(inner, key=lambda n: (self.radius[n], -n))
            if len(nodes) - 1 + self.children[widest] > most:
                break
            nodes.remove(widest)
            nodes += range(self.child[widest], self.child[widest] + self.children[widest])
        return self.centres[sorted(nodes)]


def _exact(a: np.ndarray, b: np.ndarray, own: np.ndarray | bool = False) -> np.ndarray:
    """Integer inner products of all rows, but for ``own`` pairs: in doubles where those are exact, else in 64-bit integers, else in unbounded ones."""
    size = max(float(np.abs(a).max(initial=0)), 1.0) * max(float(np.abs(b).max(initial=0)), 1.0) * max(a.shape[1], 1)
    if size < WHOLE:
        return (a @ b.T).astype(np.int64)
    if size < 1 << 62 and max(np.abs(a).max(initial=0), np.abs(b).max(initial=0)) < 1 << 62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    large = [[int(x) for x in row] for row in b.tolist()]
    out = np.array([[sum(x * y for x, y in zip(map(int, row), other, strict=True)) for other in large] for row in a.tolist()], object)
    out[np.broadcast_to(own, out.shape)] = 0
    if any(abs(int(x)) >= 1 << 63 for x in out.ravel()):
        raise OverflowError("an inner product goes beyond 64 bits")
    return out.astype(np.int64)


class Search:
    """The k best of all candidates seen so far for each query of a tree: highest score, then smallest id.

    ``least``: a score of each query (in the order of ids) that its kth result is known to reach.  pairs and pruned count pairs of a query node,
    or a query of a leaf, with a candidate node.
    """

    NONE = np.iinfo(np.int64).min

    def __init__(self, tree: CoverTree, ids: np.ndarray, k: int, least: np.ndarray | None = None):
        self.tree, self.ids, self.k = tree, np.asarray(ids)[tree.order], k
        self.scores = np.full((len(ids), k), self.NONE)
        self.found = np.zeros((len(ids), k), np.int64)
        self.least = np.full(len(ids), self.NONE) if least is None else np.asarray(least)[tree.order]
        self.pairs = self.pruned = self.compared = 0

    def add(self, c: CoverTree, ids: np.ndarray) -> None:
        """Walk the tree of queries with a tree of candidates; ids in the order that c was made of."""
        if len(c.radius) and len(self.tree.radius):
            self._visit(0, np.zeros(1, np.int64), c, np.asarray(ids)[c.order])

    def _bounds(self, centres: np.ndarray, norm: np.ndarray, radius: np.ndarray, largest: np.ndarray, c: CoverTree, nodes: np.ndarray) -> np.ndarray:
        """The largest inner product of each query node with each candidate node: the least of three bounds, a little more for rounding."""
        dot = centres @ c.centres[nodes].T
        norm, radius, largest = norm[:, None], radius[:, None], largest[:, None]
        n, r, m = c.norm[nodes], c.radius[nodes], c.largest[nodes]
        # by centres and radii; by norms; by the smallest distance, as a.b = (a.a + b.b - |a - b|^2) / 2
        gap = np.maximum(0, np.sqrt(np.maximum(0, norm * norm + n * n - 2 * dot)) * (1 - 1e-9) - 1e-6 * (norm + n) - radius - r)
        squares = largest * largest + m * m
        bound = np.minimum(np.minimum(dot + norm * r + n * radius + radius * r, largest * m), (squares - gap * gap) / 2)
        return bound + 1e-9 * squares + 0.5

    def _worst(self, first: int, last: int) -> np.ndarray:
        return np.maximum(self.scores[first:last, -1], self.least[first:last])

    def _visit(self, q: int, nodes: np.ndarray, c: CoverTree, ids: np.ndarray) -> None:
        t = self.tree
        while True:
            bound = self._bounds(t.centres[q : q + 1], t.norm[q : q + 1], t.radius[q : q + 1], t.largest[q : q + 1], c, nodes)[0]
            alive = bound >= float(self._worst(t.first[q], t.last[q]).min())
            self.pairs += len(nodes)
            self.pruned += int((~alive).sum())
            nodes = nodes[alive]
            if not len(nodes):
                return
            inner = c.children[nodes] > 0
            if not t.children[q] or not inner.any() or c.radius[nodes[inner]].max() <= t.radius[q]:
                break
            nodes = c.below(nodes)
        if not t.children[q]:
            self._leaf(t.first[q], t.last[q], nodes, c, ids)
            return
        at, leaves = t.child[q], t.leaves[q]
        if leaves:
            self._leaf(t.first[at], t.last[at + leaves - 1], nodes, c, ids)
        for x in range(at + leaves, at + t.children[q]):
            self._visit(x, nodes, c, ids)

    def _leaf(self, first: int, last: int, nodes: np.ndarray, c: CoverTree, ids: np.ndarray) -> None:
        """Queries first to last, each with a bound of its own, down to the candidates' leaves and their points."""
        for first in range(first, last, ROWS):
            own = slice(first, min(first + ROWS, last))
            points, here = self.tree.points[own], nodes
            norm = np.sqrt(np.einsum("ij,ij->i", points, points))
            while len(here):
                bound = self._bounds(points, norm, np.zeros(len(points)), norm, c, here)
                alive = bound >= self._worst(own.start, own.stop)[:, None]
                self.pairs += bound.size
                self.pruned += bound.size - int(alive.sum())
                some = alive.any(axis=0)
                here, bound, was = here[some], bound[:, some], alive[:, some]
                if not (c.children[here] > 0).any():
                    break
                here = c.below(here)
            if not len(here):
                continue
            # the most promising leaves first, so that kth scores rise before the rest
            order = np.argsort(-bound.max(axis=0), kind="stable")
            here, bound, was = here[order], bound[:, order], was[:, order]
            ends = np.cumsum(c.last[here] - c.first[here])
            at, step = 0, FEW
            while at < len(here):
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + step, "right")))
                alive = bound[:, at:to] >= self._worst(own.start, own.stop)[:, None]
                self.pruned += int((was[:, at:to] & ~alive).sum())
                there = here[at:to][alive.any(axis=0)]
                step = min(2 * step, POINTS)
                if len(there):
                    rows = np.concatenate([np.arange(a, b) for a, b in zip(c.first[there], c.last[there], strict=True)])
                    for i in range(0, len(rows), POINTS):
                        self._compare(own, c.points[rows[i : i + POINTS]], ids[rows[i : i + POINTS]])
                at = to

    def _compare(self, own: slice, points: np.ndarray, ids: np.ndarray) -> None:
        self.compared += int(own.stop - own.start) * len(ids)
        same = self.ids[own, None] == ids[None, :]
        scores, least = _exact(self.tree.points[own], points, same), self._worst(own.start, own.stop)
        scores[same] = self.NONE
        if len(ids) > self.k:
            least = np.maximum(least, np.partition(scores, len(ids) - self.k, axis=1)[:, len(ids) - self.k])
        row, column = np.nonzero((scores >= least[:, None]) & (scores > self.NONE))
        if not len(row):
            return
        there = np.nonzero(self.scores[own] > self.NONE)
        rows = np.concatenate([row, there[0]])
        values = np.concatenate([scores[row, column], self.scores[own][there]])
        names = np.concatenate([ids[column], self.found[own][there]])
        order = np.lexsort((names, -values, rows))
        rows = rows[order]
        rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
        order, rows, rank = order[rank < self.k], rows[rank < self.k], rank[rank < self.k]
        self.scores[own.start + rows, rank] = values[order]
        self.found[own.start + rows, rank] = names[order]

    def results(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query id, id, score), only of what was found."""
        there = self.scores > self.NONE
        return np.repeat(self.ids, there.sum(axis=1)), self.found[there], self.scores[there]


def whole_vectors(table: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, v: components as floor(scale * x), whole numbers as doubles. Rows with a null id or vector, or a component that is null or
    not finite, take no part; a finite component that isn't finite when scaled is an error."""
    x = f"{scale}D * CAST(x AS DOUBLE)"
    part = f"CASE WHEN isnan(x) OR abs(CAST(x AS DOUBLE)) = CAST('Infinity' AS DOUBLE) THEN NULL WHEN abs({x}) = CAST('Infinity' AS DOUBLE) THEN CAST(raise_error('a component is too large') AS DOUBLE) WHEN abs({x}) >= {WHOLE:.0f}D THEN {x} ELSE CAST(floor({x}) AS DOUBLE) END"
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.expr(f"transform(embedding, x -> {part})").alias("v"))
    return rows.where("vec_id IS NOT NULL AND v IS NOT NULL AND NOT exists(v, x -> x IS NULL)")


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, vectors, places) of each dimension in a batch of vec_id, v."""
    ids, lists = batch.column("vec_id").to_numpy(), batch.column("v")
    sizes = np.diff(lists.offsets.to_numpy())
    values = lists.flatten().to_numpy()
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        yield ids[at], values[starts[at][:, None] + np.arange(size)], at


def _by_size(rows: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """A bounded table of vectors on the driver: (ids, vectors) of each dimension."""
    found: dict[int, list] = {}
    for batch in rows.select("vec_id", "v").toArrow().combine_chunks().to_batches():
        for ids, vectors, _ in _matrices(batch):
            found.setdefault(vectors.shape[1], []).append((ids, vectors))
    return {size: tuple(np.concatenate(x) for x in zip(*parts, strict=True)) for size, parts in found.items()}


def indexed(candidates: DataFrame, sample: dict[int, tuple[np.ndarray, np.ndarray]], block: int = BLOCK, cells: int = CELLS) -> DataFrame:
    """size, cell, part, tree: every candidate in one block of its cell, a block's ids and cover tree written down.

    One shuffle of the vectors; a cell is cut by counts into parts of about ``block`` rows, copies of a vector like others.
    """
    spark = candidates.sparkSession
    sent = spark.sparkContext.broadcast({size: CoverTree(vectors).cut(cells) for size, (_, vectors) in sample.items()})

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, cell = np.zeros(len(batch), np.int32), np.zeros(len(batch), np.int32)
            for _, vectors, at in _matrices(batch):
                sizes[at] = vectors.shape[1]
                pivots = sent.value.get(vectors.shape[1])
                if pivots is not None and len(pivots) > 1:
                    far = (pivots * pivots).sum(axis=1) - 2 * (vectors @ pivots.T)
                    cell[at] = far.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(sizes), pa.array(cell), batch.column("vec_id"), batch.column("v")], names=["size", "cell", "vec_id", "v"])

    def build(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        (ids, vectors, _), *_ = _matrices(group.to_batches()[0])
        tree = pickle.dumps((ids, CoverTree(vectors)), protocol=5)
        return pa.table({c: group.column(c)[:1] for c in ("size", "cell", "part")} | {"tree": pa.array([tree], pa.binary())})

    rows = stored(candidates.select("vec_id", "v").mapInArrow(assign, "size int, cell int, vec_id long, v array<double>").withColumn("row", F.monotonically_increasing_id()), "cells")
    counts = rows.groupBy("size", "cell").agg(F.ceil(F.count("*") / block).alias("parts"))  # as many rows as there are cells
    parted = rows.join(F.broadcast(counts), ["size", "cell"]).select("size", "cell", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int").alias("part"), "vec_id", "v")
    return stored(parted.groupBy("size", "cell", "part").applyInArrow(build, "size int, cell int, part int, tree binary"), "trees")


def _walk(blocks: DataFrame, trees: dict[int, tuple[CoverTree, np.ndarray]], least: dict[int, np.ndarray], k: int) -> DataFrame:
    """query_id, vec_id, score: each task's k best of what can be among all the best; a row without query_id has pairs, pruned, compared."""
    sent = blocks.sparkSession.sparkContext.broadcast((trees, least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, least = sent.value
        searches = {size: Search(tree, ids, k, least[size]) for size, (tree, ids) in trees.items()}
        for batch in batches:
            for size, tree in zip(batch.column("size").to_pylist(), batch.column("tree"), strict=True):
                if size in searches:
                    ids, candidates = pickle.loads(tree.as_buffer())
                    searches[size].add(candidates, ids)
        names, kinds = ["query_id", "vec_id", "score", "pairs", "pruned", "compared"], [pa.int64()] * 6
        for search in searches.values():
            columns = search.results()
            for i in range(0, len(columns[0]), 10_000):
                part = [pa.array(c[i : i + 10_000]) for c in columns]
                yield pa.RecordBatch.from_arrays([*part, *[pa.nulls(len(part[0]), pa.int64())] * 3], names=names)
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((None, None, None, search.pairs, search.pruned, search.compared), kinds, strict=True)], names=names)

    return stored(blocks.select("size", "tree").mapInArrow(run, "query_id long, vec_id long, score long, pairs long, pruned long, compared long"), "walk")


def walks(candidates: DataFrame, queries: DataFrame, k: int = 10, block: int = BLOCK, most: int | None = None) -> list[DataFrame]:
    """The stored tables of _walk() that hold every query's k best candidates and the counts of pairs.

    Queries go in passes of at most ``most`` (by a checked count; else what SENT bytes hold), candidates in two rounds: the first part of each cell, then
    the others, which are met with the kth scores found so far.
    """
    spark = candidates.sparkSession
    bounded(spark)
    # of queries with one id the smallest vector counts
    queries = stored(queries.groupBy("vec_id").agg(F.min("v").alias("v")), "queries")
    count, longest = queries.agg(F.count("*"), F.max(F.size("v"))).first()
    total = candidates.count()
    if not count or not total:
        return []
    most = most or max(1, SENT // (8 * max(longest, 1)))
    share = F.pmod(F.xxhash64("vec_id", "v"), F.lit(1 << 20)) < min(1 << 20, (2 * SAMPLE << 20) // total + 1)
    sample = _by_size(candidates.where(share).limit(SAMPLE))
    blocks = indexed(candidates, sample, block)
    passes = -(-count // max(1, most // 2)) if count > most else 1
    while passes > 1 and (queries.groupBy(F.pmod(F.xxhash64("vec_id"), F.lit(passes))).count().agg(F.max("count")).first()[0] or 0) > most:
        passes *= 2
    out = []
    for number in range(passes):
        trees = {size: (CoverTree(vectors), ids) for size, (ids, vectors) in _by_size(queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(passes)) == number)).items()}
        least = {size: np.full(len(ids), Search.NONE) for size, (_, ids) in trees.items()}
        found = _walk(blocks.where("part = 0"), trees, least, k)
        out.append(found)
        if blocks.where("part > 0").limit(1).count():
            worst = _best(found, k).where(F.col("rank") == k).select("query_id", "score").toArrow()  # a number for each query of the pass
            known = dict(zip(worst.column(0).to_pylist(), worst.column(1).to_pylist(), strict=True))
            least = {size: np.array([known.get(i, Search.NONE) for i in ids.tolist()], np.int64) for size, (_, ids) in trees.items()}
            out.append(_walk(blocks.where("part > 0"), trees, least, k))
    return out


def _best(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.where("query_id IS NOT NULL").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _all(parts: list[DataFrame]) -> DataFrame:
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 10, block: int = BLOCK, most: int | None = None) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k best candidates (all, if fewer), ties to the smaller vec_id.

    Both tables as of whole_vectors().  A candidate with the query's id is the query itself; of queries with one id the
    smallest vector counts; vectors only meet those of their own length; candidates that are there twice are found twice; empty tables
    give no rows; a score beyond 64 bits is an error. A task holds a pass of queries and one block, and gives back at most k rows a query.
    """
    parts = walks(candidates, queries, k, block, most)
    if not parts:
        return candidates.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return _best(_all(parts), k)


def pruning(parts: list[DataFrame]) -> dict[str, int]:
    """Of walks(): pairs of nodes that were met and those of them that were pruned, and pairs of a query and a candidate that were compared."""
    return _all(parts).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("pairs", "pruned", "compared")]).first().asDict()
