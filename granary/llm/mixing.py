"""Mixing sources to target weights by temperature.

A source's weight is its token share to the power alpha, normalised; alpha is found by bisection, so that the weights' entropy
reaches a target share of the highest and no source is repeated more often than a limit allows.  The weights are realised
as epochs: in each, a source's documents stand in a block permutation (blocks by hash, in an order that is
drawn anew in each epoch, documents within a block likewise); whole epochs come first and the last one is cut where the source's
token budget ends.  Membership is a function of a row, its block and a few numbers of its source, so texts never move.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Share of the highest entropy to reach; most epochs of a source; documents in a block, on average; sources that may be told apart.
ENTROPY, REPEATS, BLOCK, MOST_SOURCES = 0.95, 4.0, 1024, 100_000
SEED = 20_240_501


def weights(tokens: list[float], alpha: float) -> list[float]:
    """Shares to the power alpha, normalised; sources without tokens get 0."""
    total = sum(tokens)
    raw = [(t / total) ** alpha if t else 0.0 for t in tokens]
    return [r / sum(raw) for r in raw]


def entropy(w: list[float]) -> float:
    return -sum(x * math.log(x) for x in w if x)


def whole_budget(tokens: list[float], w: list[float]) -> float:
    """The smallest budget of tokens at which every source is used whole at least once."""
    return max(t / x for t, x in zip(tokens, w, strict=True) if t)


def exponent(tokens: list[float], share: float = ENTROPY, repeats: float = REPEATS, budget: float | None = None) -> float:
    """The largest alpha in [0, 1] whose weights reach the share of the highest entropy, or the smallest that keeps to the limit
    of repeats where that is larger.  Entropy falls and repeats fall as alpha grows, so either is bisected."""
    live = [t for t in tokens if t]
    if len(live) < 2:
        return 1.0

    def most_repeats(alpha: float) -> float:
        w = weights(live, alpha)
        b = whole_budget(live, w) if budget is None else budget
        return max(x * b / t for x, t in zip(w, live, strict=True))

    def edge(ok, low: float, high: float) -> float:
        """ok holds at low and fails at high; the edge between them, on low's side."""
        for _ in range(60):
            middle = (low + high) / 2
            low, high = (middle, high) if ok(middle) else (low, middle)
        return low

    wanted = share * math.log(len(live)) - 1e-12
    even = lambda a: entropy(weights(live, a)) >= wanted
    within = lambda a: most_repeats(a) <= repeats + 1e-12
    alpha = 1.0 if even(1.0) else edge(even, 0.0, 1.0)
    if not within(alpha):
        alpha = edge(within, 1.0, alpha) if within(1.0) else 1.0
    return alpha


def _key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("null"))


def _order(row: dict[str, Column], epoch: Column) -> tuple[Column, Column]:
    """Places of a row's block among its source's blocks, and of the row in its block, in an epoch."""
    return F.struct(F.xxhash64(F.lit(SEED), epoch, row["key"], row["block"]).alias("h"), row["block"].alias("b")), F.struct(F.xxhash64(F.lit(SEED), epoch, row["mark"]).alias("h"), row["mark"].alias("m"))


def tokens_of(text: Column) -> Column:
    """Blank-separated words, the unit of all budgets here."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _summed(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """rows with ``before``: the sum of value over the rows of their group that stand before them in ``outer``.

    A group may hold most of all rows, so it is cut at ranges of the hash that it is ordered by: sums run within a range, and over the ranges' totals.
    """
    ranged = rows.withColumn("range", F.shiftright(F.col("outer.h"), 52))
    here = [*by, "range"]
    totals = ranged.groupBy(*here).agg(F.sum(value).alias("total"))
    ahead = Window.partitionBy(*by).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*here, F.coalesce(F.sum("total").over(ahead), F.lit(0)).alias("ahead"))
    within = Window.partitionBy(*here).orderBy("outer").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("inside", F.coalesce(F.sum(value).over(within), F.lit(0)))
    return placed.join(totals, here).withColumn("before", F.col("ahead") + F.col("inside")).drop("range", "ahead", "inside")


class Mixture:
    """Weights, epochs and cuts of the sources of docs (columns doc_id, text, source).

    A null source is one source.  Only a row for each source reaches the driver, and goes back to all tasks: at most MOST_SOURCES.
    """

    def __init__(self, docs: DataFrame, share: float = ENTROPY, repeats: float = REPEATS, budget: float | None = None, block: int = BLOCK):
        self.spark = docs.sparkSession
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), _key(F.col("source")).alias("key"), F.xxhash64("doc_id", "text").alias("mark"), tokens_of(F.col("text")).alias("n_tokens"))
        self.rows = stored(rows, "tokens")
        sources = self.rows.groupBy("key").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs")).orderBy("key").limit(MOST_SOURCES + 1).collect()
        if len(sources) > MOST_SOURCES:
            raise ValueError(f"more than {MOST_SOURCES} sources")
        tokens = [float(s["tokens"]) for s in sources]
        self.alpha = exponent(tokens, share, repeats, budget) if any(tokens) else 1.0
        w = weights(tokens, self.alpha) if any(tokens) else [0.0] * len(tokens)
        total = (whole_budget(tokens, w) if budget is None else budget) if any(tokens) else 0.0
        table = []
        for s, x, t in zip(sources, w, tokens, strict=True):
            # a source without tokens costs nothing and is there once
            whole = int(math.floor(x * total / t + 1e-9)) if t else 1
            table.append((s["key"], x, s["tokens"], -(-s["docs"] // block), whole, max(0, int(math.floor(x * total - whole * t + 1e-6)))))
        self.sources = self.spark.createDataFrame(table, "key string, weight double, tokens long, blocks long, whole int, rest long")
        self.placed = self._placed(self.rows, self.sources)
        self.blocks = stored(self.placed.groupBy("key", "block", "whole", "rest").agg(F.sum("n_tokens").alias("n")), "blocks")
        self.cuts = stored(self._cut(), "cuts")

    @staticmethod
    def _placed(rows: DataFrame, sources: DataFrame) -> DataFrame:
        return rows.join(F.broadcast(sources), "key").withColumn("block", F.pmod("mark", "blocks"))

    def _cut(self) -> DataFrame:
        """For each source the first block that doesn't fit whole into its last epoch, and the last row there that does."""
        partial = self.placed.where("rest > 0")
        row = {k: F.col(k) for k in ("key", "block", "mark")}
        outer, inner = _order(row, F.col("whole"))
        ends = _summed(self.blocks.where("rest > 0").withColumn("outer", outer), ["key"], "n").where("before + n > rest")
        first = ends.groupBy("key").agg(F.min(F.struct("outer", "block", F.col("before").alias("start"))).alias("x")).select("key", "x.*")
        inside = partial.join(F.broadcast(first), ["key", "block"]).withColumn("inner", inner)
        within = Window.partitionBy("key").orderBy("inner").rowsBetween(Window.unboundedPreceding, 0)
        kept = inside.withColumn("end", F.col("start") + F.sum("n_tokens").over(within)).where("end <= rest").groupBy("key").agg(F.max("inner").alias("last"))
        return first.select("key", "outer").join(kept, "key", "left")

    def _copies(self, placed: DataFrame) -> DataFrame:
        """With ``epochs``: how many epochs a row is in; always the first ones."""
        outer, inner = _order({k: F.col(k) for k in ("key", "block", "mark")}, F.col("whole"))
        cuts = F.broadcast(self.cuts.select("key", F.col("outer").alias("cut_block"), F.col("last").alias("cut_row")))
        there = placed.join(cuts, "key", "left").withColumn("outer", outer).withColumn("inner", inner)
        last = (F.col("rest") > 0) & (F.col("cut_block").isNull() | (F.col("outer") < F.col("cut_block")) | ((F.col("outer") == F.col("cut_block")) & F.coalesce(F.col("inner") <= F.col("cut_row"), F.lit(False))))
        return there.withColumn("epochs", F.col("whole") + F.coalesce(last, F.lit(False)).cast("int"))

    def schedule(self) -> DataFrame:
        """doc_id, source, weight, n_tokens, epoch (from 0), block, start: a row for each time that a document is used; start is its
        first token's place in its source's stream."""
        used = self._copies(self.placed).select("doc_id", "source", "key", "mark", "block", "weight", "tokens", "n_tokens", F.explode(F.expr("IF(epochs > 0, sequence(0, epochs - 1), array())")).alias("epoch"))
        outer, inner = _order({k: F.col(k) for k in ("key", "block", "mark")}, F.col("epoch"))
        blocks = self.blocks.withColumn("epoch", F.explode(F.expr("sequence(0, whole)"))).withColumn("outer", outer)
        starts = _summed(blocks, ["key", "epoch"], "n").select("key", "block", "epoch", F.col("before").alias("block_start"))
        within = Window.partitionBy("key", "block", "epoch").orderBy("inner").rowsBetween(Window.unboundedPreceding, -1)
        placed = used.withColumn("inner", inner).withColumn("inside", F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).join(starts, ["key", "block", "epoch"])
        return placed.select("doc_id", "source", "weight", "n_tokens", "epoch", "block", (F.col("epoch") * F.col("tokens") + F.col("block_start") + F.col("inside")).alias("start"))

    def apply(self, docs: DataFrame) -> DataFrame:
        """The rows of docs, each as often as it is in an epoch; columns as they are. No shuffle of texts."""
        columns = docs.columns
        inner = F.struct(*[docs[f"`{c}`"].alias(c) for c in columns]).alias("whole_row")
        rows = docs.select(inner, _key(docs["source"]).alias("key"), F.xxhash64(docs["doc_id"], docs["text"]).alias("mark"))
        used = self._copies(self._placed(rows, self.sources)).select("whole_row", F.explode(F.expr("IF(epochs > 0, array_repeat(0, epochs), array())")))
        return used.select(*[F.col("whole_row").getField(c).alias(c) for c in columns])


def schedule(docs: DataFrame, share: float = ENTROPY, repeats: float = REPEATS, budget: float | None = None) -> DataFrame:
    """The mixture's schedule over docs.

    Tokens are blank-separated words; without a budget the smallest one that uses every document at least once.  Null and empty
    texts have no tokens and stand wherever their hash puts them; equal rows are told apart by nothing and each scheduled
    alike; an empty table gives no rows.
    """
    return Mixture(docs, share, repeats, budget).schedule()


def mixed(docs: DataFrame, share: float = ENTROPY, repeats: float = REPEATS, budget: float | None = None) -> DataFrame:
    """docs, each row as often as the schedule has it."""
    return Mixture(docs, share, repeats, budget).apply(docs)
