"""Severity of toxic text by cumulative-link (proportional-odds) ordinal regression.

P(grade > k | x) = sigmoid(w.x - t_k): one weight vector, shared by all thresholds t_0 <= t_1 <= t_2, over sparse word features.
The labels say only toxic or not, so grades above zero are first made from the training rows themselves: by how many
distinct words that stand almost only in toxic rows a toxic row has.  What is rejected has a probability of grade 1 or more
of over one half.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, slices, stored, texts

#: Grades: 0 none, 1 mild, 2 strong, 3 severe; a toxic row's is 1 + the number of these counts that its telling words exceed.
STEPS = (1, 4)
GRADES = len(STEPS) + 2
#: Labelled rows of each class that the fit may use at most: those with the smallest hash of doc_id.
SAMPLE = 6_000
#: Hashed feature space, and how many features with the most evidence either way keep a weight.
SPACE = 1 << 20
KEEP = 20_000
#: Standard errors that a feature's shares in the two classes must be apart.
LEAST = 4.0
_WORD = re.compile(r"[^\W\d_]+")


#: A mark is dense where it makes up at least one in so many words of its text.
DENSE = 200


def features(text: str) -> np.ndarray:
    """Hashed features of a whole text, case ignored: its words and their beginnings of four and of six letters, and each of
    these again where it is dense, so that a chance word in a very long text isn't a steady stream of it."""
    words = _WORD.findall(text.lower())
    counts = Counter(words)
    starts: dict[str, int] = {}
    for w, k in counts.items():
        if len(w) > 4:
            s = w[:4] + "~"
            starts[s] = starts.get(s, 0) + k
            if len(w) > 6:
                s = w[:6] + "~"
                starts[s] = starts.get(s, 0) + k
    counts.update(starts)
    least = len(words) / DENSE
    digest = xxhash.xxh32_intdigest
    return np.unique(np.array([digest(m) % SPACE for m in counts] + [digest(m, 1) % SPACE for m, k in counts.items() if k >= least], np.int32))


@dataclass
class Ordinal:
    """Weights of the kept features (``names`` ascending) and thresholds."""

    names: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, value: float) -> np.ndarray:
        """P(grade > k) for each threshold."""
        return 1 / (1 + np.exp(-np.clip(value - self.thresholds, -500, 500)))


def fit(names: np.ndarray, marks: np.ndarray, sizes: np.ndarray, toxic: np.ndarray, telling: np.ndarray, rounds: int = 300, rate: float = 0.3, ridge: float = 1e-3) -> Ordinal:
    """Maximum likelihood with a ridge on the weights, by full-batch adaptive gradient steps; without both classes nothing is rejected.

    names: the features that can have a weight, ascending; marks: the rows' features among them in turn; sizes: how many each row has;
    telling: how many telling words each row has.
    """
    toxic, n = np.asarray(toxic, bool), len(sizes)
    if not n or toxic.all() or not toxic.any():
        return Ordinal(np.zeros(0, np.int64), np.zeros(0), 50.0 + np.arange(GRADES - 1))
    row = np.repeat(np.arange(n), sizes)
    n_no, n_yes = (~toxic).sum(), toxic.sum()
    grades = toxic.astype(int)
    for step in STEPS:
        grades[toxic] += (np.asarray(telling) > step)[toxic]
    column = np.searchsorted(names, marks)
    weights = np.zeros(len(names))
    level = np.array([max((grades > k).mean(), 0.5 / n) for k in range(GRADES - 1)])
    # thresholds as the first and positive steps above it, so their order holds
    cuts = -np.log(level / (1 - level))
    steps = np.concatenate([cuts[:1], np.log(np.maximum(np.diff(cuts), 0.1))])
    mass_w, mass_s = np.full(len(names), 1e-8), np.full(len(steps), 1e-8)
    balance = np.where(toxic, n / (2 * n_yes), n / (2 * n_no))
    for _ in range(rounds):
        cuts = np.cumsum(np.concatenate([steps[:1], np.exp(steps[1:])]))
        value = np.bincount(row, weights[column], n)
        above = 1 / (1 + np.exp(-np.clip(value[:, None] - cuts, -500, 500)))
        edges = np.concatenate([np.ones((n, 1)), above, np.zeros((n, 1))], axis=1)
        at = np.arange(n)
        p = np.maximum(edges[at, grades] - edges[at, grades + 1], 1e-9)
        slope = edges * (1 - edges)
        by_value = balance * (slope[at, grades] - slope[at, grades + 1]) / p
        by_cut = np.zeros(GRADES - 1)
        for k in range(GRADES - 1):
            low, high = grades == k + 1, grades == k
            by_cut[k] = -(balance * slope[:, k + 1] / p)[low].sum() + (balance * slope[:, k + 1] / p)[high].sum()
        grad_w = np.bincount(column, by_value[row], len(names)) / n - ridge * weights
        grad_s = np.concatenate([[by_cut.sum()], [by_cut[k:].sum() * np.exp(steps[k]) for k in range(1, GRADES - 1)]]) / n
        mass_w += grad_w**2
        mass_s += grad_s**2
        weights += rate * grad_w / np.sqrt(mass_w)
        steps += rate * grad_s / np.sqrt(mass_s)
    cuts = np.cumsum(np.concatenate([steps[:1], np.exp(steps[1:])]))
    solid = np.abs(weights) > 1e-3
    return Ordinal(names[solid], weights[solid], cuts)


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        found = [features(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(found, pa.list_(pa.int32()))], names=["toxic", "marks"])


def evidence(marked: DataFrame, n_yes: int, n_no: int) -> DataFrame:
    """mark, evidence, odds, yes of each feature of rows (toxic, marks): by how many standard errors its shares in the classes are
    apart, the logarithm of their ratio, and how many toxic rows have it."""
    counts = marked.select("toxic", F.explode("marks").alias("mark")).groupBy("mark").agg(F.sum("toxic").alias("yes"), F.sum(1 - F.col("toxic")).alias("no"))
    share = (F.col("yes") + F.col("no") + 0.5) / (n_yes + n_no + 1)
    apart = F.abs(F.col("yes") / n_yes - F.col("no") / n_no) / F.sqrt(share * (1 - share) * (1 / n_yes + 1 / n_no))
    odds = F.log((F.col("yes") + 0.5) / (n_yes + 1)) - F.log((F.col("no") + 0.5) / (n_no + 1))
    return counts.select("mark", apart.alias("evidence"), odds.alias("odds"), "yes")


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, keep: int = KEEP) -> Ordinal:
    """Fit on labelled documents: at most ``sample`` of each class, those with the smallest hash of doc_id, and at most ``keep`` features.

    Features are chosen on the executors; only those with evidence, and which row has which of them, reach the driver.  Labels that are null,
    or of a document that isn't there, are left out; of several labels of a document the higher counts; repeated rows of a document each count;
    an empty table, or one class only, gives a model that rejects nothing.
    """
    spark = docs.sparkSession
    bounded(spark)
    chosen = labels.where("toxic in (0, 1)").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    chosen = chosen.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    picked = [chosen.where(F.col("toxic") == side).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for side in (0, 1)]
    marked = stored(texts(docs).join(F.broadcast(picked[0].unionByName(picked[1])), "doc_id").select("toxic", "text").mapInArrow(_marked, "toxic int, marks array<int>"), "marked")
    n_yes, n_no = marked.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.coalesce(F.sum(1 - F.col("toxic")), F.lit(0))).first()
    if not n_yes or not n_no:
        return fit(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0))
    known = stored(evidence(marked, n_yes, n_no).where(f"evidence > {LEAST} OR (odds > 3 AND yes >= 5)"), "evidence")
    names = np.sort(known.where(f"evidence > {LEAST}").orderBy(F.desc("evidence"), "mark").limit(keep).select("mark").toArrow().column(0).to_numpy())
    telling = np.sort(known.where("odds > 3 AND yes >= 5").select("mark").toArrow().column(0).to_numpy())
    sent = spark.sparkContext.broadcast((names, telling))

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, telling = sent.value
        for batch in slices(batches):
            rows = [np.array(m, np.int32) for m in batch.column("marks").to_pylist()]
            columns = [batch.column("toxic"), pa.array([int(np.isin(m, telling).sum()) for m in rows], pa.int32()), pa.array([m[np.isin(m, names)] for m in rows], pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["toxic", "telling", "marks"])

    table = marked.mapInArrow(kept, "toxic int, telling int, marks array<int>").toArrow().combine_chunks()
    marks = table.column("marks").chunk(0)
    return fit(names, marks.flatten().to_numpy(), np.diff(marks.offsets.to_numpy()), table.column("toxic").to_numpy(), table.column("telling").to_numpy())


def scored(docs: DataFrame, model: Ordinal, *more: str) -> DataFrame:
    """doc_id, the columns ``more``, grade (the likeliest int), severity (its expectation, 0 to 3), p_toxic, toxic (0 or 1).

    Whole texts; null counts as empty; a text without words gets the model's base rate; repeated rows each get their own; other columns
    aren't read; an empty table gives no rows.  No shuffle.
    """
    source = texts(docs, *more)
    names = ["doc_id", *more]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name in names), "grade int, severity double, p_toxic double, toxic int"])
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        index = dict(zip(known.names.tolist(), known.weights.tolist(), strict=True))
        for batch in slices(batches):
            out: list[list] = [[], [], [], []]
            for text in batch.column("text").to_pylist():
                above = known.above(sum(index.get(m, 0.0) for m in features(text).tolist()))
                edges = np.concatenate([[1.0], above, [0.0]])
                for column, value in zip(out, (int(np.argmax(-np.diff(edges))), float(above.sum()), float(above[0]), int(above[0] > 0.5)), strict=True):
                    column.append(value)
            kinds = [pa.int32(), pa.float64(), pa.float64(), pa.int32()]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), *map(pa.array, out, kinds)], names=[*names, "grade", "severity", "p_toxic", "toxic"])

    bounded(docs.sparkSession)
    return source.mapInArrow(run, schema)


def accepted(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of docs that the model doesn't reject, columns as they are; the model learns from docs that are labelled."""
    model = train(docs, labels, sample)
    row = F.struct(*[docs[f"`{c}`"].alias(c) for c in docs.columns]).alias("whole_row")
    judged = scored(docs.select("doc_id", "text", row), model, "whole_row").where("toxic = 0")
    return judged.select(*[F.col("whole_row").getField(c).alias(c) for c in docs.columns])
