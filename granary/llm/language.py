"""Language identification by a bidirectional gated recurrent network over bytes.

Two gated recurrent layers read a window of bytes, one from either end; at every position a softmax over both states labels the
language.  The network is trained in numpy by backpropagation through time on windows of a bounded sample of labelled
rows.  A whole text is cut into windows without overlap or remainder, every position is labelled, and a document's
probabilities are the mean over its positions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded, slices, small_side, texts

#: Bytes in a window, units of a state, windows that are labelled at a time.
LENGTH, UNITS, BLOCK = 64, 12, 4096
#: The sample: so many rows of each language, so many windows of each row, drawn evenly over its whole text.
ROWS, WINDOWS = 500, 24
UNKNOWN = "und"


def has_letter(text: str) -> bool:
    """Whether any character is a letter (general category L); digits, marks and letter-like numbers aren't."""
    return any(map(str.isalpha, text))


class Layer:
    """One direction: update and reset gates and a candidate, whose input parts are table rows by byte."""

    def __init__(self, rng: np.random.Generator, units: int, labels: int):
        self.units = units
        self.table = rng.normal(0, 0.3, (3 * units, 256)).astype(np.float32)
        self.inner = (rng.normal(0, 1, (3 * units, units)) / np.sqrt(units)).astype(np.float32)
        self.outer = (rng.normal(0, 1, (labels, units)) / np.sqrt(units)).astype(np.float32)

    @property
    def weights(self) -> list[np.ndarray]:
        return [self.table, self.inner, self.outer]

    def run(self, x: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list]:
        """Bytes (positions, windows) -> logits (positions, labels, windows), and what the way back needs."""
        n, (steps, width) = self.units, x.shape
        h = np.zeros((n, width), np.float32)
        logits, saved = np.empty((steps, len(self.outer), width), np.float32), []
        a, g = np.empty((3 * n, width), np.float32), np.empty((3 * n, width), np.float32)
        for t in range(steps):
            np.take(self.table, x[t], axis=1, out=a, mode="clip")
            np.matmul(self.inner, h, out=g)
            gates = a[: 2 * n]
            gates += g[: 2 * n]
            gates *= 0.5
            np.tanh(gates, out=gates)
            gates *= 0.5
            gates += 0.5
            z, r = gates[:n], gates[n:]
            c = a[2 * n :]
            c += r * g[2 * n :]
            np.tanh(c, out=c)
            if keep:
                saved.append((h.copy(), z.copy(), r.copy(), c.copy(), g[2 * n :].copy()))
            h -= c
            h *= z
            h += c
            np.matmul(self.outer, h, out=logits[t])
        return logits, saved

    def back(self, x: np.ndarray, saved: list, by_logits: np.ndarray) -> list[np.ndarray]:
        """Gradients of weights, through time, from those of the logits."""
        n, (steps, width) = self.units, x.shape
        inner, outer, table = np.zeros_like(self.inner), np.zeros_like(self.outer), np.zeros_like(self.table)
        carried, by_table = np.zeros((n, width), np.float32), np.empty((steps, 3 * n, width), np.float32)
        for t in reversed(range(steps)):
            before, z, r, c, g = saved[t]
            h = c + z * (before - c)
            outer += by_logits[t] @ h.T
            d = self.outer.T @ by_logits[t] + carried
            by_c = d * (1 - z) * (1 - c * c)
            by_z = d * (before - c) * z * (1 - z)
            by_r = by_c * g * r * (1 - r)
            by_inner = np.concatenate([by_z, by_r, by_c * r])
            inner += by_inner @ before.T
            carried = d * z + self.inner.T @ by_inner
            by_table[t] = np.concatenate([by_z, by_r, by_c])
        flat = x.ravel()
        for unit in range(3 * n):
            table[unit] = np.bincount(flat, by_table[:, unit].ravel(), 256)
        return [table, inner, outer]


class Network:
    def __init__(self, labels: list[str], units: int = UNITS, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.labels, self.layers = labels, [Layer(rng, units, len(labels)) for _ in range(2)]
        self.bias = np.zeros(len(labels), np.float32)

    def probabilities(self, x: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list]:
        """Of every position of every window: (positions, labels, windows)."""
        onward, s0 = self.layers[0].run(x, keep)
        backward, s1 = self.layers[1].run(x[::-1], keep)
        onward += backward[::-1]
        onward += self.bias[:, None]
        onward -= onward.max(axis=1, keepdims=True)
        np.exp(onward, out=onward)
        onward /= onward.sum(axis=1, keepdims=True)
        return onward, [s0, s1]

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross-entropy over all positions, and its gradients of each layer's weights and of the bias."""
        p, saved = self.probabilities(x, True)
        steps, width = x.shape
        at = np.arange(width)
        loss = -float(np.log(np.maximum(p[:, y, at], 1e-12)).mean())
        p[:, y, at] -= 1
        p /= steps * width
        return loss, self.layers[0].back(x, saved[0], p) + self.layers[1].back(x[::-1], saved[1], p[::-1]) + [p.sum(axis=(0, 2))]

    def fit(self, x: np.ndarray, y: np.ndarray, rounds: int = 400, width: int = 192, rate: float = 0.02, seed: int = 11) -> Network:
        """Adam on batches of windows x (windows, positions) with labels y, drawn evenly over labels."""
        rng = np.random.default_rng(seed)
        weights = self.layers[0].weights + self.layers[1].weights + [self.bias]
        first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
        by_label = [np.flatnonzero(y == k) for k in range(len(self.labels))]
        for step in range(1, rounds + 1):
            drawn = rng.integers(0, len(self.labels), width)
            chosen = np.array([rng.choice(by_label[k]) for k in drawn])
            _, found = self.gradients(np.ascontiguousarray(x[chosen].T), y[chosen])
            size = np.sqrt(sum(float((g * g).sum()) for g in found))
            pace = rate * min(1.0, 2 * (1 - step / (rounds + 1)))
            for w, g, m, v in zip(weights, found, first, second, strict=True):
                g = g * min(1.0, 1.0 / (size + 1e-9))
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w -= pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        return self

    def pooled(self, raw: list[bytes]) -> np.ndarray:
        """Mean probabilities over all positions of each of some non-empty byte strings: (strings, labels)."""
        counts = np.array([-(-len(b) // LENGTH) for b in raw])
        sums = np.zeros((len(raw), len(self.labels)))
        owner = np.repeat(np.arange(len(raw)), counts)
        data = np.frombuffer(b"".join(b.ljust(int(n) * LENGTH, b" ") for b, n in zip(raw, counts, strict=True)), np.uint8).reshape(-1, LENGTH)
        lasts, over = np.cumsum(counts) - 1, counts * LENGTH - np.array([len(b) for b in raw])
        padding = np.zeros(len(data), int)
        padding[lasts] = over
        for i in range(0, len(data), BLOCK):
            x = np.ascontiguousarray(data[i : i + BLOCK].T)
            p, _ = self.probabilities(x)
            pad = padding[i : i + BLOCK]
            if pad.any():
                p *= (np.arange(LENGTH)[:, None] < LENGTH - pad)[:, None, :]
            np.add.at(sums, owner[i : i + BLOCK], p.sum(axis=0).T)
        return sums / np.array([len(b) for b in raw])[:, None]


def train(docs: DataFrame, labelled: DataFrame | None = None, rows: int = ROWS, windows: int = WINDOWS, rounds: int = 400) -> Network | None:
    """Learn every non-null lang of ``labelled`` (else docs) from a bounded sample of its rows with a letter.

    The bounds are ``rows`` rows of each language (those with the smallest hash of doc_id) and ``windows`` windows of each row, drawn
    evenly over its whole text, however long.  Rows without a language, an id or a letter teach nothing; of repeated rows with one doc_id all
    stand in the sample or none; other columns aren't read; None if no row is left.
    """
    spark = docs.sparkSession
    bounded(spark)
    source = (docs if labelled is None else labelled).where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").rlike(r"\p{L}"))
    # by its language's count a row's hash tells already whether it can be among the first; few are left to put in order
    keys = source.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)).alias("mark"))
    counts = small_side(keys.groupBy("lang").agg(F.count("*").alias("count")))
    near = keys.join(counts, "lang").where(F.col("mark") * F.col("count") <= F.lit(float((2 * rows + 100) << 40)))
    ranked = near.dropDuplicates(["doc_id", "lang"]).withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("mark", "doc_id")))
    chosen = ranked.where(F.col("n") <= rows).select("doc_id", "lang")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out: list[list] = [[], [], []]
            for doc_id, text, lang in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                rng = np.random.default_rng(abs(doc_id))
                for start in rng.integers(0, max(1, len(raw) - LENGTH + 1), windows).tolist():
                    for column, value in zip(out, (doc_id, raw[start : start + LENGTH].ljust(LENGTH, b" "), lang), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, (pa.int64(), pa.binary(), pa.string()), strict=True)], names=["doc_id", "x", "lang"])

    sample = texts(source, "lang").join(small_side(chosen), ["doc_id", "lang"], "left_semi").select("doc_id", "text", "lang").mapInArrow(cut, "doc_id long, x binary, lang string")
    found = sorted((r["lang"], r["doc_id"], bytes(r["x"])) for r in sample.toArrow().to_pylist())
    if not found:
        return None
    labels = sorted({f[0] for f in found})
    x = np.frombuffer(b"".join(f[2] for f in found), np.uint8).reshape(-1, LENGTH)
    return Network(labels).fit(x, np.array([labels.index(f[0]) for f in found]), rounds)


def predicted(docs: DataFrame, network: Network | None) -> DataFrame:
    """doc_id, lang_pred, score: the likeliest language of every whole text and its mean probability.

    A null text, one without a letter, or no network: "und" and 0.  Only text is read. No shuffle; repeated rows each get their own;
    an empty table gives no rows.
    """
    bounded(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in slices(batches):
            whole = batch.column("text").to_pylist()
            at = [i for i, t in enumerate(whole) if known and has_letter(t)]
            names, scores = [UNKNOWN] * len(whole), [0.0] * len(whole)
            if at:
                p = known.pooled([whole[i].encode("utf-8", "surrogatepass") for i in at])
                for i, best, score in zip(at, p.argmax(axis=1).tolist(), p.max(axis=1).tolist(), strict=True):
                    names[i], scores[i] = known.labels[best], min(1.0, score)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return texts(docs).mapInArrow(run, "doc_id long, lang_pred string, score double")
