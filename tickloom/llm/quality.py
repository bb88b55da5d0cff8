"""Quality score by a factorisation machine over hashed words, structure statistics and the length of a document.

The score is sigmoid(b + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j). The pairwise sum is computed in linear time, as half of
the sum over factors of (sum v_if x_i)^2 - sum v_if^2 x_i^2. The machine is trained here by mini-batch AdaGrad on a sample of
at most SAMPLE_ROWS labelled documents outside the held-out fold; labels, lang, source and doc_id are no inputs. Scoring reads
each whole text once and shuffles nothing.

Defined results: a null or empty text has only structure inputs, all zero, and gets the score of those; repeated rows get
equal scores; a null id is carried and falls in the fold of the empty text; without usable labels every score is 0.5, with
one class only it is that class's smoothed share; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, mixed, texts
from .labelled import fold, training_sample

SAMPLE_ROWS = 8_000
BUCKETS, FACTORS, EPOCHS, BATCH = 4096, 8, 8, 256
FOLDS, HELD_OUT = 3, 1
#: Characters whose share of a text's bytes is an input each.
MARKS = b"|!#$%&*.,:;?<>{}[]()=_-/\\\"'"
N_STATS = len(MARKS) + 13


def _classes() -> np.ndarray:
    """byte value -> indicator of each byte class."""
    table = np.zeros((256, len(MARKS) + 6), np.float32)
    for i, mark in enumerate(MARKS):
        table[mark, i] = 1
    for i, members in enumerate((range(65, 91), range(97, 123), range(48, 58), (9, 11, 12, 13, 32), (10,), range(128, 256)), len(MARKS)):
        table[list(members), i] = 1
    return table


CLASSES = _classes()


def structure(contents: list[bytes], words: Words) -> np.ndarray:
    """Statistics of each text: shares of byte classes, lengths, repetition of words and lines."""
    counts = np.zeros((len(contents), 256), np.float32)
    lines = np.zeros((len(contents), 2), np.float32)
    for i, t in enumerate(contents):
        if t:
            counts[i] = np.bincount(np.frombuffer(t, np.uint8), minlength=256)
            rows = t.split(b"\n")
            lines[i] = len(rows), len(set(rows))
    size = counts.sum(axis=1)
    shares = (counts @ CLASSES) / np.maximum(size, 1)[:, None]
    upper, lower = shares[:, len(MARKS)], shares[:, len(MARKS) + 1]
    distinct = np.fromiter((len(set(w)) for w in words.lists), np.float32, len(contents))
    n = np.maximum(words.n, 1)
    more = [np.log1p(size), np.log1p(words.n), size / n, distinct / n, upper / np.maximum(upper + lower, 1e-6), lines[:, 1] / np.maximum(lines[:, 0], 1), np.log1p(n / np.maximum(lines[:, 0], 1))]
    return np.nan_to_num(np.column_stack([shares, *more]).astype(np.float32)) * (size > 0)[:, None]


def inputs(contents: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row starts, buckets of distinct words (each row's values are 1/sqrt of their number), and structure statistics."""
    words = Words([t.lower() if t else t for t in contents])
    bucket = (mixed(words.hash) % np.uint64(BUCKETS)).astype(np.int64)
    own = np.unique(words.text * BUCKETS + bucket)
    start = np.searchsorted(own, np.arange(len(contents) + 1) * BUCKETS)
    return start, (own % BUCKETS).astype(np.uint16), structure([t or b"" for t in contents], words)


def _sums(values: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Sum of each row's values (zero for an empty row)."""
    total = np.zeros((len(values) + 1, *values.shape[1:]))
    np.cumsum(values, axis=0, out=total[1:])
    return total[start[1:]] - total[start[:-1]]


@dataclass
class Machine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def dense(self, stats: np.ndarray) -> np.ndarray:
        return np.clip((stats - self.mean) / self.scale, -4, 4) / np.sqrt(stats.shape[1])

    def forward(self, start: np.ndarray, bucket: np.ndarray, dense: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores before the sigmoid, the factor sums, and each row's word value."""
        value = 1 / np.sqrt(np.maximum(np.diff(start), 1))
        v, w = self.factors, self.linear
        sums = _sums(v[bucket], start) * value[:, None] + dense @ v[BUCKETS:]
        squares = _sums((v**2).sum(axis=1)[bucket], start) * value**2 + dense**2 @ (v[BUCKETS:] ** 2).sum(axis=1)
        return self.bias + _sums(w[bucket], start) * value + dense @ w[BUCKETS:] + 0.5 * ((sums**2).sum(axis=1) - squares), sums, value

    def score(self, start: np.ndarray, bucket: np.ndarray, stats: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.forward(start, bucket, self.dense(stats))[0], -30, 30)))


def train(start: np.ndarray, bucket: np.ndarray, stats: np.ndarray, label: np.ndarray, seed: int = 7, rate: float = 0.15, decay: float = 1e-5) -> Machine:
    """AdaGrad on logistic loss."""
    rng = np.random.default_rng(seed)
    share = (label.sum() + 1) / (len(label) + 2)
    n = BUCKETS + stats.shape[1]
    machine = Machine(float(np.log(share / (1 - share))), np.zeros(n), rng.normal(0, 0.05, (n, FACTORS)), stats.mean(axis=0) if len(label) else np.zeros(stats.shape[1]), (stats.std(axis=0) if len(label) else np.zeros(stats.shape[1])) + 1e-6)
    if label.min(initial=1) == label.max(initial=0):
        machine.factors[:] = 0
        return machine
    dense, seen_w, seen_v, seen_b = machine.dense(stats), np.full(n, 1e-8), np.full((n, FACTORS), 1e-8), 1e-8
    for _ in range(EPOCHS):
        order = rng.permutation(len(label))
        for lo in range(0, len(order), BATCH):
            rows = order[lo : lo + BATCH]
            size = start[rows + 1] - start[rows]
            first = np.cumsum(size) - size
            own = bucket[np.repeat(start[rows] - first, size) + np.arange(size.sum())].astype(np.int64)
            z, sums, value = machine.forward(np.r_[0, np.cumsum(size)], own, dense[rows])
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - label[rows]) / len(rows)
            row, x = np.repeat(np.arange(len(rows)), size), np.repeat(value, size)
            gain = error[row] * x
            d_w = np.r_[np.bincount(own, gain, BUCKETS), error @ dense[rows]]
            pull = np.r_[np.bincount(own, gain * x, BUCKETS), error @ dense[rows] ** 2]
            d_v = np.column_stack([np.r_[np.bincount(own, gain * sums[row, f], BUCKETS), (error * sums[:, f]) @ dense[rows]] for f in range(FACTORS)]) - pull[:, None] * machine.factors
            d_w += decay * machine.linear
            d_v += decay * machine.factors
            seen_w += d_w**2
            seen_v += d_v**2
            seen_b += error.sum() ** 2
            machine.linear -= rate * d_w / np.sqrt(seen_w)
            machine.factors -= 0.3 * rate * d_v / np.sqrt(seen_v)
            machine.bias -= 0.3 * rate * error.sum() / np.sqrt(seen_b)
    return machine


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, label: str = "quality") -> Machine:
    """Train on the bounded sample; its inputs (at most BUCKETS + N_STATS numbers a row) come to the driver."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, bucket, stats = inputs(batch.column("text").cast(pa.large_binary()).to_pylist())
            parts = [bucket[a:z].tobytes() for a, z in zip(start, start[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(parts, pa.binary()), pa.array([s.tobytes() for s in stats], pa.binary())], names=["doc_id", "label", "buckets", "stats"])

    sample = training_sample(docs, labels, label, FOLDS, HELD_OUT, rows).select("doc_id", "text", "label")
    got = sorted(sample.mapInArrow(task, "doc_id long, label double, buckets binary, stats binary").collect())
    buckets = [np.frombuffer(r.buckets, np.uint16) for r in got]
    start = np.r_[0, np.cumsum([len(b) for b in buckets])].astype(np.int64)
    stats = np.array([np.frombuffer(r.stats, np.float32) for r in got], float).reshape(len(got), N_STATS)
    return train(start, np.concatenate(buckets) if buckets else np.empty(0, np.uint16), stats, np.array([r.label for r in got]))


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5, machine: Machine | None = None) -> DataFrame:
    """One row a document: doc_id, held_out, score, predicted."""
    source = texts(docs, id_col, text_col)
    machine = machine or fit(source, labels)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                score = machine.score(*inputs(part.column("text").cast(pa.large_binary()).to_pylist()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(score)], names=["doc_id", "score"])

    scored = source.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(task, "doc_id long, score double")
    return scored.select("doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of docs whose score reaches the threshold, with all their columns, in one pass over them."""
    machine = fit(texts(docs, "doc_id", "text"), labels)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                yield part.filter(pa.array(machine.score(*inputs(part.column("text").cast(pa.large_binary()).to_pylist())) >= threshold))

    return docs.mapInArrow(task, docs.schema)
