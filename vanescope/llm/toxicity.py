"""Toxic documents by a linear classifier over character n-grams scaled by naive Bayes ratios.

A feature is an n-gram of 3 to 8 bytes (``SIZES``) of the lower-cased text that a document holds at least once.
Its value is its log-count ratio between toxic and other documents, smoothed; logistic regression
over these values gives the score.

Training uses a bounded sample of ``SAMPLE_ROWS`` labelled rows at most, by a hash of the id, and the
whole text of each. Up to half of them are of either class, so a rare class is not thinned out; the
intercept is put back by the shares taken. It runs in Spark: documents of either class are first
counted in a fixed number of buckets, then n-grams exactly in those buckets that hold enough documents
of one class for an n-gram that differs. No n-gram in another bucket can, so none is lost. N-grams
whose rate differs between the classes by ``LEAST_Z`` standard errors become features, the ``FEATURES``
farthest apart, by hash if they tie. Regression averages what tasks learn from their part of the
sample, in the order of ids, over ``ROUNDS`` rounds. The driver sees a bit per bucket, features and
weights only, whose number is fixed. Scoring covers every document.

Defined results: NULL and empty texts hold no n-gram; their score follows from the intercept. Labels
that are NULL are left out; a label given twice counts twice. With no label, or labels of one class
only, there are no features and the score is the smoothed share of toxic rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vanescope.llm.stored import stored
from vanescope.llm.text import _BYTE_VALUES, LOWER, _powers, chunks, mix

SAMPLE_ROWS = 20_000
SIZES = (3, 4, 5, 6, 8)
BUCKET_BITS = 24
FEATURES = 20_000
LEAST_Z = 4.0
LEAST_DOCUMENTS = 4
#: Tasks that share the sample.
TASKS = 6
ROUNDS = 6
PENALTY = 1e-4
#: N-grams that a task holds before it hands on their counts.
HELD_GRAMS = 1 << 21

_SLICES = 256
_FILTER_BITS = 22


def grams(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram size: hashes, and the byte at which each begins."""
    data = LOWER[data]
    n = len(data)
    up, down = _powers.get(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * up[:n], out=total[1:])
    end = np.repeat(bounds[1:], np.diff(bounds))
    for size in SIZES:
        at = np.flatnonzero(np.arange(size, n + size) <= end)
        yield mix((total[at + size] - total[at]) * down[at] + np.uint64(size)), at


def _bucket(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def _z(toxic: np.ndarray, other: np.ndarray, n_toxic: int, n_other: int) -> np.ndarray:
    """Difference of the two rates in standard errors."""
    p, q = toxic / n_toxic, other / n_other
    both = (toxic + other) / (n_toxic + n_other)
    return (p - q) / np.sqrt(np.maximum(both * (1 - both), 1e-12) * (1 / n_toxic + 1 / n_other))


@dataclass
class Model:
    """Hashes of the features in ascending order, their weights and the intercept."""

    features: np.ndarray
    weights: np.ndarray
    intercept: float

    def __post_init__(self) -> None:
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[(self.features >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True

    def held(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(document, feature) pairs of a chunk, each once, by document."""
        found = []
        k = len(self.features)
        for hashes, at in grams(data, bounds):
            maybe = np.flatnonzero(self.filter[(hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
            feature = np.minimum(np.searchsorted(self.features, hashes[maybe]), max(k - 1, 0))
            if not k:
                continue
            same = self.features[feature] == hashes[maybe]
            document = np.searchsorted(bounds, at[maybe[same]], "right") - 1
            found.append(np.unique(document * k + feature[same]))
        pairs = np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)
        return pairs // max(k, 1), pairs % max(k, 1)

    def score(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        document, feature = self.held(data, bounds)
        z = self.intercept + np.bincount(document, self.weights[feature], len(bounds) - 1)
        return 1 / (1 + np.exp(-np.clip(z, -700, 700)))


def sample_of(df: DataFrame, labels: DataFrame, label_col: str, id_col: str, text_col: str, most: int) -> tuple[DataFrame, int, int, float]:
    """A stored table (toxic, text) of labelled rows, ``most`` of them on average at most, the
    numbers of toxic and other labels in the sample, and what the sample adds to the log-odds."""
    known = labels.select(labels[id_col].alias("id"), labels[label_col].cast("int").alias("toxic")).where("toxic IN (0, 1) AND id IS NOT NULL")
    of = {row[0]: row[1] for row in known.groupBy("toxic").count().collect()}
    n = [of.get(c, 0) for c in (0, 1)]
    # Half for either class; what one leaves goes to the other.
    share = [min(1.0, max(most / 2, most - n[1 - c]) / max(n[c], 1)) for c in (0, 1)]
    chance = F.xxhash64("id", F.lit(23)).bitwiseAND(F.lit((1 << 31) - 1)) / (1 << 31)
    chosen = known.where(chance < F.when(F.col("toxic") == 1, share[1]).otherwise(share[0]))
    rows = df.select(df[id_col].alias("id"), df[text_col].cast("string").alias("text"))
    # Of a bounded number of rows of two numbers each.
    rows = rows.join(F.broadcast(chosen), "id").repartition(TASKS, F.xxhash64("id"))
    # What is learned depends on the order of rows, so it is not left to that of the shuffle.
    rows = rows.sortWithinPartitions("id", "toxic", "text")
    rows = stored(rows.select("toxic", F.coalesce("text", F.lit("")).alias("text")), "labelled")
    by = {row[0]: row[1] for row in rows.groupBy("toxic").count().collect()}
    return rows, by.get(1, 0), by.get(0, 0), float(np.log(share[1]) - np.log(share[0]))


def _least(n_own: int, n_other: int) -> int:
    """The fewest documents of one class that make an n-gram differ, where the other has none."""
    n = np.arange(1, n_own + 1)
    far = np.flatnonzero(_z(n, np.zeros_like(n), n_own, n_other) >= LEAST_Z)
    return int(n[far[0]]) if len(far) else n_own + 1


def _buckets(rows: DataFrame, n_toxic: int, n_other: int, bits: int = BUCKET_BITS) -> np.ndarray:
    """Whether a bucket may hold an n-gram that differs enough between the classes.

    An n-gram in t toxic and o other documents differs most where the other class has none, and its
    bucket counts t and o at least. So it is enough to ask whether either count alone could do."""
    width = (1 << bits) // _SLICES
    # In the order of the two counts.
    least = _least(n_toxic, n_other), _least(n_other, n_toxic)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 1 << bits), np.int32)
        for batch in batches:
            toxic = batch.column(0).to_numpy()
            for first, _, data, bounds in chunks(batch.column(1)):
                for hashes, at in grams(data, bounds):
                    document = np.searchsorted(bounds, at, "right") - 1
                    pairs = np.unique(document << bits | _bucket(hashes, bits))
                    own = toxic[first + (pairs >> bits)] == 1
                    bucket = pairs & (1 << bits) - 1
                    np.add.at(counts[0], bucket[own], 1)
                    np.add.at(counts[1], bucket[~own], 1)
        codec = pa.Codec("zstd")
        parts = counts.reshape(2, _SLICES, width)
        for i in range(_SLICES):
            yield pa.record_batch([pa.array([i], pa.int32()), *(pa.array([codec.compress(parts[c, i].tobytes(), asbytes=True)]) for c in (0, 1))], names=["slice", "toxic", "other"])

    def pick(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        codec = pa.Codec("zstd")
        counts = [sum(np.frombuffer(codec.decompress(b, 4 * width, asbytes=True), np.int32).astype(np.int64) for b in group[c]) for c in ("toxic", "other")]
        return pd.DataFrame({"slice": [key[0]], "bits": [np.packbits((counts[0] >= least[0]) | (counts[1] >= least[1])).tobytes()]})

    counted = rows.mapInArrow(count, "slice int, toxic binary, other binary")
    found = counted.groupBy("slice").applyInPandas(pick, "slice int, bits binary").toArrow()
    by = dict(zip(found.column(0).to_pylist(), found.column(1).to_pylist()))
    return np.frombuffer(b"".join(by[i] for i in range(_SLICES)), np.uint8)


def _summed(held: list[np.ndarray]) -> np.ndarray:
    """Rows of (gram, toxic, other), each gram once."""
    grams, toxic, other = np.concatenate(held, axis=1)
    grams, inverse = np.unique(grams, return_inverse=True)
    return np.stack([grams, *(np.bincount(inverse, c, len(grams)).astype(np.int64) for c in (toxic, other))])


def _features(rows: DataFrame, buckets: np.ndarray, n_toxic: int, n_other: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the features in ascending order and their log-count ratios."""
    shared = rows.sparkSession.sparkContext.broadcast(buckets)
    bits = (8 * len(buckets)).bit_length() - 1

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(shared.value).view(bool)
        held = [np.zeros((3, 0), np.int64)]

        def given() -> pa.RecordBatch:
            return pa.record_batch([pa.array(c) for c in held[0]], names=["gram", "toxic", "other"])

        for batch in batches:
            labels = batch.column(0).to_numpy()
            for first, _, data, bounds in chunks(batch.column(1)):
                for hashes, at in grams(data, bounds):
                    some = wanted[_bucket(hashes, bits)]
                    document = np.searchsorted(bounds, at[some], "right") - 1
                    h = hashes[some].view(np.int64)
                    order = np.lexsort((document, h))
                    h, document = h[order], document[order]
                    new = np.ones(len(h), bool)
                    new[1:] = (h[1:] != h[:-1]) | (document[1:] != document[:-1])
                    label = labels[first + document[new]]
                    held.append(np.stack([h[new], label == 1, label == 0]).astype(np.int64))
                if sum(part.shape[1] for part in held[1:]) > HELD_GRAMS:
                    held = [_summed(held)]
                    if held[0].shape[1] > HELD_GRAMS:
                        yield given()
                        held = [np.zeros((3, 0), np.int64)]
        held = [_summed(held)]
        yield given()

    p, q = F.col("toxic") / n_toxic, F.col("other") / n_other
    both = (F.col("toxic") + F.col("other")) / (n_toxic + n_other)
    z = F.abs(p - q) / F.sqrt(F.greatest(both * (1 - both), F.lit(1e-12)) * (1 / n_toxic + 1 / n_other))
    listed = (
        rows.mapInArrow(count, "gram long, toxic long, other long")
        .groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
        .where(f"toxic + other >= {LEAST_DOCUMENTS}").withColumn("z", z).where(F.col("z") >= LEAST_Z)
        .orderBy(F.desc("z"), "gram").limit(FEATURES).toArrow()
    )
    gram, toxic, other = (listed.column(i).to_numpy() for i in range(3))
    ratio = np.log((toxic + 1) / (n_toxic + 2)) - np.log((other + 1) / (n_other + 2))
    order = np.argsort(gram.view(np.uint64))
    return gram.view(np.uint64)[order].copy(), ratio[order]


def _learn(x: list[np.ndarray], y: np.ndarray, w: np.ndarray, b: float, ratio: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, float]:
    """One pass of AdaGrad over documents given as arrays of features."""
    w = w.copy()
    seen = np.full(len(w), 1.0)
    seen_b = 1.0
    for i in order:
        f = x[i]
        v = ratio[f]
        g = 1 / (1 + np.exp(-np.clip(b + w[f] @ v, -30, 30))) - y[i]
        step = g * v + PENALTY * w[f]
        seen[f] += step * step
        w[f] -= 0.3 * step / np.sqrt(seen[f])
        seen_b += g * g
        b -= 0.3 * g / np.sqrt(seen_b)
    return w, b


def train(
    df: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS
) -> Model:
    """Features and weights from labelled rows."""
    rows, n_toxic, n_other, added = sample_of(df, labels, label_col, id_col, text_col, sample_rows)
    start = float(np.log((n_toxic + 1) / (n_other + 1)))
    nothing = Model(np.zeros(0, np.uint64), np.zeros(0), start - added)
    if not n_toxic or not n_other:
        return nothing
    features, ratio = _features(rows, _buckets(rows, n_toxic, n_other), n_toxic, n_other)
    if not len(features):
        return nothing
    context = rows.sparkSession.sparkContext
    w, b = np.zeros(len(features)), start
    for round in range(ROUNDS):
        shared = context.broadcast((Model(features, w, b), ratio, round))

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model, ratio, round = shared.value
            x: list[np.ndarray] = []
            y: list[int] = []
            for batch in batches:
                y.extend(batch.column(0).to_pylist())
                for _, _, data, bounds in chunks(batch.column(1)):
                    document, feature = model.held(data, bounds)
                    x.extend(np.split(feature, np.searchsorted(document, np.arange(1, len(bounds) - 1))))
            if x:
                order = np.random.default_rng(round).permutation(len(x))
                w, b = _learn(x, np.array(y), model.weights, model.intercept, ratio, order)
                yield pa.record_batch([pa.array([len(x)]), pa.array([w.tobytes()]), pa.array([b])], names=["n", "w", "b"])

        parts = rows.mapInArrow(run, "n long, w binary, b double").collect()
        n = np.array([part["n"] for part in parts], float)
        w = (n[:, None] * np.array([np.frombuffer(part["w"]) for part in parts])).sum(axis=0) / n.sum()
        b = float((n * [part["b"] for part in parts]).sum() / n.sum())
    return Model(features, w * ratio, b - added)


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``score`` of each row."""
    rows = df.select(df[id_col].alias("id"), df[text_col].cast("string").alias("text"))
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, bounds in chunks(batch.column(1)):
                yield pa.record_batch([batch.column(0).slice(first, end - first), pa.array(shared.value.score(data, bounds))], names=["id", "score"])

    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
