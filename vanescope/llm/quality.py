"""Document quality by a regularised quadratic discriminant over statistics of the text.

Each class is a normal density with a covariance of its own, shrunk towards the covariance that the
classes share and that towards its diagonal, so that it stays well conditioned with few labels. The
score of a document is the probability of class 1: the logistic function of the difference of log
densities, which are Mahalanobis distances through a Cholesky factor kept from training, plus the
log odds of the classes.

Statistics describe form only, in any language: shares of kinds of characters, spread of bytes, word
lengths, repeated words and lines. They are transformed, logarithms for sizes and log odds for
shares, to be nearer to normal. Means and products of statistics are plain sums with partial
aggregation, over all labelled rows; only these sums come to the driver.

Defined results: NULL and empty texts have the statistics of a text of length nought and get a score
like any other. Labels that are NULL are left out, a label given twice counts twice. With no label the
score is 0.5; with fewer than two rows of a class it is the smoothed share of class 1.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vanescope.llm.stored import stored
from vanescope.llm.text import SPACE_WORD, Words, chunks

#: Weight of the shared covariance in that of a class, and of the diagonal in the shared one.
SHARED, DIAGONAL = 0.1, 0.1

STATISTICS = (
    "log_words", "log_lines", "word_length", "word_length_spread", "words_per_line", "letters", "capitals", "digits",
    "punctuation", "symbols", "other_scripts", "byte_entropy", "distinct_words", "top_word", "distinct_lines", "symbols_per_word",
)

_IN_LINE = np.ones(256, bool)
_IN_LINE[0x0A] = False


def _kinds() -> np.ndarray:
    kinds = np.zeros((256, 6))
    for byte in range(256):
        character = chr(byte)
        if byte >= 0x80:
            kinds[byte, 5] = 1
        elif character.isalpha():
            kinds[byte, 0] = 1
            kinds[byte, 1] = character.isupper()
        elif character.isdigit():
            kinds[byte, 2] = 1
        elif character in ".,;:'\"?()-":
            kinds[byte, 3] = 1
        elif byte > 0x20:
            kinds[byte, 4] = 1
    return kinds


_KINDS = _kinds()


def _odds(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Smoothed log odds of a share."""
    return np.log((part + 0.5) / (np.maximum(whole - part, 0) + 0.5))


def _distinct(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Distinct words of each document, and how often its commonest one occurs."""
    documents = len(words.counts)
    of = np.repeat(np.arange(documents), words.counts)
    order = np.lexsort((words.hashes, of))
    h, of = words.hashes[order], of[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (of[1:] != of[:-1])
    first = np.flatnonzero(new)
    top = np.zeros(documents, np.int64)
    np.maximum.at(top, of[first], np.diff(np.append(first, len(h))))
    return np.bincount(of[first], minlength=documents), top


def statistics(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One row of ``STATISTICS`` per document of a chunk."""
    n = len(bounds) - 1
    size = np.diff(bounds)
    of = np.repeat(np.arange(n, dtype=np.int64), size)
    histogram = np.bincount(of * 256 + data, minlength=n * 256).reshape(n, 256)
    letters, capitals, digits, punctuation, symbols, other = (histogram @ _KINDS).T
    share = histogram / np.maximum(size, 1)[:, None]
    entropy = -(share * np.log2(np.where(share > 0, share, 1))).sum(axis=1)
    words = Words(data, bounds, SPACE_WORD)
    count = words.counts
    length = (words.ends - words.starts).astype(float)
    total = np.concatenate([[0], np.cumsum(length)])[words.bounds]
    square = np.concatenate([[0], np.cumsum(length**2)])[words.bounds]
    mean = np.diff(total) / np.maximum(count, 1)
    spread = np.sqrt(np.maximum(np.diff(square) / np.maximum(count, 1) - mean**2, 0))
    lines = Words(data, bounds, _IN_LINE)
    different, top = _distinct(words)
    different_lines, _ = _distinct(lines)
    return np.column_stack(
        [
            np.log1p(count), np.log1p(lines.counts), np.log1p(mean), np.log1p(spread), np.log1p(count / np.maximum(lines.counts, 1)),
            _odds(letters + other, size), _odds(capitals, letters), _odds(digits, size), _odds(punctuation, size), _odds(symbols, size),
            _odds(other, size), entropy, _odds(different, count), _odds(top, count), _odds(different_lines, lines.counts),
            np.log1p(symbols / np.maximum(count, 1)),
        ]
    )


def describe(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and one column per statistic for each row."""
    rows = df.select(df[id_col].alias("id"), df[text_col].cast("string").alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, bounds in chunks(batch.column(1)):
                table = statistics(data, bounds)
                yield pa.record_batch([batch.column(0).slice(first, end - first), *(pa.array(c) for c in table.T)], names=["id", *STATISTICS])

    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), *(T.StructField(s, T.DoubleType()) for s in STATISTICS)])
    return rows.mapInArrow(run, schema)


@dataclass
class Discriminant:
    """Means and Cholesky factors of both classes; None for a class with too few rows."""

    log_odds: float
    means: list[np.ndarray] | None = None
    factors: list[np.ndarray] | None = None
    centre: np.ndarray | None = None
    scale: np.ndarray | None = None

    def probability(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.log_odds)
        if self.factors is not None:
            x = (x - self.centre) / self.scale
            for sign, mean, factor in zip((-1, 1), self.means, self.factors):
                away = np.linalg.solve(factor, (x - mean).T)
                z = z + sign * (-0.5 * (away**2).sum(axis=0) - np.log(np.diag(factor)).sum())
        return 1 / (1 + np.exp(-np.clip(z, -700, 700)))


def fit(labelled: DataFrame, label_col: str) -> Discriminant:
    """From rows with the statistics and a label of 0 or 1; all of them count, as sums."""
    d = len(STATISTICS)
    upper = [(i, j) for i in range(d) for j in range(i, d)]
    sums = (
        labelled.where(F.col(label_col).isin(0, 1))
        .groupBy(F.col(label_col).cast("int").alias("label"))
        .agg(
            F.count("*").alias("n"),
            F.array(*[F.sum(s) for s in STATISTICS]).alias("total"),
            F.array(*[F.sum(F.col(STATISTICS[i]) * F.col(STATISTICS[j])) for i, j in upper]).alias("products"),
        )
        .collect()
    )
    by = {row["label"]: row for row in sums}
    n = [by[c]["n"] if c in by else 0 for c in (0, 1)]
    model = Discriminant(float(np.log((n[1] + 1) / (n[0] + 1))))
    if min(n) < 2:
        return model
    mean = [np.array(by[c]["total"]) / n[c] for c in (0, 1)]
    moments = []
    for c in (0, 1):
        m = np.zeros((d, d))
        for (i, j), value in zip(upper, by[c]["products"]):
            m[i, j] = m[j, i] = value / n[c]
        moments.append(m - np.outer(mean[c], mean[c]))
    shared = (n[0] * moments[0] + n[1] * moments[1]) / sum(n)
    model.centre = (n[0] * mean[0] + n[1] * mean[1]) / sum(n)
    model.scale = np.sqrt(np.maximum(np.diag(shared), 1e-6))
    unit = np.outer(model.scale, model.scale)
    shared = shared / unit
    shared = (1 - DIAGONAL) * shared + DIAGONAL * np.eye(d)
    model.means = [(m - model.centre) / model.scale for m in mean]
    model.factors = [np.linalg.cholesky((1 - SHARED) * m / unit + SHARED * shared) for m in moments]
    return model


def score(described: DataFrame, model: Discriminant, id_col: str = "doc_id") -> DataFrame:
    """``id_col`` and ``score`` from rows of statistics."""
    shared = described.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.column_stack([batch.column(1 + i).to_numpy() for i in range(len(STATISTICS))])
            yield pa.record_batch([batch.column(0), pa.array(shared.value.probability(x))], names=["id", "score"])

    schema = T.StructType([described.schema["id"], T.StructField("score", T.DoubleType())])
    return described.select("id", *STATISTICS).mapInArrow(run, schema).withColumnRenamed("id", id_col)


def classify(df: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``score`` of each row of ``df``, learned from ``labels``, which have the same ids."""
    described = stored(describe(df, id_col, text_col), "statistics")
    known = labels.select(labels[id_col].alias("id"), F.col(label_col).alias("label"))
    return score(described, fit(described.join(known, "id"), "label"), id_col)
