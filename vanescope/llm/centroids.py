"""Centroid clustering in whole numbers, over a distance matrix that is kept and updated.

Components become whole numbers, floor(``scale`` * x), so distances, sums and centroids are exact and
no result depends on the order of anything.

* State. Vectors live in blocks, one row per Arrow batch: ids, components, squared norms, and for each
  centroid the dot product of every vector with it. The squared distance is |x|^2 - 2 x.c + |c|^2.
* Update. When centroids move, only the components of a centroid that changed, and no others, are
  multiplied with those of the vectors; the products are added to the stored dot products. Before the
  first round all centroids are zero and so are the products: the start is an update like any other.
* Assignment. The least distance of each row of the matrix, ties to the smaller number.
* Sums. Each block adds up its vectors per cluster; the block sums are added by Spark.

A round reads the state once and writes the next one, which then replaces it: two states exist at a
time. Nothing is shuffled but one line of sums per centroid and component and task. The driver holds
centroids only. When no centroid moves, further rounds would change nothing and are left out.

Numbers of any size stay exact: a block whose products might not fit 64 bits computes with Python's
own integers, and block sums travel as digits to the base 2^32.

Defined results: vectors that are NULL, have another length than ``size``, or hold a NULL or non-finite
component take no part. Repeated rows are vectors of their own. Rows without id are clustered but
never start a centroid; rows that share an id start several, in the order of their components. With
fewer vectors than centroids there are fewer centroids. A distance or inertia that does not fit a
long is NULL. No vectors, no rows.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vanescope.llm.stored import dropped, stored

_DIGIT = 32
_SAFE = 1 << 62
_EXACT_IN_DOUBLE = 1 << 53
_LONG = 1 << 63

_STATE = "ids binary, vectors binary, norms binary, dots binary, clusters binary, distances binary, sums array<bigint>"
_IDS = pa.schema([("id", pa.int64())])


def is_whole(vector: Column, size: int) -> Column:
    """Whether a vector has ``size`` components, none missing or not finite."""
    present = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) == size) & present


def whole_numbers(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) in the smallest type that holds it."""
    with np.errstate(over="ignore"):
        scaled = np.floor(x.astype(np.float64) * scale)
    top = np.abs(scaled).max(initial=0)
    for kind in (np.int16, np.int32, np.int64):
        if top < np.iinfo(kind).max:
            return scaled.astype(kind)
    # A product beyond the largest double is still a whole number.
    exact = [int(s) if np.isfinite(s) else int(v) * scale for s, v in zip(scaled.ravel(), x.astype(np.float64).ravel())]
    return np.array(exact, object).reshape(x.shape)


def dump(a: np.ndarray) -> bytes:
    return pickle.dumps((a.tolist(), a.shape)) if a.dtype == object else np.dtype(a.dtype).char.encode() + a.tobytes()


def load(raw: bytes, width: int | None = None) -> np.ndarray:
    # Python's own integers are pickled, and a pickle starts with a byte that is no type's letter.
    if raw[:1] == b"\x80":
        values, shape = pickle.loads(raw)
        out = np.empty(shape, object)
        out[...] = values
        return out
    flat = np.frombuffer(raw, np.dtype(raw[:1].decode()), offset=1)
    return flat if width is None else flat.reshape(-1, width)


def largest(a: np.ndarray) -> int:
    return max((abs(int(a.max())), abs(int(a.min())))) if a.size else 0


def dot_changes(vectors: np.ndarray, before: np.ndarray, after: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(centroid, change of its dot product with each vector) of the centroids that moved."""
    for j in range(len(after)):
        moved = np.flatnonzero(before[j] != after[j])
        if not len(moved):
            continue
        step = after[j][moved] - before[j][moved]
        bound = len(moved) * largest(vectors) * largest(step)
        if bound < _EXACT_IN_DOUBLE:
            yield j, (vectors[:, moved].astype(np.float64) @ step.astype(np.float64)).astype(np.int64)
        elif bound < _SAFE:
            yield j, vectors[:, moved].astype(np.int64) @ step.astype(np.int64)
        else:
            yield j, vectors[:, moved].astype(object) @ step.astype(object)


def digits(value: int) -> list[int]:
    """A whole number as digits to the base 2**32, the lowest first; the last one has the sign."""
    out = []
    while not -(1 << _DIGIT) < value < 1 << _DIGIT:
        out.append(value & (1 << _DIGIT) - 1)
        value >>= _DIGIT
    return [*out, value]


def block_sums(vectors: np.ndarray, clusters: np.ndarray, distances: np.ndarray, k: int) -> list[int]:
    """Per cluster: rows, summed distance and summed components, digit by digit.

    All lowest digits come first, then all second ones, and so on, so that lists of
    different lengths can be added place by place.
    """
    kind = np.int64 if largest(vectors) * max(len(vectors), 1) < _SAFE else object
    flat: list[int] = []
    for j in range(k):
        own = clusters == j
        of = distances[own]
        flat.append(int(own.sum()))
        flat.append(int(of.sum()) if largest(of) * max(len(of), 1) < _SAFE else sum(int(d) for d in of))
        flat.extend(int(s) for s in vectors[own].astype(kind).sum(axis=0))
    parts = [digits(v) for v in flat]
    longest = max(len(p) for p in parts)
    return [p[place] if place < len(p) else 0 for place in range(longest) for p in parts]


def advance(vectors: np.ndarray, norms: np.ndarray, dots: np.ndarray, before: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, ...]:
    """(dots, clusters, distances) once the centroids have moved from ``before`` to ``after``."""
    size = vectors.shape[1]
    top, reach = largest(vectors), max(largest(before), largest(after))
    if size * (top + reach) ** 2 >= _SAFE:
        dots = dots.astype(object)
        norms = norms.astype(object)
    dots = dots.copy()
    for j, change in dot_changes(vectors, before, after):
        if change.dtype == object and dots.dtype != object:
            dots = dots.astype(object)
        dots[:, j] += change
    lengths = np.array([sum(int(c) * int(c) for c in centroid) for centroid in after], dots.dtype)
    distances = norms[:, None] - 2 * dots + lengths
    clusters = distances.argmin(axis=1)
    return dots, clusters.astype(np.int32), distances[np.arange(len(clusters)), clusters]


def _blocks(rows: DataFrame, size: int, scale: int, k: int) -> DataFrame:
    """The state before the first round, all centroids being zero."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            values = np.asarray(batch.column(1).flatten()).reshape(-1, size)
            vectors = whole_numbers(values, scale)
            wide = vectors.dtype == object or size * largest(vectors) ** 2 >= _SAFE
            exact = vectors.astype(object if wide else np.int64)
            yield pa.record_batch(
                [
                    pa.array([batch.select([0]).serialize().to_pybytes()], pa.binary()),
                    pa.array([dump(vectors)], pa.binary()),
                    pa.array([dump((exact * exact).sum(axis=1))], pa.binary()),
                    pa.array([dump(np.zeros((len(vectors), k), exact.dtype))], pa.binary()),
                    pa.array([b""], pa.binary()),
                    pa.array([b""], pa.binary()),
                    pa.array([[]], pa.list_(pa.int64())),
                ],
                names=["ids", "vectors", "norms", "dots", "clusters", "distances", "sums"],
            )

    return rows.mapInArrow(run, _STATE)


def _round(state: DataFrame, before: np.ndarray, after: np.ndarray) -> DataFrame:
    """The state once the centroids have moved."""
    k, size = after.shape

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids, vectors, norms, dots = (batch.column(i)[row].as_py() for i in range(4))
                x = load(vectors, size)
                own, clusters, distances = advance(x, load(norms), load(dots, k), before, after)
                yield pa.record_batch(
                    [
                        *(pa.array([raw], pa.binary()) for raw in (ids, vectors, norms, dump(own), dump(clusters), dump(distances))),
                        pa.array([block_sums(x, clusters, distances, k)], pa.list_(pa.int64())),
                    ],
                    names=batch.schema.names,
                )

    return state.mapInArrow(run, _STATE)


def _totals(state: DataFrame, k: int, size: int) -> tuple[list[int], list[int], list[list[int]]]:
    """Rows, summed distance and summed components of each cluster."""
    # As many lines as centroids have components, times the digits of the longest number.
    places = state.select(F.posexplode("sums").alias("place", "digit")).groupBy("place").agg(F.sum("digit").alias("digit"))
    flat = [0] * (k * (size + 2))
    for place, digit in places.collect():
        flat[place % len(flat)] += int(digit) << _DIGIT * (place // len(flat))
    lines = [flat[j * (size + 2) : (j + 1) * (size + 2)] for j in range(k)]
    return [line[0] for line in lines], [line[1] for line in lines], [line[2:] for line in lines]


def _exact(rows: list[list[int]]) -> np.ndarray:
    """Centroids as 64-bit numbers where they fit."""
    fits = all(abs(v) < _SAFE for row in rows for v in row)
    out = np.empty((len(rows), len(rows[0])), np.int64 if fits else object)
    out[...] = rows
    return out


def cluster(
    df: DataFrame,
    k: int = 8,
    rounds: int = 10,
    scale: int = 1024,
    size: int = 64,
    seed: str = "3",
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``id_col``, ``cluster``, ``distance`` (squared) of every vector, ``cluster_inertia`` and ``inertia``
    (distances summed over the cluster and over all) and ``centroid_sha256`` (of the components of
    the final centroid in decimal, joined by commas).

    The ``k`` vectors start whose ids have the smallest SHA-256 of ``<seed>:<id>``.
    """
    spark = df.sparkSession
    schema = T.StructType(
        [
            T.StructField(id_col, T.LongType()),
            T.StructField("cluster", T.IntegerType()),
            *(T.StructField(c, T.LongType()) for c in ("distance", "cluster_inertia", "inertia")),
            T.StructField("centroid_sha256", T.StringType()),
        ]
    )
    rows = df.select(df[id_col].cast("long").alias("id"), df[vector_col].alias("vector")).where(is_whole(F.col("vector"), size))
    hashed = rows.where("id IS NOT NULL").withColumn("h", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256))
    starts = hashed.orderBy("h", "vector").limit(k).select("vector").collect()
    if not starts:
        # Without any id to start from nothing can be told apart.
        return spark.createDataFrame([], schema)
    centroids = _exact([[int(v) for v in whole_numbers(np.array([row[0]]), scale)[0]] for row in starts])
    k = len(centroids)

    before, old = np.zeros_like(centroids), None
    state = _blocks(rows, size, scale, k)
    for turn in range(rounds + 1):
        state, new = stored(_round(state, before, centroids), f"distances-{turn}", with_path=True)
        if old:
            dropped(spark, old)
        old = new
        counts, inertia, sums = _totals(state, k, size)
        if turn == rounds:
            break
        moved = _exact([[s // n for s in line] if n else [int(v) for v in own] for n, line, own in zip(counts, sums, centroids)])
        if (moved == centroids).all():
            break
        before, centroids = centroids, moved

    digests = [hashlib.sha256(",".join(str(int(v)) for v in c).encode()).hexdigest() for c in centroids]

    def fit(value: int) -> int | None:
        return value if -_LONG <= value < _LONG else None

    own_inertia, inertia_of_all = [fit(v) for v in inertia], fit(sum(inertia))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids, clusters, distances = (batch.column(i)[row].as_py() for i in range(3))
                ids = pa.ipc.read_record_batch(pa.py_buffer(ids), _IDS).column(0)
                clusters = load(clusters)
                yield pa.record_batch(
                    [
                        ids,
                        pa.array(clusters),
                        pa.array([fit(int(d)) for d in load(distances)], pa.int64()),
                        pa.array(own_inertia, pa.int64()).take(pa.array(clusters)),
                        pa.array([inertia_of_all] * len(clusters), pa.int64()),
                        pa.array(digests).take(pa.array(clusters)),
                    ],
                    names=schema.names,
                )

    return state.select("ids", "clusters", "distances").mapInArrow(run, schema)

