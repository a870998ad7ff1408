"""Exact search of the vectors with the largest inner products, without random access.

Components become whole numbers, floor(``SCALE`` * x), so scores are exact. A query scores a
candidate by the sum over components, which is monotone in one list per component: that list,
sorted, is read downwards where the query's component is positive and upwards where it is
negative. For a block of candidates and a block of queries the lists are read in steps:

* what has been read gives each candidate a lower bound (unread components at their worst) and
  an upper bound (at the last value read in that list);
* candidates whose upper bound is below the k-th largest lower bound drop out, among them all
  that no list has shown yet;
* when few are left, their scores are resolved; else reading goes on to the end of the lists.

The bounds hold for a block of queries at once, as products of two matrices, because how far the
lists are read does not depend on the query. Each pair of blocks gives k rows per query, and these
are merged by a window with a group limit, which cuts each task's rows to k per query first.

Blocks are dealt out by a hash of the row, so their sizes are even whatever the vectors are, and
equal vectors of different ids are spread. Candidate blocks move once; query blocks, the smaller
side, once per candidate block.

Defined results: vectors that are NULL or hold a NULL or non-finite component take no part; vectors
of different lengths do not meet; rows that repeat both id and vector count once; rows without id
take no part; a query never finds rows of its own id. Ties go to the smaller id.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCALE = 64
CANDIDATES_PER_BLOCK = 8192
QUERIES_PER_BLOCK = 512
#: Query blocks that one task meets a candidate block with at a time.
BLOCKS_PER_TASK = 16
#: How far lists are read before bounds are looked at, as parts of their length.
DEPTHS = (0.25, 0.5)

_EXACT_IN_FLOAT = 1 << 24
_EXACT_IN_DOUBLE = 1 << 53


def whole_numbers(vector: Column) -> Column:
    """Components as whole numbers; NULL where one is missing or not finite."""
    valid = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")) & ~F.isnan(x))
    return F.when(valid, F.transform(vector, lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")).cast("long")))


def _pack(rows: DataFrame, block: str) -> DataFrame:
    """One row per block: its ids and its matrix."""

    def pack(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        matrix = np.array(group["vector"].tolist(), np.int64).reshape(len(group), key[0])
        ids = group["id"].to_numpy(np.int64)
        return pd.DataFrame({"size": [key[0]], "last": [key[1]], block: [key[2]], "ids": [ids.tobytes()], "matrix": [matrix.tobytes()]})

    schema = f"size int, last long, {block} long, ids binary, matrix binary"
    return rows.groupBy("size", "last", block).applyInPandas(pack, schema)


def _bounds(x: np.ndarray, up: np.ndarray, down: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bound of each query's score of each candidate, ``depth`` entries into the lists.

    up, down: the queries' positive and negative components.
    """
    ordered = np.sort(x, axis=0)
    low, high = ordered[0], ordered[-1]
    #: The last value read in each list; entries equal to it are read as well.
    from_top, from_bottom = ordered[-depth], ordered[depth - 1]
    top, bottom = x >= from_top, x <= from_bottom
    lower = up @ np.where(top, x - low, 0).T + down @ np.where(bottom, x - high, 0).T
    lower += (up @ low + down @ high)[:, None]
    upper = up @ np.where(top, x - (from_top - 1), 0).T + down @ np.where(bottom, x - (from_bottom + 1), 0).T
    upper += (up @ (from_top - 1) + down @ (from_bottom + 1))[:, None]
    return lower, upper


def query_key(query_id: int, vector: np.ndarray) -> int:
    """Tells queries apart that share an id; the same in every task."""
    return int.from_bytes(hashlib.md5(vector.tobytes() + query_id.tobytes()).digest()[:8], "little", signed=True)


def best(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(row of q, id, score) of the k best candidates of each query, ties to the smaller id."""
    limit = 4 * max(1, x.shape[1]) * (int(np.abs(x).max(initial=0)) + 1) * (int(np.abs(q).max(initial=0)) + 1)
    kind = np.float32 if limit < _EXACT_IN_FLOAT else np.float64 if limit < _EXACT_IN_DOUBLE else object
    order = np.argsort(ids, kind="stable")
    ids, x, q = ids[order], x[order].astype(kind), q.astype(kind)
    up, down = np.where(q > 0, q, 0), np.where(q < 0, q, 0)
    wanted = k + 1  # the query itself may be among them
    waiting = np.arange(len(q))
    found: list[tuple[int, np.ndarray, np.ndarray]] = []
    for part in DEPTHS:
        depth = int(len(x) * part)
        if depth < 1 or len(x) <= 4 * wanted or kind is object or not len(waiting):
            continue
        lower, upper = _bounds(x, up[waiting], down[waiting], depth)
        level = -np.partition(-lower, wanted - 1, axis=1)[:, wanted - 1]
        alive = upper >= level[:, None]
        few = alive.sum(axis=1) <= 16 * wanted
        for row in np.flatnonzero(few):
            left = np.flatnonzero(alive[row])
            found.append((waiting[row], left, x[left] @ q[waiting[row]]))
        waiting = waiting[~few]
    everything = np.arange(len(x))
    if len(waiting):
        scores = q[waiting] @ x.T
        found.extend((row, everything, own) for row, own in zip(waiting, scores))
    rows, out_ids, out_scores = [], [], []
    for row, left, scores in found:
        if len(left) > wanted:
            # All that reach the k-th score, so that ties are settled by id.
            reach = -np.partition(-scores, wanted - 1)[wanted - 1]
            near = scores >= reach
            left, scores = left[near], scores[near]
        other = ids[left] != query_ids[row]
        left, scores = left[other], scores[other]
        first = np.lexsort((ids[left], -scores))[:k] if kind is not object else sorted(range(len(left)), key=lambda i: (-scores[i], ids[left[i]]))[:k]
        rows.append(np.full(len(first), row))
        out_ids.append(ids[left[first]])
        out_scores.append(np.array([int(s) for s in scores[first]], np.int64))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(rows), np.concatenate(out_ids), np.concatenate(out_scores)


def exact_top_k(df: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id``, ``rank`` from 1, ``id_col`` and ``score``: the k best of all rows for each row
    for which ``is_query``, an expression over ``df``, holds."""
    rows = df.select(df[id_col].cast("long").alias("id"), whole_numbers(df[vector_col]).alias("vector"), is_query.alias("asks"))
    rows = rows.where("id IS NOT NULL AND vector IS NOT NULL").dropDuplicates(["id", "vector"]).withColumn("size", F.size("vector"))
    # One row per vector length, so no more than the longest vector has components.
    numbers = rows.groupBy("size").agg(
        F.ceil(F.count("*") / CANDIDATES_PER_BLOCK).alias("blocks"), F.ceil(F.count_if("asks") / QUERIES_PER_BLOCK).alias("asking")
    )
    rows = rows.join(F.broadcast(numbers.where("asking > 0")), "size").withColumn("h", F.xxhash64("id", "vector"))
    # Every block of candidates meets every part of the queries; each side knows how many the other has.
    last_part, last_block = F.floor((F.col("asking") - 1) / BLOCKS_PER_TASK), F.col("blocks") - 1
    candidates = _pack(rows.select("id", "vector", "size", last_part.alias("last"), F.expr("pmod(h, blocks)").alias("block")), "block")
    queries = _pack(rows.where("asks").select("id", "vector", "size", last_block.alias("last"), F.expr("pmod(h, asking)").alias("own")), "own")
    candidates = candidates.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), "last")))
    queries = queries.withColumn("part", F.floor(F.col("own") / BLOCKS_PER_TASK)).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), "last")))

    def search(key: tuple, own: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        out: list[pd.DataFrame] = []
        for ids, matrix in zip(own["ids"], own["matrix"]):
            ids = np.frombuffer(ids, np.int64)
            x = np.frombuffer(matrix, np.int64).reshape(len(ids), -1)
            for query_ids, query_matrix in zip(asking["ids"], asking["matrix"]):
                query_ids = np.frombuffer(query_ids, np.int64)
                q = np.frombuffer(query_matrix, np.int64).reshape(len(query_ids), -1)
                row, found, scores = best(ids, x, query_ids, q, k)
                asker = np.array([query_key(i, v) for i, v in zip(query_ids, q)], np.int64)
                out.append(pd.DataFrame({"query_id": query_ids[row], "asker": asker[row], "id": found, "score": scores}))
        empty = pd.DataFrame({c: np.zeros(0, np.int64) for c in ("query_id", "asker", "id", "score")})
        return pd.concat([empty, *out])

    keys = ("size", "block", "part")
    local = candidates.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInPandas(search, "query_id long, asker long, id long, score long")
    order = Window.partitionBy("query_id", "asker").orderBy(F.desc("score"), "id")
    return (
        local.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", F.col("id").alias(id_col), "score")
    )
