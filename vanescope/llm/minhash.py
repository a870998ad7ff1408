"""Near-duplicates by min-max hashing of word shingles, confirmed on the full sets.

Every permutation gives two signature values, the smallest and the largest hash of the set, so
half the hash evaluations of plain MinHash fill a signature. Bands of four values make buckets.
With ``BANDS`` of them a pair at a similarity of 0.85 meets in no bucket with a probability of
(1 - 0.85 ** 4) ** 20, about 4e-7, and one at 0.8 with about 3e-5. At the limit that is used this
is what the operator misses.

* Equal sets are one class, found by a digest of the sorted set; only classes enter buckets.
* Each bucket proposes its members to one of them, the centre: that which shares most buckets with
  others, as the original of many copies does. A bucket of m members makes m - 1 pairs. They are
  confirmed on the full sets and joined into components.
* Members that are not in their centre's component, the outsiders, may still be linked with others. With the
  members that are in it they are compared inside tasks, ``BLOCK`` by ``BLOCK`` at most, by counting
  common shingles for a whole block at once; only links leave the task.
* Outsiders are linked with each other by prefixes. Shingles are put in one order for all of them, rare ones
  first, by a table of counts of fixed size. Of two linked sets the first few shingles, as many as the
  limit and the sizes say, have one in common, at places that leave room for all others that must be. So
  pages that share a template, but not enough of it, are told apart by what is their own, and never
  paired. This loses nothing, whatever the order. What meets in a shingle is confirmed on the full sets.
* Members in one component are not compared, so groups of copies cost no pairs.

The set of a document: distinct shingles of ``SHINGLE`` words, each a 64-bit hash; a text with
fewer words has its whole sequence as one; a text without words, or NULL, has an empty set and is
linked with nothing. Repeated rows of one id count as one document. A row without id keeps its
set size, is linked with nothing and is not kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vanescope.llm.components import connected_components
from vanescope.llm.packed import packed_of, unpacked
from vanescope.llm.stored import stored
from vanescope.llm.text import Words, chunks, mix

SHINGLE = 5
#: Linked where 100 * intersection >= percent * union, with this percentage if no other is given.
LINK_PERCENT = 85
BANDS = 20
#: Permutations per band; each gives two values.
PER_BAND = 2
#: Members that are compared with one copy of their centre's text.
MEMBERS_PER_CENTRE = 64
#: Members on either side of a comparison inside a task.
BLOCK = 256
#: Bits of the number of counters by which shingles are ordered.
COUNTER_BITS = 18
#: Shingles that are counted at a time.
COUNTED_AT_ONCE = 1 << 18
#: First shingles that a task hands on at a time.
ROWS_AT_ONCE = 1 << 16

_random = np.random.default_rng(20240103)
_MASKS = _random.integers(0, 1 << 63, BANDS * PER_BAND, np.uint64)
_FACTORS = _random.integers(0, 1 << 63, BANDS * PER_BAND, np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(data: np.ndarray, bounds: np.ndarray, k: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each document of a chunk."""
    words = Words(data, bounds, lower=True)
    hashes, whole = words.grams(k)
    out = []
    for i in range(len(words.counts)):
        a, b = words.bounds[i], words.bounds[i + 1]
        if b - a >= k:
            out.append(np.unique(hashes[a:b][whole[a:b]]))
        else:
            out.append(words.whole(i) if b > a else hashes[:0])
    return out


def bands_of(sets: list[np.ndarray]) -> np.ndarray:
    """One row per set, none of them empty: a bucket number for each band."""
    values = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets[:-1]], dtype=np.int64)])
    out = np.empty((len(sets), BANDS), np.uint64)
    for band in range(BANDS):
        h = np.full(len(sets), band, np.uint64)
        for i in range(band * PER_BAND, (band + 1) * PER_BAND):
            permuted = (values ^ _MASKS[i]) * _FACTORS[i]
            h = mix(h ^ np.minimum.reduceat(permuted, starts))
            h = mix(h * np.uint64(3) ^ np.maximum.reduceat(permuted, starts))
        out[:, band] = h
    return out


def signatures(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``id``, ``n_shingles``, ``digest`` of the set and ``bands``, the bucket of each band."""
    rows = df.select(df[id_col].cast("long").alias("id"), df[text_col].cast("string").alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, bounds in chunks(batch.column(1)):
                sets = shingle_sets(data, bounds)
                full = [s for s in sets if len(s)]
                buckets = iter(bands_of(full).view(np.int64) if full else ())
                yield pa.record_batch(
                    [
                        batch.column(0).slice(first, end - first),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([hashlib.md5(s).digest() if len(s) else None for s in sets], pa.binary()),
                        pa.array([next(buckets) if len(s) else [] for s in sets], pa.list_(pa.int64())),
                    ],
                    names=["id", "n_shingles", "digest", "bands"],
                )

    return rows.mapInArrow(run, "id long, n_shingles long, digest binary, bands array<long>")


def _set_of(text: bytes) -> np.ndarray:
    return shingle_sets(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0]


def confirm(pairs: DataFrame, texts: DataFrame, percent: int = LINK_PERCENT) -> DataFrame:
    """Those of ``pairs`` (a, b) whose full sets are similar enough; ``texts`` as ``packed`` gives them.

    Members of a pair are dealt out by their centre ``a`` and a salt, so that each copy of the
    centre's text serves ``MEMBERS_PER_CENTRE`` members at most on average, and a centre with
    very many members is spread over many tasks. One document is held at a time, besides the centre.
    """
    sizes = pairs.groupBy("a").agg(F.ceil(F.count("*") / MEMBERS_PER_CENTRE).alias("salts"))
    salted = pairs.join(sizes, "a").select("a", "b", F.expr("pmod(xxhash64(b), salts)").alias("salt"))
    members = salted.join(texts, F.col("b") == F.col("id")).select("a", "salt", "b", "size", "packed")
    centres = (
        salted.select("a", "salt").distinct().join(texts, F.col("a") == F.col("id"))
        .select("a", "salt", F.lit(None).cast("long").alias("b"), "size", "packed")
    )
    dealt = centres.union(members).repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, centre = None, []
        for batch in batches:
            a, salt, b = (batch.column(i).to_pylist() for i in range(3))
            linked = []
            for i, text in unpacked(batch):
                own = _set_of(text)
                if b[i] is None:
                    # Rows that repeat an id are texts of one document.
                    centre = [*centre, own] if key == (a[i], salt[i]) else [own]
                    key = (a[i], salt[i])
                elif any(similar(other, own, percent) for other in centre):
                    linked.append((a[i], b[i]))
            yield pa.record_batch(
                [pa.array([x for x, _ in linked], pa.int64()), pa.array([y for _, y in linked], pa.int64())], names=["a", "b"]
            )

    return dealt.mapInArrow(run, "a long, b long").distinct()


def similar(x: np.ndarray, y: np.ndarray, percent: int = LINK_PERCENT) -> bool:
    """Whether two sorted sets are linked."""
    small, large = sorted((len(x), len(y)))
    if not small or 100 * small < percent * large:
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (small + large - both)


def links_between(x: list[np.ndarray], y: list[np.ndarray], percent: int = LINK_PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of all linked pairs of non-empty sets. Shingles that many sets hold are counted as a
    product of matrices, the others by their lists of holders."""
    sizes = [np.array([len(s) for s in side]) for side in (x, y)]
    values, place = np.unique(np.concatenate([*x, *y]), return_inverse=True)
    of = np.repeat(np.arange(len(x) + len(y)), np.concatenate(sizes))
    left = of < len(x)
    held = [np.bincount(place[left], minlength=len(values)), np.bincount(place[~left], minlength=len(values))]
    both = (held[0] > 0) & (held[1] > 0)
    many = both & (held[0] + held[1] >= 32)
    common = np.zeros((len(x), len(y)), np.float32)
    column = np.cumsum(many) - 1
    for part in range(0, int(many.sum()), 4096):
        mine = many[place] & (column[place] >= part) & (column[place] < part + 4096)
        dense = np.zeros((len(x) + len(y), 4096), np.float32)
        dense[of[mine], column[place[mine]] - part] = 1
        common += dense[: len(x)] @ dense[len(x) :].T
    few = (both & ~many)[place]
    order = np.argsort(place[few & left], kind="stable")
    at, who = place[few & left][order], of[few & left][order]
    asked, their = place[few & ~left], of[few & ~left] - len(x)
    # Each has fewer than 32 holders on the other side, so a part makes two million pairs at most.
    for part in range(0, len(asked), 1 << 16):
        own = asked[part : part + (1 << 16)]
        first, count = np.searchsorted(at, own, "left"), np.searchsorted(at, own, "right")
        count -= first
        rows = who[np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)]
        np.add.at(common, (rows, np.repeat(their[part : part + (1 << 16)], count)), 1)
    together = sizes[0][:, None] + sizes[1] - common
    return np.nonzero(100 * common.astype(np.int64) >= percent * together.astype(np.int64))


def prefix_lengths(n: np.ndarray | int, percent: int) -> tuple:
    """How many of its first shingles a set of ``n`` shows to sets that are not smaller, and to ones not larger.

    Two linked sets have ``percent`` of the larger one's shingles in common, and of the smaller one's
    at least as many as two sets of its size would.
    """
    return n + (-2 * percent * n) // (100 + percent) + 1, n + (-percent * n) // 100 + 1


def shingle_counts(texts: DataFrame) -> np.ndarray:
    """In how many texts a shingle occurs, added up over the shingles of each counter."""
    bits = COUNTER_BITS

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << bits, np.int64)
        waiting, size = [np.zeros(0, np.int64)], 0
        for batch in batches:
            for _, text in unpacked(batch):
                waiting.append(_counter(_set_of(text), bits))
                size += len(waiting[-1])
                if size >= COUNTED_AT_ONCE:
                    counts += np.bincount(np.concatenate(waiting), minlength=1 << bits)
                    waiting, size = waiting[:1], 0
        counts += np.bincount(np.concatenate(waiting), minlength=1 << bits)
        used = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(used), pa.array(counts[used])], names=["counter", "n"])

    # As many lines as counters, at most.
    total = texts.mapInArrow(run, "counter long, n long").groupBy("counter").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(1 << bits, np.int64)
    out[total.column(0).to_numpy()] = total.column(1).to_numpy()
    return out


def _counter(shingles: np.ndarray, bits: int) -> np.ndarray:
    return (shingles >> np.uint64(64 - bits)).astype(np.int64)


def first_shingles(texts: DataFrame, percent: int) -> DataFrame:
    """(id, n, place, shingle, shown): the first shingles of each set, rare ones first; ``shown`` are those
    that sets which are not smaller look for."""
    bits = COUNTER_BITS
    counts = texts.sparkSession.sparkContext.broadcast(shingle_counts(texts))

    def rows_of(parts: list[tuple]) -> pa.RecordBatch:
        one, n, place, shingle, shown = (np.concatenate(column) for column in zip(*parts))
        return pa.record_batch([*(pa.array(c) for c in (one, n, place, shingle, shown))], names=["id", "n", "place", "shingle", "shown"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, size = [], 0
            for row, text in unpacked(batch):
                own = _set_of(text)
                shown, looked_for = prefix_lengths(len(own), percent)
                order = np.lexsort((own, counts.value[_counter(own, bits)]))[:looked_for]
                place = np.arange(len(order))
                one = np.full(len(order), batch.column(0)[row].as_py(), np.int64)
                parts.append((one, np.full(len(order), len(own)), place, own[order].view(np.int64), place < shown))
                size += len(order)
                if size >= ROWS_AT_ONCE:
                    yield rows_of(parts)
                    parts, size = [], 0
            if parts:
                yield rows_of(parts)

    return texts.mapInArrow(run, "id long, n long, place long, shingle long, shown boolean")


def pairs_by_prefix(texts: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components among ``texts`` (id, size, packed), all that are linked among them."""
    first = stored(first_shingles(texts, percent).join(roots.withColumnRenamed("node", "id"), "id", "left"), "first-shingles")
    first = first.withColumn("root", F.coalesce("root", "id"))
    shown = first.where("shown").select("shingle", *[F.col(c).alias(f"_{c}") for c in ("id", "n", "place", "root")])
    # The larger one looks for the smaller one; what is left of both behind the common shingle must suffice.
    met = first.join(shown, "shingle").where(
        f"root <> _root AND (n > _n OR n = _n AND id > _id) AND 100 * _n >= {percent} * n"
        f" AND {100 + percent} * least(n - place, _n - _place) >= {percent} * (n + _n)"
    )
    return met.select(F.least("id", "_id").alias("a"), F.greatest("id", "_id").alias("b")).distinct()


def settle(stars: DataFrame, roots: DataFrame, texts: DataFrame, percent: int = LINK_PERCENT) -> DataFrame:
    """Links (a, b) of members that are not in their centre's component, with members of other components."""
    named = roots.withColumnRenamed("node", "b")
    placed = stars.join(named, "b", "left").select("a", "b", F.coalesce("root", "b").alias("root"))
    centres = roots.withColumnRenamed("node", "a").withColumnRenamed("root", "own")
    placed = placed.join(centres, "a", "left").withColumn("outside", F.col("root") != F.coalesce("own", "a")).drop("own")
    placed = stored(placed, "placed")
    outsiders = texts.join(placed.where("outside").select(F.col("b").alias("id")).distinct(), "id", "left_semi")
    among = confirm(stored(pairs_by_prefix(outsiders, roots, percent), "pairs"), texts, percent)
    return among.union(_links_inside(placed, texts, percent)).distinct()


def _links_inside(placed: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between outsiders of a star and members that are in the component of its centre."""
    counts = placed.groupBy("a").agg(
        F.ceil(F.count_if(~F.col("outside")) / BLOCK).alias("columns"), F.ceil(F.count_if("outside") / BLOCK).alias("lines")
    )
    open_ = placed.join(counts.where("columns > 0 AND lines > 0"), "a")
    # Every block of outsiders meets every block of the others.
    member = open_.where("NOT outside").selectExpr("a", "b", "root", "lines", "pmod(xxhash64(b), columns) AS j")
    member = member.withColumn("i", F.explode(F.expr("sequence(0L, lines - 1)"))).select("a", "i", "j", F.lit(1).alias("side"), "b", "root")
    asking = open_.where("outside").selectExpr("a", "b", "root", "columns", "pmod(xxhash64(b, 7), lines) AS i")
    asking = asking.withColumn("j", F.explode(F.expr("sequence(0L, columns - 1)"))).select("a", "i", "j", F.lit(0).alias("side"), "b", "root")
    dealt = member.union(asking).join(texts, F.col("b") == F.col("id")).drop("id")
    dealt = dealt.repartition("a", "i", "j").sortWithinPartitions("a", "i", "j", "side")

    def compare(group: list[tuple], sets: list[np.ndarray]) -> Iterator[tuple[int, int]]:
        asking = [k for k, row in enumerate(group) if row[3] == 0]
        members = [k for k, row in enumerate(group) if row[3] == 1]
        if asking and members:
            for i, j in zip(*links_between([sets[k] for k in asking], [sets[k] for k in members], percent)):
                x, y = group[asking[i]], group[members[j]]
                if x[5] != y[5]:
                    yield min(x[4], y[4]), max(x[4], y[4])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        sets: list[np.ndarray] = []
        found: list[tuple[int, int]] = []
        for batch in batches:
            rows = list(zip(*(batch.column(i).to_pylist() for i in range(6))))
            for i, text in unpacked(batch):
                if group and group[0][:3] != rows[i][:3]:
                    found.extend(compare(group, sets))
                    group, sets = [], []
                group.append(rows[i])
                sets.append(_set_of(text))
        found.extend(compare(group, sets))
        yield pa.record_batch([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], names=["a", "b"])

    return dealt.mapInArrow(run, "a long, b long").distinct()


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = LINK_PERCENT) -> DataFrame:
    """Per row of ``df``: id, ``n_shingles``, ``component_id`` and ``kept``; linked from ``percent`` on."""
    rows = stored(signatures(df, id_col, text_col), "signatures")
    some = rows.where("id IS NOT NULL AND n_shingles > 0")
    classes = stored(some.groupBy("digest").agg(F.min("id").alias("node")), "classes")
    buckets = (
        some.join(classes, (some.digest == classes.digest) & (some.id == classes.node))
        .select("node", F.explode("bands").alias("bucket"))
    )
    crowded = buckets.groupBy("bucket").agg(F.count("*").alias("members"), F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    crowd = stored(buckets.join(crowded.select("bucket", "members"), "bucket").distinct(), "crowd")
    mates = crowd.groupBy("node").agg(F.sum("members").alias("mates"))
    centres = crowd.join(mates, "node").groupBy("bucket").agg(F.max(F.struct("mates", (-F.col("node")).alias("node"))).alias("top"))
    centres = centres.select("bucket", (-F.col("top.node")).alias("a"))
    stars = stored(crowd.join(centres, "bucket").where("node <> a").select("a", F.col("node").alias("b")).distinct(), "stars")
    nodes = stars.select(F.col("a").alias("id")).union(stars.select("b")).distinct()
    every = df.select(df[id_col].cast("long").alias("id"), df[text_col].cast("string").alias("text"))
    texts = stored(packed_of(every, nodes), "texts")
    edges = stored(confirm(stars, texts, percent), "links")
    roots = stored(connected_components(edges), "roots")
    more = stored(settle(stars, roots, texts, percent), "links")
    if not more.isEmpty():
        roots = stored(connected_components(edges.union(more)), "roots")

    # Rows without a set get a key of their own, so that they don't meet in one task.
    own_key = F.coalesce(F.when(F.col("n_shingles") > 0, F.hex("digest")), F.concat(F.lit("-"), F.xxhash64("id").cast("string")))
    return (
        rows.select("id", "n_shingles", own_key.alias("key"))
        .join(classes.select(F.hex("digest").alias("key"), "node"), "key", "left")
        .join(roots, "node", "left")
        .select(
            F.col("id").alias(id_col),
            "n_shingles",
            F.when(F.col("id").isNotNull(), F.coalesce("root", "node", "id")).alias("component_id"),
            F.coalesce(F.col("id") == F.coalesce("root", "node", "id"), F.lit(False)).alias("kept"),
        )
    )
