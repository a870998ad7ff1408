"""Substring de-duplication by seed and extend on winnowed word anchors.

A window is ``WINDOW`` consecutive words. A document loses every word covered by a window whose
words also start in a document with a smaller id.

* Seeds. Of every ``WINDOW - ANCHOR + 1`` consecutive ``ANCHOR``-grams the one with the smallest
  hash is an anchor, so every window holds one, in the same place wherever its words recur.
  The windows of one anchor are consecutive; together they span the words around it.
* Join. Documents meet on anchor hashes. Minimum and maximum of document and span are enough,
  with partial sums, so an anchor in a third of all documents costs one row per task.
* Extend. Where all documents of an anchor agree on its whole span, the seed extends over all
  its windows, and all but the first document lose them. Where they differ, each window around
  the anchor is compared on its own, which finds how far each match reaches to either side.
* Overlapping and adjacent matches merge into maximal repeats, and their words go.

Words are compared by 64-bit hashes. Only hashes and ids are shuffled until the last step, which
brings each text together with the hashes of its repeats; texts travel compressed.

Defined results: a NULL or empty text has no words; rows without id neither lose words nor make
others lose any; rows that repeat an id are the same document and do not repeat each other.
Texts with fewer words than a window stay whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanescope.llm.packed import packed, unpacked
from vanescope.llm.stored import stored
from vanescope.llm.text import SPACE_WORD, Words, _powers, chunks, mix

WINDOW = 13
ANCHOR = 5


def _smallest(h: np.ndarray, width: int) -> np.ndarray:
    """For each start, the leftmost position of the smallest of ``width`` values."""
    at = np.arange(len(h))
    done = 1
    while done < width:
        step = min(done, width - done)
        left, right = h[:-step], h[step:]
        take = right < left
        h, at, done = np.where(take, right, left), np.where(take, at[step:], at[:-step]), done + step
    return at


class Seeds:
    """Anchors of a chunk with the windows of each."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        self.words = words = Words(data, bounds, SPACE_WORD)
        n = len(words.hashes)
        grams, _ = words.grams(ANCHOR)
        #: First words of all windows.
        self.windows = np.flatnonzero(np.arange(WINDOW, n + WINDOW) <= words.ends_of_documents())
        if not len(self.windows):
            self.first = self.window_of = np.zeros(0, np.int64)
            self.anchors = np.zeros(0, np.uint64)
            self.document = np.zeros(0, np.int64)
            return
        anchor_at = _smallest(grams, WINDOW - ANCHOR + 1)[self.windows]
        new = np.concatenate([[True], anchor_at[1:] != anchor_at[:-1]])
        #: First window of each anchor, and the anchor of each window.
        self.first = np.flatnonzero(new)
        self.window_of = np.cumsum(new) - 1
        self.anchors = grams[anchor_at[self.first]]
        self.document = np.searchsorted(words.bounds, self.windows[self.first], "right") - 1

    def spans(self) -> np.ndarray:
        """Hash of the words that the windows of each anchor cover."""
        n = len(self.words.hashes)
        up, down = _powers.get(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(self.words.hashes * up[:n], out=total[1:])
        start = self.windows[self.first]
        end = self.windows[np.append(self.first[1:], len(self.windows)) - 1] + WINDOW
        length = (end - start).astype(np.uint64)
        return mix((total[end] - total[start]) * down[start] + length)


def _listed(column: pa.ListArray, row: int) -> np.ndarray:
    value = column[row]
    return value.values.to_numpy(zero_copy_only=False).view(np.uint64) if value.is_valid else np.zeros(0, np.uint64)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _seeds(rows: DataFrame, with_spans: bool) -> DataFrame:
    """(anchor, id) or (anchor, span, id), each once per row of the table."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, _, data, bounds in chunks(batch.column(1)):
                seeds = Seeds(data, bounds)
                key = seeds.anchors * np.uint64(3) ^ mix(seeds.document.astype(np.uint64))
                spans = seeds.spans() if with_spans and len(key) else key[:0]
                _, once = np.unique(mix(key ^ spans * np.uint64(5) if with_spans else key), return_index=True)
                columns = [_signed(seeds.anchors[once]), *([_signed(spans[once])] if with_spans else [])]
                ids = batch.column(0).take(pa.array(seeds.document[once] + first))
                yield pa.record_batch([*columns, ids], names=["anchor", *(["span"] if with_spans else []), "id"])

    return rows.mapInArrow(run, "anchor long, span long, id long" if with_spans else "anchor long, id long")


def _single(text: bytes) -> Seeds:
    return Seeds(np.frombuffer(text, np.uint8), np.array([0, len(text)]))


def _windows(rows: DataFrame) -> DataFrame:
    """(window, id) of the windows around the anchors in ``open``, each once per row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, of = [], []
            lists = batch.column(batch.schema.get_field_index("open"))
            for row, text in unpacked(batch):
                seeds = _single(text)
                use = np.isin(seeds.anchors, _listed(lists, row))[seeds.window_of]
                own = np.unique(seeds.words.grams(WINDOW)[0][seeds.windows[use]])
                found.append(own)
                of.append(np.full(len(own), row))
            hashes = np.concatenate(found) if found else np.zeros(0, np.uint64)
            ids = batch.column(0).take(pa.array(np.concatenate(of) if of else np.zeros(0, np.int64)))
            yield pa.record_batch([_signed(hashes), ids], names=["window", "id"])

    return rows.mapInArrow(run, "window long, id long")


def _cut(text: bytes, anchors: np.ndarray, windows: np.ndarray) -> tuple[int, int, bytes]:
    """Number of words, of words removed, and the other words joined by one space."""
    seeds = _single(text)
    words = seeds.words
    n = len(words.hashes)
    gone = np.zeros(n, bool)
    if len(seeds.windows) and len(anchors) + len(windows):
        repeats = np.isin(seeds.anchors, anchors)[seeds.window_of]
        repeats |= np.isin(words.grams(WINDOW)[0][seeds.windows], windows)
        edges = np.zeros(n + 1, np.int64)
        start = seeds.windows[repeats]
        np.add.at(edges, start, 1)
        np.add.at(edges, start + WINDOW, -1)
        gone = np.cumsum(edges[:n]) > 0
    if gone.any():
        kept = b" ".join([text[a:b] for a, b in zip(words.starts[~gone].tolist(), words.ends[~gone].tolist())])
    else:
        kept = b" ".join(text.split())
    return n, int(gone.sum()), kept


def _remove(rows: DataFrame, schema: str) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            covered, repeated = (batch.column(batch.schema.get_field_index(c)) for c in ("covered", "repeated"))
            out, first, size = [], 0, 0
            for row, text in unpacked(batch):
                out.append(_cut(text, _listed(covered, row), _listed(repeated, row)))
                size += len(text)
                if size > 1 << 22 or row + 1 == batch.num_rows:
                    yield pa.record_batch(
                        [
                            batch.column(0).slice(first, len(out)),
                            pa.array([x[0] for x in out], pa.int64()),
                            pa.array([x[1] for x in out], pa.int64()),
                            pa.array([x[2].decode("utf-8", "replace") for x in out], pa.string()),
                        ],
                        names=["id", "n_words", "n_removed", "kept_text"],
                    )
                    out, first, size = [], row + 1, 0

    return rows.mapInArrow(run, schema)


def _removal(named: DataFrame) -> DataFrame:
    """(id, covered, repeated): hashes of the anchors, and of the windows, by which a document loses words."""
    shared = (
        _seeds(named, with_spans=True)
        .groupBy("anchor")
        .agg(F.min("id").alias("first"), F.max("id").alias("last"), F.min("span").alias("low"), F.max("span").alias("high"))
        .where("first < last")
        .select("anchor", "first", F.expr("low = high").alias("uniform"))
    )
    listed = stored(
        _seeds(named, with_spans=False)
        .join(shared, "anchor")
        .where("NOT uniform OR id > first")
        .groupBy("id")
        .agg(
            F.collect_set(F.when(F.col("uniform"), F.col("anchor"))).alias("covered"),
            F.collect_set(F.when(~F.col("uniform"), F.col("anchor"))).alias("open"),
        ),
        "anchors",
    )
    undecided = listed.where(F.size("open") > 0).select("id", "open")
    windows = stored(_windows(packed(named).join(undecided, "id")), "windows")
    first = windows.groupBy("window").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last")
    repeated = (
        windows.join(first, "window").where("id > first")
        .groupBy("id").agg(F.collect_set("window").alias("repeated"))
    )
    return listed.where(F.size("covered") > 0).select("id", "covered").join(repeated, "id", "full")


def _texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(df[id_col].cast("long").alias("id"), df[text_col].cast("string").alias("text"))


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``df``: id, ``n_words``, ``n_removed`` and ``kept_text``, the words that stay
    joined by one space."""
    rows = _texts(df, id_col, text_col)
    removal = _removal(rows.where("id IS NOT NULL"))
    joined = packed(rows).join(removal, "id", "left")
    return _remove(joined, "id long, n_words long, n_removed long, kept_text string").withColumnRenamed("id", id_col)


def cut_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size_col: str = "n_chars") -> DataFrame:
    """``df`` with its columns and rows, texts without their repeats. A text that loses no word is
    unchanged; of another the words that stay are joined by one blank, and ``size_col``, if there is such
    a column, becomes the number of its characters."""
    rows = _texts(df, id_col, text_col)
    removal = _removal(rows.where("id IS NOT NULL")).withColumnsRenamed({"id": "__id", "covered": "__covered", "repeated": "__repeated"})
    joined = df.join(removal, df[id_col].cast("long") == F.col("__id"), "left")
    names, at, size_at = df.columns, df.columns.index(text_col), df.columns.index(size_col) if size_col in df.columns else None

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            covered, repeated = (batch.column(batch.schema.get_field_index(c)) for c in ("__covered", "__repeated"))
            for first, end, data, bounds in chunks(batch.column(at).cast(pa.string())):
                part = batch.slice(first, end - first)
                columns = list(part.columns[: len(names)])
                changed = {}
                for row in range(first, end):
                    if covered[row].is_valid or repeated[row].is_valid:
                        text = bytes(data[bounds[row - first] : bounds[row - first + 1]])
                        _, gone, kept = _cut(text, _listed(covered, row), _listed(repeated, row))
                        if gone:
                            changed[row - first] = kept.decode("utf-8", "replace")
                if changed:
                    for i, new in ((at, lambda t: t), (size_at, len)):
                        if i is not None:
                            values = columns[i].to_pylist()
                            for row, text in changed.items():
                                values[row] = new(text)
                            columns[i] = pa.array(values, columns[i].type)
                yield pa.record_batch(columns, names=names)

    return joined.mapInArrow(run, df.schema)
