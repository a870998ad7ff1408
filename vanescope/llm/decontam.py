"""Benchmark items found in documents under edits, by CGK embedding and bit-sampling LSH.

A leak is a run of words, of any length, at most one edit per ``WORDS_PER_EDIT`` words of the item
from the item, where an edit inserts, deletes or replaces a word. Words are runs of letters and
digits, A-Z lower-cased, so punctuation and line breaks do not matter.

* Windows. Each edit spoils three of an item's word triples at most, so a leak keeps a known number
  of triples. Every word position of every document is tested; where too few triples of any item
  lie within its words and edits there cannot be a leak. This test loses nothing. From each place
  where a leak may start a window of the item's words is taken, or what the document still has.
* CGK embedding. A window is walked ``3 * words`` steps; each step emits the current word and a
  random bit of step and word says whether to go on to the next. Two walks over similar texts meet
  again after an edit, so edits become few differing places: edit distance becomes Hamming distance.
* Bit sampling. Sampled places of each walk hash to a key. Items have the same keys. Their number
  per walk is set by trial for each class of about equally long items: items with the allowed number
  of random edits must share a key with their originals in at least ``RECALL`` of all cases. Where
  the most keys don't reach that, and for items of more than ``MOST_KEYED`` words, no keys are used:
  every place where enough triples lie is a candidate.
* Candidates are verified with the words around them, as many on either side as
  there may be edits, by the least edit distance of any run of these words.

Items are sent to the executors in slices of bounded size; documents are never shuffled.

Defined results: one row per document and item, with the best run, the first one if several are
as good, and the shortest of those. NULL or empty texts have no windows. Items with fewer than ``MIN_WORDS``
words have too few triples to bear an edit; they are found where all their words stand in a row, with distance 0. Items
without id, text or a word cannot be searched. Items may repeat.
Rows without id are searched too and keep their NULL.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vanescope.llm.text import ALNUM_WORD, Words, chunks, mix

WORDS_PER_EDIT = 5
MIN_WORDS = 8
RECALL = 0.97
WALKS = 8
SAMPLED = 3
MAX_KEYS_PER_WALK = 32
#: Words of the longest items that are sought by keys.
MOST_KEYED = 512
#: Trials per class of length, and how many times as long as the shortest items of a class others may be.
TRIALS = 512
CLASS_RATIO = 1.25
#: Bytes of item text that are searched for in one pass over the documents.
SLICE_BYTES = 8 << 20
#: Windows that are embedded at a time.
WINDOWS_AT_ONCE = 512
#: Words of documents that are aligned at a time, or one longer region.
ALIGNED_AT_ONCE = 1 << 17

_FILTER_BITS = 22
_random = np.random.default_rng(20240104)
_PLACES = _random.random((WALKS, MAX_KEYS_PER_WALK, SAMPLED))
_WALK_SALTS = _random.integers(1, 1 << 63, WALKS, np.uint64)


def edits(n_words: np.ndarray) -> np.ndarray:
    """Edits that still make a leak."""
    return n_words // WORDS_PER_EDIT


def embed(words: np.ndarray, start: np.ndarray, length: np.ndarray, steps: int | None = None) -> np.ndarray:
    """CGK walks over windows of word hashes: windows x walks x steps; after the end, zero."""
    n, steps = len(start), steps or 3 * int(length.max(initial=0))
    out = np.zeros((n, WALKS, steps), np.uint64)
    at = np.zeros((n, WALKS), np.int64)
    first, size = start[:, None], length[:, None]
    for step in range(steps):
        inside = at < size
        word = words[np.minimum(first + at, len(words) - 1)]
        out[:, :, step] = np.where(inside, word, 0)
        coin = mix((word ^ _WALK_SALTS) + np.uint64((2 * step + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        at += inside & (coin >> np.uint64(63)).astype(bool)
    return out


def sampled_keys(walks: np.ndarray, length: np.ndarray, per_walk: int) -> np.ndarray:
    """windows x keys: hashes of sampled places. ``length`` is that of the item sought; walks end
    after about two steps per word, so places are sampled from that part."""
    rows = np.arange(len(length))[:, None]
    keys = np.empty((len(length), WALKS, per_walk), np.uint64)
    for walk in range(WALKS):
        h = np.empty((len(length), per_walk), np.uint64)
        h[:] = mix(np.arange(walk * MAX_KEYS_PER_WALK, walk * MAX_KEYS_PER_WALK + per_walk, dtype=np.uint64))
        h = mix(h + length.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15))
        for i in range(SAMPLED):
            place = (_PLACES[walk, :per_walk, i] * (2 * length[:, None])).astype(np.int64)
            h = mix(h * np.uint64(3) ^ walks[rows, walk, place])
        keys[:, walk] = h
    return keys.reshape(len(length), -1)


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Edit distance of each row of ``x`` and the same row of ``y``, by words."""
    pairs, n = y.shape
    along = np.arange(n + 1)
    row = np.broadcast_to(along, (pairs, n + 1)).copy()
    for i in range(x.shape[1]):
        new = np.empty_like(row)
        new[:, 0] = i + 1
        new[:, 1:] = np.minimum(row[:, :-1] + (x[:, i : i + 1] != y), row[:, 1:] + 1)
        row = np.minimum.accumulate(new - along, axis=1) + along
    return row[:, -1]


def best_runs(x: np.ndarray, y: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distance, start, end) of the run of words nearest to each row of ``x`` in the same row of
    ``y``, whose first ``size`` words count; the first and then shortest one of several."""
    pairs, width = y.shape
    over = np.arange(width) >= size[:, None]
    # Distance and start as one number, the distance first: a run may start anywhere.
    one = width + 1
    along = np.arange(width + 1)
    row = np.broadcast_to(along, (pairs, width + 1)).copy()
    along = along * one
    for i in range(x.shape[1]):
        new = np.empty_like(row)
        new[:, 0] = row[:, 0] + one
        new[:, 1:] = np.minimum(row[:, :-1] + one * ((x[:, i : i + 1] != y) | over), row[:, 1:] + one)
        row = np.minimum.accumulate(new - along, axis=1) + along
    end = row.argmin(axis=1)
    best = row[np.arange(pairs), end]
    return best // one, best % one, end


def _spread(low: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers low, low + 1, ... of each row, ``count`` of them."""
    return np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)


class Index:
    """Items of one slice: words, triples and LSH keys."""

    def __init__(self, ids: list[int], texts: list[str]):
        words = Words(*_joined(texts), ALNUM_WORD, lower=True)
        long = [i for i in range(len(ids)) if words.counts[i] >= MIN_WORDS]
        #: For each number of words below ``MIN_WORDS``: hashes of the items in ascending order, and their ids.
        self.short: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n in range(1, MIN_WORDS):
            own = np.flatnonzero(words.counts == n)
            if len(own):
                hashes = words.grams(n)[0][words.bounds[:-1][own]]
                order = np.argsort(hashes, kind="stable")
                self.short[n] = hashes[order], np.array(ids, np.int64)[own[order]]
        self.ids = np.array([ids[i] for i in long], np.int64)
        self.words = words.hashes
        self.start = words.bounds[:-1][long]
        self.length = words.counts[long]
        triples, _ = words.grams(3)
        own = [np.unique(triples[a : a + n - 2]) for a, n in zip(self.start, self.length)]
        every = np.concatenate([*own, triples[:0]])
        of = np.repeat(np.arange(len(long)), [len(x) for x in own])
        order = np.argsort(every, kind="stable")
        #: The items of each triple: triple_items[first[i] : first[i + 1]] for triples[i].
        self.triples, first = np.unique(every[order], return_index=True)
        self.first, self.triple_items = np.append(first, len(every)), of[order]
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[(self.triples >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
        #: How many triples of an item a leak of it still holds.
        self.least = self.length - 2 - 3 * edits(self.length)
        classes = (np.log(np.maximum(self.length, 1)) / np.log(CLASS_RATIO)).astype(np.int64)
        #: Keys per walk of each item, as of its class; 0 where every place is verified.
        self.per_walk = np.zeros(len(long), np.int64)
        keys, of = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for kind in np.unique(classes[self.length <= MOST_KEYED]):
            own = np.flatnonzero((classes == kind) & (self.length <= MOST_KEYED))
            per_walk = self._keys_for_recall(own)
            self.per_walk[own] = per_walk
            for at in range(0, len(own) if per_walk else 0, WINDOWS_AT_ONCE):
                some = own[at : at + WINDOWS_AT_ONCE]
                keys.append(sampled_keys(embed(self.words, self.start[some], self.length[some]), self.length[some], per_walk).ravel())
                of.append(np.repeat(some, WALKS * per_walk))
        flat, items = np.concatenate(keys), np.concatenate(of)
        order = np.argsort(flat, kind="stable")
        self.keys, self.key_items = flat[order], items[order]

    def _keys_for_recall(self, items: np.ndarray) -> int:
        """Keys per walk at which these items with the allowed random edits are found often enough,
        0 if they never are."""
        random = np.random.default_rng(20240105)
        tried = random.choice(items, min(64, len(items)), replace=False)
        found, trials = np.zeros(MAX_KEYS_PER_WALK), -(-TRIALS // len(tried))
        for item in tried:
            n = int(self.length[item])
            changed = []
            for _ in range(trials):
                own = list(self.words[self.start[item] : self.start[item] + n])
                for _ in range(int(edits(n))):
                    at, kind = int(random.integers(len(own))), int(random.integers(3))
                    new = np.uint64(random.integers(1, 1 << 63))
                    own[at : at + (kind != 1)] = [new] if kind != 2 else []
                # A window is as long as the item: what follows in the document fills it up.
                own.extend(random.integers(1, 1 << 63, max(0, n - len(own)), np.uint64))
                changed.append(np.array(own[:n], np.uint64))
            both = np.concatenate([*changed, self.words[self.start[item] : self.start[item] + n]])
            length = np.full(trials + 1, n)
            walks = embed(both, np.arange(trials + 1) * n, length)
            keys = sampled_keys(walks, length, MAX_KEYS_PER_WALK).reshape(trials + 1, WALKS, -1)
            agree = (keys[:-1] == keys[-1]).any(axis=1)
            found += np.logical_or.accumulate(agree, axis=1).mean(axis=0) / len(tried)
        enough = np.flatnonzero(found >= RECALL)
        return int(enough[0]) + 1 if len(enough) else 0

    def places(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, first, last): places from first to last where a leak of the item may start."""
        n = len(words.hashes)
        nothing = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not len(self.ids) or n < 3:
            return nothing
        triples, whole = words.grams(3)
        maybe = np.flatnonzero(self.filter[(triples >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] & whole)
        triple = np.minimum(np.searchsorted(self.triples, triples[maybe]), len(self.triples) - 1)
        same = self.triples[triple] == triples[maybe]
        at, triple = maybe[same], triple[same]
        # One row per place and item that has the triple, by item and place.
        low, count = self.first[triple], self.first[triple + 1] - self.first[triple]
        item = self.triple_items[_spread(low, count)]
        at = np.repeat(at, count)
        order = np.argsort(item, kind="stable")
        item, at = item[order], at[order]
        # Runs of just enough triples that fit the longest leak; it may start from before the last
        # one's reach up to the first one.
        last = np.arange(len(item)) + self.least[item] - 1
        fits = last < len(item)
        first, last = np.flatnonzero(fits), last[fits]
        reach = self.length[item[first]] + edits(self.length[item[first]]) - 3
        fits = (item[last] == item[first]) & (at[last] - at[first] <= reach)
        # A leak lies in one document.
        fits[fits] = words.ends_of_documents()[at[first[fits]]] > at[last[fits]]
        first, last, reach = first[fits], last[fits], reach[fits]
        begin = np.repeat(words.bounds[:-1], words.counts)[at[first]]
        return item[first], np.maximum(at[last] - reach, begin), at[first]

    def candidates(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, first, last) of those places whose windows share a key with the item, and of all
        places of items without keys."""
        item, low, high = self.places(words)
        keyed = self.per_walk[item] > 0
        whole = item[~keyed], low[~keyed], high[~keyed]
        item, low, high = item[keyed], low[keyed], high[keyed]
        count = high - low + 1
        width = int(self.length.max(initial=0)) + 1
        both = np.unique(_spread(low, count) * width + np.repeat(self.length[item], count))
        starts, lengths = both // width, both % width
        per_walk = np.zeros(width, np.int64)
        per_walk[self.length[item]] = self.per_walk[item]
        ends = words.ends_of_documents()
        pairs = [np.zeros(0, np.int64)]
        # Windows of one number of keys, and so of about one length, at a time.
        order = np.argsort(per_walk[lengths], kind="stable")
        starts, lengths, keys_of = starts[order], lengths[order], per_walk[lengths[order]]
        cuts = np.unique(np.concatenate([np.arange(0, len(starts), WINDOWS_AT_ONCE), np.flatnonzero(np.diff(keys_of)) + 1, [len(starts)]]).astype(np.int64))
        for at, end in zip(cuts[:-1], cuts[1:]):
            start, length = starts[at:end], lengths[at:end]
            walks = embed(words.hashes, start, np.minimum(length, ends[start] - start), 3 * int(length.max()))
            keys = sampled_keys(walks, length, int(keys_of[at]))
            low = np.searchsorted(self.keys, keys.ravel(), "left")
            count = np.searchsorted(self.keys, keys.ravel(), "right") - low
            window = np.repeat(np.repeat(np.arange(len(start)), keys.shape[1]), count)
            own = self.key_items[_spread(low, count)]
            same = self.length[own] == length[window]
            pairs.append(np.unique(own[same] * len(ends) + start[window[same]]))
        item, start = np.divmod(np.concatenate(pairs), max(len(ends), 1))
        return tuple(np.concatenate(x) for x in zip((item, start, start), whole))

    def found(self, words: Words) -> tuple[np.ndarray, ...]:
        """(document, item id, first word, words, distance) of all items in a chunk."""
        document, item, *run = self.leaks(words)
        return tuple(np.concatenate(x) for x in zip((document, self.ids[item], *run), self.short_leaks(words)))

    def short_leaks(self, words: Words) -> tuple[np.ndarray, ...]:
        """The same of items with few words: the first place of each in each document."""
        found = [np.zeros((5, 0), np.int64)]
        for n, (hashes, ids) in self.short.items():
            own, whole = words.grams(n)
            at = np.flatnonzero(whole)
            low = np.searchsorted(hashes, own[at], "left")
            count = np.searchsorted(hashes, own[at], "right") - low
            item, at = ids[_spread(low, count)], np.repeat(at, count)
            document = np.searchsorted(words.bounds, at, "right") - 1
            order = np.lexsort((at, item, document))
            document, item, at = document[order], item[order], at[order]
            new = np.ones(len(at), bool)
            new[1:] = (document[1:] != document[:-1]) | (item[1:] != item[:-1])
            document, item, at = document[new], item[new], at[new]
            found.append(np.stack([document, item, at - words.bounds[document], np.full(len(at), n), np.zeros(len(at), np.int64)]))
        return tuple(np.concatenate(found, axis=1))

    def leaks(self, words: Words) -> tuple[np.ndarray, ...]:
        """(document, item, first word, words, distance) of the leaks of longer items in a chunk, best run of each."""
        item, low, high = self.candidates(words)
        if not len(item):
            return tuple(np.zeros((5, 0), np.int64))
        # Regions that may hold the leaks, those of an item that overlap as one.
        slack = edits(self.length[item])
        document = np.searchsorted(words.bounds, low, "right") - 1
        apart = len(words.hashes) + 1
        low = item * apart + np.maximum(low - slack, words.bounds[document])
        high = item * apart + np.minimum(high + self.length[item] + slack, words.bounds[document + 1])
        order = np.argsort(low, kind="stable")
        low, high = low[order], np.maximum.accumulate(high[order])
        new = np.append(True, low[1:] >= high[:-1])
        item, low = np.divmod(low[new], apart)
        high = high[np.append(new[1:], True)] % apart
        order = np.lexsort((high - low, self.length[item]))
        item, low, size = item[order], low[order], (high - low)[order]
        found: list[np.ndarray] = []
        first = 0
        while first < len(item):
            n = self.length[item[first]]
            end = first + int(np.searchsorted(self.length[item[first:]], n, "right"))
            cells = np.arange(1, end - first + 1) * size[first:end]
            end = first + max(1, int(np.searchsorted(cells, ALIGNED_AT_ONCE, "right")))
            i, at, wide = item[first:end], low[first:end], size[first:end]
            y = words.hashes[np.minimum(at[:, None] + np.arange(wide.max()), len(words.hashes) - 1)]
            d, start, stop = best_runs(self.words[self.start[i][:, None] + np.arange(n)], y, wide)
            good = d <= edits(n)
            document = np.searchsorted(words.bounds, at[good], "right") - 1
            place = at[good] + start[good] - words.bounds[document]
            found.append(np.stack([document, i[good], d[good], place, (stop - start)[good]]))
            first = end
        rows = np.concatenate(found, axis=1)
        rows = rows[:, np.lexsort(rows[::-1])]
        best = np.ones(rows.shape[1], bool)
        best[1:] = (rows[:2, 1:] != rows[:2, :-1]).any(axis=0)
        document, item, distance, place, size = rows[:, best]
        return document, item, place, size, distance


def _joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [t.encode("utf-8", "replace") for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)


def find_leaks(
    df: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """id, ``item_id``, ``first_word`` and ``n_words`` of the run, ``distance`` in words."""
    spark = df.sparkSession
    rows = df.select(df[id_col].alias("id"), df[text_col].cast("string").alias("text"))
    searched = items.select(items[item_col].cast("long").alias("item"), items[item_text_col].cast("string").alias("text"))
    searched = searched.where("item IS NOT NULL AND text IS NOT NULL")
    n_bytes = searched.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = max(1, -(-n_bytes // SLICE_BYTES))
    schema = T.StructType(
        [T.StructField("id", rows.schema["id"].dataType)]
        + [T.StructField(c, T.LongType()) for c in ("item_id", "first_word", "n_words", "distance")]
    )

    def search(own: DataFrame) -> DataFrame:
        # Of about SLICE_BYTES, whatever the size of the table.
        listed = own.collect()
        index = spark.sparkContext.broadcast(Index([r[0] for r in listed], [r[1] for r in listed]))

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for first, _, data, bounds in chunks(batch.column(1)):
                    words = Words(data, bounds, ALNUM_WORD, lower=True)
                    document, item, at, size, distance = index.value.found(words)
                    yield pa.record_batch(
                        [
                            batch.column(0).take(pa.array(document + first)),
                            *(pa.array(x.astype(np.int64)) for x in (item, at, size, distance)),
                        ],
                        names=schema.names,
                    )

        return rows.mapInArrow(run, schema)

    found = search(searched if slices == 1 else searched.where(f"pmod(xxhash64(item, text), {slices}) = 0"))
    for part in range(1, slices):
        found = found.union(search(searched.where(f"pmod(xxhash64(item, text), {slices}) = {part}")))
    return found.withColumnRenamed("id", id_col)
