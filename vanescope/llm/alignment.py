"""Which tokens of two tokenizers mean the same: overlaps of their tokens, counted over all documents.

Side A is a byte-level BPE, side B one over word pieces. Both read a blank and the text, and their tokens
are compared as byte ranges of it. Where a token of A and one of B end together, a group ends; tokens
whose ranges overlap are linked. A pair of ids counts once for every document that holds it linked.

* Segments. Neither tokenizer has a token that goes from another character on to a blank, so texts
  are cut in front of such blanks, and each segment has its own tokens, groups and links. A task keeps
  those of the segments it has seen, in a table of bounded size, and puts documents together from it.
  Vocabularies for which this does not hold are found out, and their texts are left whole.
* Runs. A task gathers one record (a, b, document, number of links) per pair and document, sorts
  about ``RUN_RECORDS`` of them, cuts the run by the lowest bits of a (the radix), and writes each piece
  compressed by zstd to the shared folder.
* Merge. Pieces of one radix and of some ``RUNS_PER_SLICE`` runs meet in a task, which merges them through
  a heap, by a and then b, so that the documents of each pair add up as it passes. A radix that holds a
  third of all records has as many slices as any other, so no id is gathered in one place.
* Maxima. The slices' counts, a line per pair and slice, are added up, and the highest count of each
  id of A is taken from the sums; there are no more such lines than A has ids.
* Contributions. Counts go back to the slices that hold the pair, and stream along the pieces in the same
  order; each gives sums per document of a run, and these are added up per run.

Records move twice, compressed, and nothing is joined by document. What a task holds is a run, or the pieces
of one radix and slice. Counts and sums are whole numbers, so their order does not matter.

Defined results: texts that are NULL or empty, or whose tokens of one side do not spell the text (with
U+2581 in it, for instance), have no tokens: zeros, and the digest column is empty. Rows that repeat are
documents of their own, also where they share an id or have none. Other columns are left out.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vanescope.llm.stored import stored

#: Records that a run holds, or those of one longer document.
RUN_RECORDS = 1 << 21
#: Documents of a run; their numbers have as many bits as an id.
RUN_DOCUMENTS = 1 << 18
RUNS_PER_SLICE = 64
#: Segments that a task remembers, and characters and documents it puts together at a time.
KNOWN_SEGMENTS = 300_000
CHARS_AT_ONCE = 1 << 22
DOCUMENTS_AT_ONCE = 1 << 16
#: Longest segment that is remembered.
LONGEST_KNOWN = 256
#: Segments that are encoded as one text.
ENCODED_AT_ONCE = 512

_RADIX_BITS = 4
_ID_BITS = 20
_PAIR_BITS = 2 * _ID_BITS

# Not in front of a last blank: on its own side B takes it for an empty text.
_cut = re.compile(r"(?<=\S)(?= .)", re.DOTALL)


def byte_level_values() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printing characters of Latin-1 stand for their own code; the other bytes, in order, are shown by
    the characters from U+0100 on.
    """
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = sorted(set(range(256)) - set(own))
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizers:
    """Both sides, their tokens' bytes, and whether texts may be cut in front of blanks."""

    def __init__(self, a_json: str, b_model: bytes):
        import sentencepiece
        import tokenizers

        # Tasks are many already; a worker with threads of its own would slow down its neighbours.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._a = tokenizers.Tokenizer.from_str(a_json)
        self._a.encode_special_tokens = True
        self._b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        values = byte_level_values()
        described = json.loads(a_json)
        special = {t["id"] for t in described.get("added_tokens", [])}
        self.a_bytes = [b""] * self._a.get_vocab_size()
        for entry, i in self._a.get_vocab().items():
            self.a_bytes[i] = entry.encode() if i in special else bytes(values[c] for c in entry)
        pieces = [self._b.id_to_piece(i) for i in range(self._b.vocab_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self._b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        # A reads words one by one if it is of the usual byte-level kind.
        usual = (described.get("pre_tokenizer") or {}).get("type") == "ByteLevel" and described["pre_tokenizer"].get("use_regex", True)
        self.cuts = bool(usual) and not described.get("normalizer") and not any(re.search("[^▁]▁", p) for p in pieces)
        if max(len(self.a_bytes), len(self.b_bytes)) > 1 << _ID_BITS:
            raise ValueError("more ids than the records have bits for")

    def encode_a(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self._a.encode_batch_fast(texts, add_special_tokens=False)]

    def encode_b(self, texts: list[str]) -> list[list[int]]:
        """Of texts that start with the blank that this side adds itself."""
        return self._b.encode([t[1:] for t in texts], num_threads=1)

    def segments(self, text: str) -> list[str]:
        return _cut.split(" " + text) if self.cuts else [" " + text]


def tokens_of(segments: list[str], raw: list[bytes], encode: Callable, table: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids of all segments, number of ids of each, whether they spell the segment).

    Segments are encoded some hundred at a time, as one text, if they end in no white space; where
    its tokens don't spell it, or one reaches over an end of a segment, one by one.
    """
    lengths = np.array([len(b) for b in table], np.int64)
    groups: list[tuple[int, int]] = []
    for i, segment in enumerate(segments):
        # A blank that follows white space may belong to the token before.
        if groups and not segments[i - 1][-1].isspace() and i - groups[-1][0] < ENCODED_AT_ONCE:
            groups[-1] = (groups[-1][0], i + 1)
        else:
            groups.append((i, i + 1))
    ids: list[np.ndarray] = []
    counts = np.zeros(len(segments), np.int64)
    spells = np.ones(len(segments), bool)

    def one(i: int, own: list[int]) -> None:
        ids.append(np.array(own, np.int64))
        counts[i] = len(own)
        spells[i] = b"".join(map(table.__getitem__, own)) == raw[i]

    for (first, end), own in zip(groups, encode(["".join(segments[a:b]) for a, b in groups])):
        if end - first == 1:
            one(first, own)
            continue
        together = np.array(own, np.int64)
        ends = np.cumsum(lengths[together])
        bounds = np.cumsum([len(r) for r in raw[first:end]])
        last = np.searchsorted(ends, bounds)
        whole = b"".join(map(table.__getitem__, own)) == b"".join(raw[first:end])
        if whole and (ends[last] == bounds).all():
            ids.append(together)
            counts[first:end] = np.diff(last, prepend=-1)
        else:
            for i, alone in zip(range(first, end), encode(segments[first:end])):
                one(i, alone)
    return np.concatenate([np.zeros(0, np.int64), *ids]), counts, spells


def _kept(ids: np.ndarray, counts: np.ndarray, keep: np.ndarray) -> np.ndarray:
    return ids[np.repeat(keep, counts)]


def _per_segment(places: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many of the ascending places end in each segment."""
    return np.diff(np.searchsorted(places, bounds, "right"), prepend=0)


class Segments:
    """Tokens, groups and links of the segments seen so far."""

    def __init__(self, tokenizers: Tokenizers):
        self.tokenizers = tokenizers
        a, b = len(tokenizers.a_bytes), len(tokenizers.b_bytes)
        #: What an id is written as, before another one of its side and as the last one of the group.
        self._written = [f"{i}{x}".encode() for i in range(a) for x in ",|"] + [f"{i}{x}".encode() for i in range(b) for x in ",;"]
        self._a_length = np.array([len(x) for x in tokenizers.a_bytes], np.int64)
        self._b_length = np.array([len(x) for x in tokenizers.b_bytes], np.int64)
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        #: Per segment: n_a, n_b, n_groups, n_links, spelled.
        self.facts = np.zeros((0, 5), np.int64)
        self.written: list[bytes] = []
        self.pairs = np.zeros(0, np.int64)

    def add(self, new: list[str]) -> None:
        """Learn segments that are not known yet."""
        raw = [s.encode() for s in new]
        a, n_a, a_spells = tokens_of(new, raw, self.tokenizers.encode_a, self.tokenizers.a_bytes)
        b, n_b, b_spells = tokens_of(new, raw, self.tokenizers.encode_b, self.tokenizers.b_bytes)
        good = a_spells & b_spells
        a, b = _kept(a, n_a, good), _kept(b, n_b, good)
        n_a, n_b = n_a * good, n_b * good
        bounds = np.cumsum([len(r) if ok else 0 for r, ok in zip(raw, good)])
        total = int(bounds[-1])
        a_ends, b_ends = np.cumsum(self._a_length[a]), np.cumsum(self._b_length[b])
        is_a, is_b = np.zeros(total + 1, bool), np.zeros(total + 1, bool)
        is_a[a_ends], is_b[b_ends] = True, True
        # Between two ends lies one token of each side: a link.
        ends = np.flatnonzero(is_a | is_b)
        in_a, in_b = np.cumsum(is_a)[ends] - is_a[ends], np.cumsum(is_b)[ends] - is_b[ends]
        self.pairs = np.concatenate([self.pairs, a[in_a] << _ID_BITS | b[in_b]])
        group_ends = np.flatnonzero(is_a & is_b)
        facts = np.stack([n_a, n_b, _per_segment(group_ends, bounds), _per_segment(ends, bounds), good], axis=1)
        self.facts = np.concatenate([self.facts, facts])
        # The ids of A of a group come before those of B, and these before the next group.
        a_group, b_group = np.searchsorted(group_ends, a_ends), np.searchsorted(group_ends, b_ends)
        b_before = np.searchsorted(b_ends, np.append(0, group_ends), "right")
        a_through = np.searchsorted(a_ends, group_ends, "right")
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + b_before[a_group]] = 2 * a + is_b[a_ends]
        order[np.arange(len(b)) + a_through[b_group]] = 2 * (len(self._a_length) + b) + is_a[b_ends]
        codes, at = order.tolist(), 0
        for n in (n_a + n_b).tolist():
            self.written.append(b"".join(map(self._written.__getitem__, codes[at : at + n])))
            at += n
        for s in new:
            self.number[s] = len(self.number)

    def of(self, documents: list[list[str]]) -> tuple[np.ndarray, np.ndarray, list[str], np.ndarray, np.ndarray]:
        """Of documents with a segment at least: (n_a, n_b, n_groups, n_links as rows, whether they have
        tokens, digests, pairs of all documents, number of pairs of each)."""
        wanted = dict.fromkeys(s for segments in documents for s in segments)
        new = [s for s in wanted if s not in self.number]
        if len(self.number) + len(new) > KNOWN_SEGMENTS:
            self.clear()
            new = list(wanted)
        if new:
            self.add(new)
        numbers = [[self.number[s] for s in segments] for segments in documents]
        flat = np.concatenate([np.array(n, np.int64) for n in numbers])
        sizes = np.array([len(n) for n in numbers])
        begin = np.cumsum(sizes) - sizes
        facts = self.facts[flat]
        has = np.logical_and.reduceat(facts[:, 4].astype(bool), begin)
        totals = np.add.reduceat(facts[:, :4], begin, axis=0) * has[:, None]
        digests = [
            hashlib.sha256(b"".join(map(self.written.__getitem__, n))[:-1]).hexdigest() if ok else "" for n, ok in zip(numbers, has.tolist())
        ]
        chosen = flat[np.repeat(has, sizes)]
        count = self.facts[chosen, 3]
        first = (np.cumsum(self.facts[:, 3]) - self.facts[:, 3])[chosen]
        at = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())
        long = [s for s in wanted if len(s) > LONGEST_KNOWN]
        pairs = self.pairs[at]
        if long:
            # Long segments hardly come again.
            self.clear()
        return totals, has, digests, pairs, totals[:, 3]


def dump(*arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers from 0 on, in the fewest bytes each, compressed."""
    head, body = [], []
    for a in arrays:
        kind = np.min_scalar_type(int(a.max(initial=0)))
        head.append([kind.char, len(a)])
        body.append(a.astype(kind).tobytes())
    text = json.dumps(head).encode()
    return zstandard.ZstdCompressor(level=3).compress(len(text).to_bytes(4, "little") + text + b"".join(body))


def load(packed: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(packed)
    at = 4 + int.from_bytes(raw[:4], "little")
    out = []
    for kind, n in json.loads(raw[4:at]):
        out.append(np.frombuffer(raw, np.dtype(kind), n, at).astype(np.int64))
        at += out[-1].size * np.dtype(kind).itemsize
    return out


def sorted_run(pairs: np.ndarray, documents: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(radix, piece) of one run. A piece holds the steps from pair to pair, the number of documents
    of each pair, and per document its number and links."""
    low = (1 << _RADIX_BITS) - 1
    key = pairs.astype(np.uint64) << np.uint64(_ID_BITS) | documents.astype(np.uint64)
    key |= (pairs >> _ID_BITS & low).astype(np.uint64) << np.uint64(_PAIR_BITS + _ID_BITS)
    key.sort()
    new = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    links, key = np.diff(np.append(new, len(key))), key[new]
    bounds = np.searchsorted(key, np.arange(1, low + 2, dtype=np.uint64) << np.uint64(_PAIR_BITS + _ID_BITS)) if low else [len(key)]
    begin = 0
    for radix, end in enumerate([*bounds[:-1], len(key)]):
        if end > begin:
            own = key[begin:end]
            pair = (own >> np.uint64(_ID_BITS) & np.uint64((1 << _PAIR_BITS) - 1)).astype(np.int64)
            at = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
            document = (own & np.uint64((1 << _ID_BITS) - 1)).astype(np.int64)
            yield radix, dump(np.diff(pair[at], prepend=0), np.diff(np.append(at, len(own))), document, links[begin:end])
        begin = end


FACTS = "array<struct<id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string>>"
RECORDS = f"run long, radix int, piece binary, facts {FACTS}"
_FACT = pa.struct([(c, pa.int64()) for c in ("id", "n_a", "n_b", "n_groups", "n_links")] + [("groups_sha256", pa.string())])


class _Run:
    """Documents gathered so far, and their records."""

    def __init__(self) -> None:
        self.facts: list[dict] = []
        self.pairs: list[np.ndarray] = []
        self.documents: list[np.ndarray] = []
        self.size = 0

    def add(self, ids: list, totals: np.ndarray, digests: list[str], pairs: np.ndarray, counts: np.ndarray) -> None:
        first = len(self.facts)
        for i, (n_a, n_b, n_groups, n_links), digest in zip(ids, totals.tolist(), digests):
            self.facts.append({"id": i, "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links, "groups_sha256": digest})
        self.pairs.append(pairs)
        self.documents.append(np.repeat(np.arange(first, first + len(ids)), counts))
        self.size += len(pairs)

    def rows(self, run: int) -> Iterator[pa.RecordBatch]:
        def batch(radix: int, piece: bytes | None, facts: list | None) -> pa.RecordBatch:
            columns = [pa.array([run], pa.int64()), pa.array([radix], pa.int32()), pa.array([piece], pa.binary()), pa.array([facts], pa.list_(_FACT))]
            return pa.record_batch(columns, names=["run", "radix", "piece", "facts"])

        yield batch(-1, None, self.facts)
        for radix, piece in sorted_run(np.concatenate(self.pairs), np.concatenate(self.documents)):
            yield batch(radix, piece, None)


_segments: dict[str, Segments] = {}


def _known(a_json: str, b_model: bytes) -> Segments:
    key = hashlib.sha256(a_json.encode() + b_model).hexdigest()
    if key not in _segments:
        _segments.clear()
        _segments[key] = Segments(Tokenizers(a_json, b_model))
    return _segments[key]


def records(df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Sorted runs, one row per run and radix, and on radix -1 the facts of the run's documents; stored."""
    with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
        # Vocabularies; their sizes do not depend on the data.
        vocabularies = df.sparkSession.sparkContext.broadcast((a.read(), b.read()))

    def chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
        ids, texts, size = [], [], 0
        for batch in batches:
            for row in range(batch.num_rows):
                text = batch.column(1)[row].as_py() or ""
                if texts and (size + len(text) > CHARS_AT_ONCE or len(texts) == DOCUMENTS_AT_ONCE):
                    yield ids, texts
                    ids, texts, size = [], [], 0
                ids.append(batch.column(0)[row].as_py())
                texts.append(text)
                size += len(text)
        if texts:
            yield ids, texts

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _known(*vocabularies.value)
        number = TaskContext.get().partitionId() << 32
        own = _Run()
        for ids, texts in chunks(batches):
            written = np.array([bool(t) for t in texts])
            totals, digests = np.zeros((len(texts), 4), np.int64), np.full(len(texts), "", object)
            pairs = np.zeros(0, np.int64)
            if written.any():
                totals[written], _, digests[written], pairs, _ = known.of([known.tokenizers.segments(t) for t in texts if t])
            own.add(ids, totals, digests.tolist(), pairs, totals[:, 3])
            if own.size >= RUN_RECORDS or len(own.facts) >= RUN_DOCUMENTS:
                yield from own.rows(number)
                number, own = number + 1, _Run()
        if own.facts:
            yield from own.rows(number)

    rows = df.select(df[id_col].cast("long").alias("id"), df[text_col].cast("string").alias("text"))
    return stored(rows.mapInArrow(run, RECORDS), "runs")


def merged(pieces: Iterable[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[int, int]]:
    """(pair, documents) by pair, from runs of pairs in order and their numbers of documents."""
    own, total = -1, 0
    for pair, n in heapq.merge(*[zip(p.tolist(), c.tolist()) for p, c in pieces]):
        if pair != own:
            if total:
                yield own, total
            own, total = pair, 0
        total += n
    if total:
        yield own, total


def _sliced(runs: DataFrame) -> DataFrame:
    """Pieces with the slice in which they are merged."""
    slices = max(1, -(-runs.where("radix = -1").count() // RUNS_PER_SLICE))
    return runs.where("radix >= 0").select("run", "radix", "piece", F.pmod(F.xxhash64("run"), F.lit(slices)).cast("int").alias("slice"))


def _count_slice(key: tuple, table: pa.Table) -> pa.Table:
    loaded = (load(p.as_py()) for p in table.column("piece"))
    counted = list(merged((np.cumsum(steps), n) for steps, n, _, _ in loaded))
    flat = np.array(counted, np.int64).reshape(-1, 2)
    radix, of = (pa.array(np.full(len(flat), k.as_py(), np.int32)) for k in key)
    return pa.table({"radix": radix, "slice": of, "pair": flat[:, 0], "n": flat[:, 1]})


def slice_counts(pieces: DataFrame) -> DataFrame:
    """(radix, slice, pair, n): documents per pair and slice; stored."""
    counted = pieces.groupBy("radix", "slice").applyInArrow(_count_slice, "radix int, slice int, pair long, n long")
    return stored(counted, "pair-counts")


def totals_of(counts: DataFrame) -> DataFrame:
    """(pair, count, is_best): documents per pair, and whether no pair of the same id of A has more."""
    totals = counts.groupBy("pair").agg(F.sum("n").alias("count"))
    a = F.shiftright("pair", _ID_BITS)
    # A line per id of side A.
    highest = totals.groupBy(a.alias("a")).agg(F.max("count").alias("highest"))
    return totals.withColumn("a", a).join(F.broadcast(highest), "a").select("pair", "count", (F.col("count") == F.col("highest")).alias("is_best"))


def pair_counts(df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(a, b, count, is_best) of all linked pairs of ids of a corpus."""
    totals = totals_of(slice_counts(_sliced(records(df, a_path, b_path, id_col, text_col))))
    low = F.col("pair").bitwiseAND((1 << _ID_BITS) - 1)
    return totals.select(F.shiftright("pair", _ID_BITS).cast("int").alias("a"), low.cast("int").alias("b"), "count", "is_best")


def _contribute(key: tuple, pieces: pa.Table, known: pa.Table) -> pa.Table:
    pairs = known.column("pair").to_numpy()
    order = np.argsort(pairs)
    pairs, count = pairs[order], known.column("count").to_numpy()[order]
    best = known.column("is_best").to_numpy()[order].astype(np.int64)
    out = []
    for piece in pieces.column("piece"):
        steps, n, documents, links = load(piece.as_py())
        at = np.repeat(np.searchsorted(pairs, np.cumsum(steps)), n)
        n_best, count_sum = np.zeros((2, int(documents.max()) + 1), np.int64)
        np.add.at(n_best, documents, links * best[at])
        np.add.at(count_sum, documents, links * count[at])
        out.append(dump(n_best, count_sum))
    return pa.table({"run": pieces.column("run").combine_chunks(), "sums": pa.array(out, pa.binary())})


_RESULT = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def _add_up(id_col: str) -> Callable:
    def run(key: tuple, sums: pa.Table, facts: pa.Table) -> pa.Table:
        own = facts.column("facts").combine_chunks().flatten()
        n_best, count_sum = np.zeros((2, len(own)), np.int64)
        for packed in sums.column("sums"):
            best, count = load(packed.as_py())
            n_best[: len(best)] += best
            count_sum[: len(count)] += count
        columns = {id_col: own.field("id")} | {c: own.field(c) for c in _RESULT[:4]}
        return pa.table(columns | {"n_best": n_best, "count_sum": count_sum, "groups_sha256": own.field("groups_sha256")})

    return run


def align(df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: ``id_col``, ``n_a`` and ``n_b`` tokens, ``n_groups``, ``n_links``, ``n_best`` links whose
    count is the highest of their id of A, ``count_sum`` over links, and ``groups_sha256``, of the groups
    as text: ids of A, a bar, ids of B; groups divided by semicolons, ids by commas."""
    runs = records(df, a_path, b_path, id_col, text_col)
    pieces = _sliced(runs)
    counts = slice_counts(pieces)
    known = counts.join(totals_of(counts), "pair").select("radix", "slice", "pair", "count", "is_best")
    keys = ("radix", "slice")
    sums = pieces.groupBy(*keys).cogroup(known.groupBy(*keys)).applyInArrow(_contribute, "run long, sums binary")
    schema = T.StructType(
        [T.StructField(id_col, T.LongType())] + [T.StructField(c, T.LongType()) for c in _RESULT] + [T.StructField("groups_sha256", T.StringType())]
    )
    facts = runs.where("radix = -1").select("run", "facts")
    return sums.groupBy("run").cogroup(facts.groupBy("run")).applyInArrow(_add_up(id_col), schema)
