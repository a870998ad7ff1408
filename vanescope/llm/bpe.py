"""Byte-level BPE: text to token ids and back, with the ranks of a public vocabulary.

Texts are cut into pre-tokens as the vocabulary's pattern says and each pre-token is merged on
its own. Merging keeps a rank queue: one bucket per merge rank with the positions, in a linked
list of symbols, where that merge applies, and a two-level bitmap over the ranks. Some
hundred pre-tokens share one queue. Find-first-set
on the bitmap gives the next rank; a bucket's entries are taken from left to right, and those
whose symbols have changed since are skipped. Each merge costs a constant number of steps, so a
pre-token of a million bytes takes time in proportion to its length.

Results of short pre-tokens are kept in a table of bounded size per Python worker, as texts
repeat them. Nothing is shuffled; a row depends on its own text only.

Defined results: a NULL or empty text has no ids and decodes to nothing; bytes that are not
UTF-8 are read as U+FFFD. Rows keep their identity, also repeated ones; ids may be NULL.
"""

from __future__ import annotations

import base64
import hashlib
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from vanescope.llm.text import chunks, give_back

#: Entries that a worker keeps in each of its two tables of known pre-tokens, and the longest kept.
KNOWN_ENTRIES = 150_000
KNOWN_CHARS = 48
#: Pre-tokens that share one queue; few enough for its lists to stay in the processor's cache.
SHARED_TOKENS = 500

_WORD_BITS = 8
_WORD_MASK = (1 << _WORD_BITS) - 1

_LETTER, _NUMBER, _SPACE, _OTHER = 1, 2, 3, 0
# The code points of the Unicode property White_Space.
_WHITE_SPACE = (
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
# The endings the pattern cuts off after an apostrophe.
_CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file with one base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class PreTokenizer:
    """Cuts text as ``public_tokenizers.PATTERN`` does, from arrays of character classes."""

    def __init__(self) -> None:
        kind = np.zeros(0x110000, np.uint8)
        category = unicodedata.category
        for code in range(0x110000):
            major = category(chr(code))[0]
            if major == "L":
                kind[code] = _LETTER
            elif major == "N":
                kind[code] = _NUMBER
        kind[list(_WHITE_SPACE)] = _SPACE
        self.kind = kind

    def cut(self, text: str) -> list[str]:
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        n = len(codes)
        if not n:
            return []
        kind = self.kind[codes]
        change = np.flatnonzero(kind[1:] != kind[:-1]) + 1
        before, after = kind[change - 1], kind[change]
        start = np.zeros(n, bool)
        start[0] = True
        # A run of white space ends one character early: that one joins the next run if it is
        # a blank and stands alone otherwise.
        from_space = change[before == _SPACE]
        start[from_space - 1] = True
        start[from_space[codes[from_space - 1] != 0x20]] = True
        start[change[before != _SPACE]] = True
        for at in np.flatnonzero((codes == 0x27) & start).tolist():
            for ending in _CONTRACTIONS:
                if text.startswith(ending, at + 1):
                    start[at + 1] = False
                    if at + 1 + len(ending) < n:
                        start[at + 1 + len(ending)] = True
                    break
        cuts = np.flatnonzero(start).tolist()
        ends = cuts[1:]
        ends.append(n)
        return [text[a:b] for a, b in zip(cuts, ends)]


class Merger:
    """Merges many pre-tokens at once with one hierarchical-bitmap rank queue.

    The symbols of all pre-tokens form one linked list in which nothing is merged across the
    end of a pre-token, so the order of ranks within each is that of merging it alone.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        base = max(ranks.values()) + 1
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.first_pairs = np.full((256, 256), -1, np.int64)
        #: Whether every token has a larger rank than its parts, as in vocabularies that grew by merging.
        self.grown = True
        #: For a token, the ranks of its merges by the token on the other side.
        self.with_right: list[dict[int, int]] = [{} for _ in range(base)]
        self.with_left: list[dict[int, int]] = [{} for _ in range(base)]
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    self.with_right[left][right] = self.with_left[right][left] = rank
                    self.grown &= left < rank and right < rank
            if len(token) == 2:
                self.first_pairs[token[0], token[1]] = rank
        self.low = [0] * ((base >> _WORD_BITS) + 1)

    def merge(self, tokens: list[bytes]) -> list[bytes]:
        """Ids of each token, packed as little-endian unsigned 32-bit integers."""
        data = np.frombuffer(b"".join(tokens), np.uint8)
        n = len(data)
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype(np.int64)
        start_ids = self.byte_ids[data]
        start_ranks = np.full(n, -1, np.int64)
        start_ranks[:-1] = self.first_pairs[data[:-1], data[1:]]
        start_ranks[bounds[1:] - 1] = -1
        ends = np.zeros(n + 1, bool)
        ends[bounds] = True

        low, top = self.low, 0
        buckets: dict[int, list[int]] = {}
        at = np.flatnonzero(start_ranks >= 0)
        at = at[np.argsort(start_ranks[at], kind="stable")]
        cuts = np.flatnonzero(np.diff(start_ranks[at], prepend=-1)).tolist()
        for a, b in zip(cuts, [*cuts[1:], len(at)]):
            rank = int(start_ranks[at[a]])
            buckets[rank] = at[a:b].tolist()
            low[rank >> _WORD_BITS] |= 1 << (rank & _WORD_MASK)
            top |= 1 << (rank >> _WORD_BITS)

        with_left, with_right, grown = self.with_left, self.with_right, self.grown
        ids = start_ids.tolist()
        #: Rank of the merge at a position, -1 if none: an entry of a bucket is stale unless equal.
        rank_at = start_ranks.tolist()
        following = list(range(1, n + 1))
        previous = list(range(-1, n - 1))
        #: Whether a pre-token starts at a position; nothing is merged into it from the left.
        first = ends.tolist()
        taken_at = []
        while top:
            word = (top & -top).bit_length() - 1
            bits = low[word]
            rank = (word << _WORD_BITS) + (bits & -bits).bit_length() - 1
            entries = buckets.pop(rank)
            low[word] = bits & (bits - 1)
            if not low[word]:
                top &= top - 1
            if len(entries) > 1:
                entries.sort()
            find_right, find_left = with_right[rank].get, with_left[rank].get
            for done, at in enumerate(entries):
                if rank_at[at] != rank:
                    continue
                taken = following[at]
                after = following[taken]
                ids[at] = rank
                following[at] = after
                rank_at[taken] = rank_at[at] = -1
                taken_at.append(taken)
                lower = False
                if not first[after]:
                    previous[after] = at
                    new = find_right(ids[after])
                    if new is not None:
                        rank_at[at] = new
                        if new in buckets:
                            buckets[new].append(at)
                        else:
                            buckets[new] = [at]
                            part = new >> _WORD_BITS
                            low[part] |= 1 << (new & _WORD_MASK)
                            top |= 1 << part
                        lower = new < rank
                if not first[at]:
                    left = previous[at]
                    new = find_left(ids[left])
                    if new is None:
                        rank_at[left] = -1
                    else:
                        rank_at[left] = new
                        if new in buckets:
                            buckets[new].append(left)
                        else:
                            buckets[new] = [left]
                            part = new >> _WORD_BITS
                            low[part] |= 1 << (new & _WORD_MASK)
                            top |= 1 << part
                        lower |= new < rank
                if lower and not grown and done + 1 < len(entries):
                    # A longer token with a smaller rank comes first; the rest of the bucket waits.
                    buckets[rank] = entries[done + 1 :]
                    low[rank >> _WORD_BITS] |= 1 << (rank & _WORD_MASK)
                    top |= 1 << (rank >> _WORD_BITS)
                    break
        left = np.ones(n, bool)
        left[taken_at] = False
        kept = np.concatenate([[0], np.cumsum(left)])[bounds] * 4
        packed = np.array(ids, "<u4")[left].tobytes()
        kept = kept.tolist()
        return [packed[a:b] for a, b in zip(kept[:-1], kept[1:])]


class Codec:
    """Encoder and decoder of one vocabulary.

    Ids of short pre-tokens are kept in two tables of bounded size: when the young one is full
    it becomes the old one, from which entries in use come back.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.pre = PreTokenizer()
        self.merger = Merger(ranks)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        cut = [self.pre.cut(text) for text in texts]
        missing = set().union(*cut).difference(self.young)
        again = missing.intersection(self.old)
        self.young.update((token, self.old[token]) for token in again)
        new = list(missing - again)
        for at in range(0, len(new), SHARED_TOKENS):
            part = new[at : at + SHARED_TOKENS]
            self.young.update(zip(part, self.merger.merge([t.encode("utf-8", "replace") for t in part])))
        packed = [b"".join(map(self.young.__getitem__, tokens)) for tokens in cut]
        for token in new:
            if len(token) > KNOWN_CHARS:
                del self.young[token]
        if len(self.young) > KNOWN_ENTRIES:
            self.young, self.old = {}, self.young
        return packed

    def forget(self) -> None:
        """Empty the tables: a worker that has nothing more to encode keeps no memory for it."""
        self.young, self.old = {}, {}


class Decoder:
    """Tokens of one vocabulary by id."""

    def __init__(self, ranks: dict[bytes, int]):
        self.tokens = {rank: token for token, rank in ranks.items()}

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(packed, "<u4").tolist()))


_built: dict[tuple[type, str], Codec | Decoder] = {}


def _of(kind: type, lines: bytes) -> Codec | Decoder:
    """The codec or decoder of this worker, built once per vocabulary."""
    name = kind, hashlib.md5(lines).hexdigest()
    if name not in _built:
        _built.clear()
        _built[name] = kind({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines.splitlines())})
    return _built[name]


def _text(value: memoryview) -> str:
    return bytes(value).decode("utf-8", "replace")


def _read(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``ids``: the token ids of each whole text as little-endian unsigned 32-bit
    integers. ``vocabulary`` is a rank file that the driver can read; its tokens, a fixed number
    of them, are sent to the executors once."""
    rows = df.select(df[id_col].alias("id"), df[text_col].cast("string").alias("text"))
    shared = df.sparkSession.sparkContext.broadcast(_read(vocabulary))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _of(Codec, shared.value)
        for batch in batches:
            for first, end, data, bounds in chunks(batch.column(1)):
                packed = codec.encode([_text(data[a:b]) for a, b in zip(bounds[:-1], bounds[1:])])
                yield pa.record_batch(
                    [batch.column(0).slice(first, end - first), pa.array(packed, pa.binary())], names=["id", "ids"]
                )
        codec.forget()

    kind = rows.schema["id"].dataType
    schema = T.StructType([T.StructField("id", kind), T.StructField("ids", T.BinaryType())])
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """Adds ``decoded``, the bytes that ``ids`` stand for. NULL ids decode to nothing; an id that
    the vocabulary lacks is an error."""
    shared = encoded.sparkSession.sparkContext.broadcast(_read(vocabulary))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _of(Decoder, shared.value)
        for batch in batches:
            at = batch.schema.get_field_index("ids")
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                texts = [codec.decode(ids.as_buffer()) if ids.is_valid else b"" for ids in part.column(at)]
                yield pa.record_batch([*part.columns, pa.array(texts, pa.binary())], names=[*batch.schema.names, "decoded"])
            give_back()

    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType())])
    return encoded.mapInArrow(run, schema)
