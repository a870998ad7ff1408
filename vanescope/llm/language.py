"""Language identification by prediction by partial matching over bytes.

Each language has a tree of byte contexts up to ``ORDER`` bytes long with the counts of the bytes
that followed. The code length of a text under a language is the sum over its bytes: the byte is
coded in the longest context in which it was seen, after an escape from every longer one. A context
with n occurrences of k different bytes gives a byte seen c times a share of c / (n + k), and the
escape k / (n + k); below the empty context all 256 bytes are alike. Statistics are frozen after
training, so code lengths are exact and every text is scored on its own. The language with the
shortest code wins; its score is its share when code lengths are read as log-likelihoods.

Trees are trained on a bounded sample per language: texts are cut into pieces of ``PIECE_BYTES``,
most being one piece, and the pieces taken in the order of a hash of id and piece until they hold
``SAMPLE_BYTES``. So each language with text is learned, from 32 pieces at least or all it has.
Hashes are told apart by ``STEPS`` per halving, so up to a twentieth more is taken. Counts are summed on the executors; what comes to the
driver is the trees, whose size the sample bounds. They are flattened there: contexts are numbered
once for all languages, and for each language a table holds the code length of every byte after
every context, escapes included. A byte of text then costs one lookup per language.

Defined results: ``und`` with score 0 for a NULL text or one without a letter. Ties go to the
language that sorts first. Training leaves out rows whose language or text is NULL; without any
training rows every text is ``und``. Repeated rows are scored alike.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vanescope.llm.text import chunks

ORDER = 3
SAMPLE_BYTES = 2 << 20
PIECE_BYTES = 1 << 16
STEPS = 16
#: A longest context must have been seen this often in one of the languages.
LEAST_SEEN = 4
UNDETERMINED = "und"

_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[0x41:0x5B] = _ASCII_LETTER[0x61:0x7B] = True


def _pieces(data: np.ndarray, bounds: np.ndarray, wanted: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """(document, gram) of each byte in the wanted pieces of the documents of a chunk."""
    of, grams = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i, pieces in enumerate(wanted):
        for piece in pieces:
            low = bounds[i] + piece * PIECE_BYTES
            # What stands before the piece is context only.
            before = min(ORDER, low - bounds[i])
            own = data[low - before : min(low + PIECE_BYTES, bounds[i + 1])]
            own = (_contexts(own, np.array([0, len(own)])) << np.int64(8) | own)[before:]
            of.append(np.full(len(own), i))
            grams.append(own)
    return np.concatenate(of), np.concatenate(grams)


def _counts(rows: DataFrame) -> DataFrame:
    """(lang, gram, n): occurrences of each byte with the ``ORDER`` bytes before it, zero before
    the start of a text, in the pieces listed. Each batch is summed before it leaves the task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, pieces = np.array(batch.column(0).to_pylist(), object), batch.column(2).to_pylist()
            for first, end, data, bounds in chunks(batch.column(1)):
                of, grams = _pieces(data, bounds, pieces[first:end])
                own = langs[first:end]
                for lang in sorted(set(own)):
                    values, n = np.unique(grams[(own == lang)[of]], return_counts=True)
                    yield pa.record_batch([pa.array([lang] * len(values), pa.string()), pa.array(values), pa.array(n)], names=["lang", "gram", "n"])

    return rows.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _contexts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The ``ORDER`` bytes before each byte as one number."""
    out = np.zeros(len(data), np.int64)
    offset = np.arange(len(data)) - np.repeat(bounds[:-1], np.diff(bounds))
    for back in range(1, ORDER + 1):
        out[back:] |= np.where(offset[back:] >= back, data[:-back].astype(np.int64) << (8 * (back - 1)), 0)
    return out


@dataclass
class Model:
    """Flattened trees of all languages."""

    langs: list[str]
    #: A small number for each byte value, 0 for those never seen; NUL also stands before a text.
    symbols: np.ndarray
    #: Row of ``bits`` for the numbers of the ``ORDER`` bytes before.
    rows: np.ndarray
    #: Per language, code lengths by row and byte number.
    bits: np.ndarray

    def code_lengths(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Bits of each document of a chunk under each language."""
        out = np.zeros((len(bounds) - 1, len(self.langs)))
        full = np.flatnonzero(np.diff(bounds))
        if not len(full):
            return out
        size = int(self.symbols.max()) + 1
        symbol = self.symbols[data]
        context = np.zeros(len(data), np.int32)
        start = bounds[:-1][full]
        for back in range(1, ORDER + 1):
            before = np.zeros(len(data), np.int32)
            before[back:] = symbol[:-back]
            for i in range(back):
                # Bytes of the document before are zero, like those before the first.
                before[np.minimum(start + i, len(data) - 1)[start + i < bounds[1:][full]]] = self.symbols[0]
            context += before * size ** (back - 1)
        cell = self.rows[context] * np.int32(size) + symbol
        for i in range(len(self.langs)):
            out[full, i] = np.add.reduceat(self.bits[i].ravel()[cell].astype(np.float64), start)
        return out

    def score(self, data: np.ndarray, bounds: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and score of each document of a chunk."""
        n = len(bounds) - 1
        letters = np.concatenate([[0], np.cumsum(_ASCII_LETTER[data])])[bounds]
        sure = np.diff(letters) > 0
        for i in np.flatnonzero(~sure & (np.diff(bounds) > 0)):
            text = bytes(data[bounds[i] : bounds[i + 1]]).decode("utf-8", "replace")
            sure[i] = any(c.isalpha() for c in text)
        if not self.langs:
            return [UNDETERMINED] * n, np.zeros(n)
        bits = self.code_lengths(data, bounds)
        best = bits.argmin(axis=1)
        share = 1 / np.exp2(np.minimum(bits.min(axis=1, keepdims=True) - bits, 0)).sum(axis=1)
        return [self.langs[b] if s else UNDETERMINED for b, s in zip(best, sure)], np.where(sure, share, 0.0)


def _tree(grams: np.ndarray, n: np.ndarray, symbols: np.ndarray, contexts: list[np.ndarray]) -> list[np.ndarray]:
    """Code lengths of one language for each order: a row per context, a column per byte number.

    ``contexts`` lists those of each order by ascending number, the nearest byte lowest.
    """
    size = int(symbols.max()) + 1
    byte = [symbols[(grams >> np.int64(8 * i)) & 255].astype(np.int64) for i in range(ORDER + 1)]
    number = np.zeros(len(grams), np.int64)
    tables: list[np.ndarray] = []
    for order, listed in enumerate(contexts):
        if order:
            number = number + byte[order] * size ** (order - 1)
        row = np.minimum(np.searchsorted(listed, number), max(len(listed) - 1, 0))
        hit = listed[row] == number if len(listed) else np.zeros(len(grams), bool)
        counts = np.bincount(row[hit] * size + byte[0][hit], n[hit], len(listed) * size).reshape(len(listed), size)
        total, kinds = counts.sum(axis=1, keepdims=True), (counts > 0).sum(axis=1, keepdims=True)
        inherited = tables[-1][np.searchsorted(contexts[order - 1], listed % size ** (order - 1))] if order else 8.0
        known = np.log2(np.maximum(total + kinds, 1))
        escape = np.where(total > 0, known - np.log2(np.maximum(kinds, 1)), 0)
        tables.append(np.where(counts > 0, known - np.log2(np.maximum(counts, 1)), escape + inherited))
    return tables


def train(df: DataFrame, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id", sample_bytes: int = SAMPLE_BYTES) -> Model:
    """Trees of the languages in ``lang_col``, from rows that have language and text."""
    rows = df.select(df[lang_col].cast("string").alias("lang"), df[text_col].cast("string").alias("text"), df[id_col].alias("id"))
    rows = rows.where("lang IS NOT NULL AND text IS NOT NULL AND text <> ''").withColumn("bytes", F.octet_length("text").cast("long"))
    # Rows without id are told apart by their texts.
    rows = rows.withColumn("seed", F.xxhash64("id", F.lit(17), F.when(F.col("id").isNull(), F.col("text"))))
    rows = rows.withColumn("pieces", F.expr(f"sequence(0L, (bytes - 1) div {PIECE_BYTES})"))

    def level(piece: Column) -> Column:
        """How early a piece is in the order of hashes: one more halves what is left ``STEPS`` times finer."""
        chance = (F.xxhash64("seed", piece).bitwiseAND(F.lit((1 << 52) - 1)) + 1) / F.lit(float(1 << 52))
        return F.floor(-STEPS * F.log2(chance))

    size = F.least(F.lit(PIECE_BYTES), F.col("bytes") - PIECE_BYTES * F.col("piece"))
    levels = rows.select("lang", "seed", "bytes", F.explode("pieces").alias("piece"))
    levels = levels.groupBy("lang", level(F.col("piece")).alias("level")).agg(F.sum(size).alias("bytes"))
    least: dict[str, int] = {}
    taken: dict[str, int] = {}
    for lang, at, n_bytes in sorted(levels.collect(), key=lambda r: -r[1]):
        if taken.get(lang, 0) < sample_bytes:
            least[lang], taken[lang] = at, taken.get(lang, 0) + n_bytes
    if not least:
        return Model([], np.zeros(256, np.int32), np.zeros(1, np.int32), np.zeros((0, 1, 1), np.float32))
    from_level = F.create_map(*[x for lang, at in least.items() for x in (F.lit(lang), F.lit(at))])
    wanted = rows.select("lang", "text", F.filter("pieces", lambda piece: level(piece) >= from_level[F.col("lang")]).alias("pieces"))
    listed = _counts(wanted.where(F.size("pieces") > 0)).toArrow()
    names, grams, n = (listed.column(i).to_numpy(zero_copy_only=False) for i in range(3))
    langs = sorted(set(names))
    symbols = np.zeros(256, np.int32)
    used = np.unique(np.append(grams & 255, 0))
    symbols[used] = np.arange(1, len(used) + 1)
    size = len(used) + 1
    number = np.zeros(len(grams), np.int64)
    for i in range(ORDER):
        number += symbols[(grams >> np.int64(8 * (i + 1))) & 255].astype(np.int64) * size**i
    values, inverse = np.unique(number, return_inverse=True)
    often = np.zeros(len(values), bool)
    for lang in langs:
        often |= np.bincount(inverse, np.where(names == lang, n, 0), len(values)) >= LEAST_SEEN
    # All contexts of two bytes and shorter, and those of the longest order that were seen often.
    contexts = [np.arange(size**order) for order in range(ORDER)]
    longest = values[often]
    rows_of = np.arange(size**ORDER, dtype=np.int64) % size ** (ORDER - 1)
    rows_of = rows_of.astype(np.int32) + np.int32(len(longest))
    rows_of[longest] = np.arange(len(longest), dtype=np.int32)
    bits = np.empty((len(langs), len(longest) + size ** (ORDER - 1), size), np.float32)
    for i, lang in enumerate(langs):
        own = names == lang
        tables = _tree(grams[own], n[own], symbols, [*contexts, longest])
        bits[i] = np.concatenate([tables[ORDER], tables[ORDER - 1]])
    return Model(langs, symbols, rows_of, bits)


def identify(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ``lang_pred`` and ``score`` of each row."""
    rows = df.select(df[id_col].alias("id"), df[text_col].cast("string").alias("text"))
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, bounds in chunks(batch.column(1)):
                langs, scores = shared.value.score(data, bounds)
                yield pa.record_batch(
                    [batch.column(0).slice(first, end - first), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                    names=["id", "lang_pred", "score"],
                )

    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def with_language(df: DataFrame, model: Model, name: str, text_col: str = "text") -> DataFrame:
    """All rows and columns of ``df`` and a column ``name`` with the language of each row."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    at = df.columns.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, bounds in chunks(batch.column(at).cast(pa.string())):
                langs, _ = shared.value.score(data, bounds)
                part = batch.slice(first, end - first)
                yield pa.record_batch([*part.columns, pa.array(langs, pa.string())], names=[*batch.schema.names, name])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(name, T.StringType())]))
