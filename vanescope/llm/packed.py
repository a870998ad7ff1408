"""Texts compressed for the way through a shuffle, and a filter that keeps most of them out of it."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanescope.llm.text import chunks, give_back

#: Bits of the filter: two megabytes, whatever the number of ids.
FILTER_BITS = 1 << 24

_CODEC = "zstd"


def packed(rows: DataFrame) -> DataFrame:
    """(id, size, packed) from (id, text); NULL is an empty text."""
    return rows.select("id", "text").mapInArrow(_pack, "id long, size long, packed binary")


def packed_of(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, size, packed) of those of ``rows`` (id, text) whose id is in ``ids``.

    A bitmap over hashes of the ids, of fixed size, is sent to the scan, which drops most other rows
    before they move; the join that follows drops the rest. With many more ids than bits it
    lets everything pass, and the join does all the work.
    """
    place = F.pmod(F.xxhash64("id"), F.lit(FILTER_BITS))
    words = (
        ids.select(place.alias("place"))
        .groupBy(F.shiftright("place", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(place & 63 AS INT))")).alias("bits"))
        .toArrow()
    )
    bitmap = np.zeros(FILTER_BITS >> 6, np.int64)
    bitmap[words.column(0).to_numpy()] = words.column(1).to_numpy()
    shared = rows.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(2).to_numpy()
            wanted = shared.value[at >> 6] >> (at & 63) & 1
            yield from _pack([batch.filter(pa.array(wanted.astype(bool)))])

    near = rows.select("id", "text", place.alias("place")).mapInArrow(run, "id long, size long, packed binary")
    return near.join(ids, "id", "left_semi")


def _pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    codec = pa.Codec(_CODEC)
    for batch in batches:
        for first, end, data, bounds in chunks(batch.column(1)):
            texts = [codec.compress(data[a:b], asbytes=True) for a, b in zip(bounds[:-1], bounds[1:])]
            columns = [batch.column(0).slice(first, end - first), pa.array(np.diff(bounds)), pa.array(texts, pa.binary())]
            yield pa.record_batch(columns, names=["id", "size", "packed"])


def unpacked(batch: pa.RecordBatch) -> Iterator[tuple[int, bytes]]:
    """Row number and text of each row."""
    codec = pa.Codec(_CODEC)
    size, texts = batch.schema.get_field_index("size"), batch.schema.get_field_index("packed")
    for row in range(batch.num_rows):
        n = batch.column(size)[row].as_py()
        yield row, codec.decompress(batch.column(texts)[row].as_buffer(), n, asbytes=True) if n else b""
    give_back()
