"""Web archives: pages to WARC files and back, with a merged index of captures.

Writing. Every page becomes a WARC/1.1 record of its own bytes. Of pages with equal payloads of at least
``LEAST_BYTES`` bytes the one with the smallest id is written as response, the others as revisits without
payload that refer to it. Spark's text writer, whose line end is the mark that ends a record, puts
files of ``RECORDS_PER_FILE`` records at most where all executors see them; a task that runs again
replaces its files.

Index. Each file is read by one task, which walks its records by their content lengths and gives a run of
index entries, sorted by URL key, time and record. Runs are cut at common boundaries of the key and each
range is merged with a loser tree: the smallest head of all runs comes out, and only the matches on its way
up the tree are played again. Ranges follow each other, so their concatenation is the capture history of
every URL in global order. A URL that is captured very often is cut by time as well.

Reading. The payload of a revisit is that of the response it refers to.

Defined results: a NULL payload is empty, and as such below the limit: a response. A NULL URL is written as
``urn:page:`` and the id; a URL with blanks or control characters is percent-encoded. Rows that repeat
a page are records of their own: all rows of the smallest id are responses. A page without id is never
referred to; it revisits an equal page that has an id. Archives without files give no rows.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vanescope.shared import scratch_path

LEAST_BYTES = 100
RECORDS_PER_FILE = 5_000

# The version line of a record and the marks that end headers and records.
_VERSION = "WARC/1.1"
_LINE, _END = "\r\n", "\r\n\r\n"
_PIECE = 1 << 20
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_ENTRY = "page_id long, record_type string, target string, refers_to long, digest string, bytes long, captured string, file string, offset long"


class LoserTree:
    """Merges sorted runs; ties come out in the order of the runs."""

    def __init__(self, runs: list[Iterator], key: Callable):
        self.key = key
        self.runs = runs
        self.heads = [next(run, None) for run in runs]
        n = len(runs)
        #: The loser of the match at each inner node; leaves n to 2n - 1 stand for the runs.
        self.losers = [-1] * n
        winners = [-1] * n + list(range(n))
        for node in range(n - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            winners[node], self.losers[node] = (a, b) if self._before(a, b) else (b, a)
        self.winner = winners[1] if n > 1 else n - 1

    def _before(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return (self.key(x), a) < (self.key(y), b)

    def __iter__(self) -> Iterator:
        n = len(self.runs)
        while n and self.heads[self.winner] is not None:
            run = self.winner
            yield self.heads[run]
            self.heads[run] = next(self.runs[run], None)
            node = (run + n) // 2
            while node:
                if self._before(self.losers[node], run):
                    run, self.losers[node] = self.losers[node], run
                node //= 2
            self.winner = run


def url_key(url: str) -> str:
    """Host labels from the top level down, then port, path and query, in lower case."""
    found = re.match(r"(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)(:\d+)?([^#]*)", url, re.I | re.S)
    if not found:
        return url.lower()
    host, port, rest = found[1].lower(), found[2] or "", found[3]
    if host.startswith("www."):
        host = host[4:]
    return ",".join(reversed(host.split("."))) + port + ")" + (rest.lower() or "/")


def write_archives(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", captured: Column | None = None
) -> None:
    """Write ``pages`` as WARC files below ``path``.

    ``captured``: time of capture; else the epoch and as many seconds as the id, since pages have none.
    """
    at = captured if captured is not None else F.timestamp_seconds(F.pmod(F.coalesce(pages[id_col].cast("long"), F.lit(0)), F.lit(1 << 31)))
    rows = pages.select(
        pages[id_col].cast("long").alias("id"),
        pages[url_col].cast("string").alias("url"),
        F.coalesce(pages[payload_col].cast("string"), F.lit("")).alias("payload"),
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"),
    )
    rows = rows.withColumn("bytes", F.octet_length("payload")).withColumn("digest", F.sha2(F.col("payload").cast("binary"), 256))
    # Which page holds an equal payload is found from digests; payloads move once at most, to their
    # files, and no two rows with much in common have to meet for that.
    facts = rows.where(f"bytes >= {LEAST_BYTES}").select("id", "digest")
    first = facts.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("copies")).where("copies > 1 AND first IS NOT NULL")
    refers = facts.join(first.drop("copies"), "digest").where("id IS NULL OR id <> first").distinct()
    refers = refers.select(F.col("id").alias("own"), F.col("digest").alias("equal"), "first")
    rows = rows.join(refers, F.col("id").eqNullSafe(F.col("own")) & (F.col("digest") == F.col("equal")), "left")
    id_ = F.coalesce(F.col("id").cast("string"), F.lit("none"))
    control = "[\\x00-\\x20\\x7F]"
    url = F.when(F.col("url").rlike(control), F.url_encode("url")).otherwise(F.col("url"))
    revisit = F.col("first").isNotNull()
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(_END)
    )
    headers = [
        F.lit(_VERSION),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), id_, F.lit(">")),
        F.concat(F.lit("WARC-Date: "), F.col("date")),
        F.concat(F.lit("WARC-Target-URI: "), F.coalesce(url, F.concat(F.lit("urn:page:"), id_))),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.col("first").cast("string"), F.lit(">\r\nWARC-Profile: " + _PROFILE))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), (F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("bytes"))).cast("string")),
    ]
    record = F.concat(F.concat_ws(_LINE, *headers), F.lit(_END), http, F.when(revisit, "").otherwise(F.col("payload")))
    writer = rows.select(record.alias("value")).write.option("lineSep", _END).option("compression", "gzip")
    writer.option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def _records(packed: memoryview) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers, block) of each record of a compressed archive, unpacked piece by piece."""
    unpacker = zlib.decompressobj(31)
    pieces = (unpacker.decompress(packed[at : at + _PIECE]) for at in range(0, len(packed), _PIECE))
    buffer, offset = b"", 0
    end = _END.encode()

    def more() -> bool:
        nonlocal buffer
        piece = next(pieces, None)
        if piece is not None:
            buffer += piece
        return piece is not None

    while buffer or more():
        while (stop := buffer.find(end)) < 0:
            if not more():
                if buffer:
                    raise ValueError(f"no record at byte {offset}")
                return
        lines = buffer[:stop].decode("utf-8", "replace").split(_LINE)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {offset}")
        headers = {name.lower(): value for name, _, value in (line.partition(": ") for line in lines[1:])}
        start = stop + len(end)
        size = start + int(headers["content-length"]) + len(end)
        while len(buffer) < size:
            if not more():
                raise ValueError(f"the record at byte {offset} is cut off")
        yield offset, headers, buffer[start : size - len(end)]
        buffer = buffer[size:]
        offset += size


def _page(uri: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", uri or "")
    return int(found[1]) if found else None


def read_archives(spark, path: str) -> DataFrame:
    """One index entry per record, in sorted runs, one run per file. Bytes and digest of a response
    are taken from the payload itself; a revisit has the digest of its header and no bytes."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                name = batch.column(0)[row].as_py()
                entries = []
                for offset, headers, block in _records(memoryview(batch.column(1)[row].as_buffer())):
                    payload = block[block.index(_END.encode()) + len(_END) :]
                    revisit = headers["warc-type"] == "revisit"
                    target = headers["warc-target-uri"]
                    entries.append(
                        (
                            _page(headers["warc-record-id"]), headers["warc-type"], target, _page(headers.get("warc-refers-to")),
                            headers["warc-payload-digest"].removeprefix("sha256:") if revisit else hashlib.sha256(payload).hexdigest(),
                            None if revisit else len(payload),
                            headers["warc-date"], name, offset, url_key(target),
                        )
                    )
                entries.sort(key=lambda e: (e[9], e[6], e[8]))
                names = [*(c.split()[0] for c in _ENTRY.split(", ")), "url_key"]
                kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
                columns = list(zip(*entries)) or [()] * len(names)
                yield pa.record_batch([pa.array(c, kind) for c, kind in zip(columns, kinds)], names=names)

    return files.mapInArrow(run, _ENTRY + ", url_key string")


def merged_index(entries: DataFrame) -> DataFrame:
    """All entries in order of URL key, time, file and offset, by merging runs within ranges of the key.

    The order is that of the partitions and of the rows in each; a writer keeps it.
    """
    ranges = entries.repartitionByRange("url_key", "captured", "file", "offset")
    names = entries.columns
    at = [names.index(c) for c in ("url_key", "captured", "file", "offset")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: dict[str, list[tuple]] = {}
        schema = None
        for batch in batches:
            schema = batch.schema
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                runs.setdefault(row[at[2]], []).append(row)

        def key(row: tuple) -> tuple:
            return tuple(row[i] for i in at)

        # Pieces of one run may arrive in any order.
        lists = [sorted(runs[name], key=key) for name in sorted(runs)]
        merged = list(LoserTree([iter(x) for x in lists], key))
        for first in range(0, len(merged), 10_000):
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*merged[first : first + 10_000]), schema)], schema=schema)

    return ranges.mapInArrow(run, entries.schema)


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Write archives, read them back and resolve revisits: one row per capture, from the index."""
    spark = pages.sparkSession
    path = scratch_path(spark, "archives")
    write_archives(pages, path, id_col, url_col, payload_col)
    index_path = scratch_path(spark, "captures")
    merged_index(read_archives(spark, path)).write.parquet(index_path)
    index = spark.read.parquet(index_path)
    # Rows that repeat a page repeat its response.
    responses = index.where("record_type = 'response'").select(F.col("page_id").alias("refers_to"), "digest", F.col("bytes").alias("their_bytes"))
    revisits = index.where("record_type = 'revisit'").join(responses.distinct(), ["refers_to", "digest"], "left")
    columns = ["page_id", "url_key", "captured", "record_type", "refers_to", "file", "offset"]
    return index.where("record_type = 'response'").select(*columns, F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest")).union(
        revisits.select(*columns, "their_bytes", "digest")
    )
