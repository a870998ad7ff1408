import gzip
import hashlib
import random
from pathlib import Path

from vanescope.llm import warc

PAGES = [
    (1, "http://b.example.com/x", "same " * 40),
    (2, "http://b.example.com/x", "same " * 40),
    (2, "http://b.example.com/x", "same " * 40),
    (3, None, "same " * 40),
    (4, "https://www.a.example.org:80/Q?z=1#f", "short"),
    (5, "http://a b.example/\r\nEvil: yes", "short"),
    (6, "relative", None),
    (7, "http://é.example/", ""),
    (8, "http://c.example/", "é\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" + "ü" * 100),
    (9, "http://c.example/", "é\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" + "ü" * 100),
    (None, "http://d.example/", "same " * 40),
    (None, "http://d.example/", "only here " * 20),
    (10, "http://e.example/", "x" * 3_000_000),
    (11, "http://e.example/", "y" * 100),
    (11, "http://e.example/", "z" * 100),
    (12, "http://e.example/", "z" * 100),
]


def table(spark, rows):
    full = [(i, u, h, 1, "x", "y") for i, u, h in rows]
    return spark.createDataFrame(full, "page_id long, url string, html string, bytes long, digest string, first string")


def expected(rows):
    first = {}
    for i, _, h in rows:
        raw = (h or "").encode()
        if len(raw) >= 100 and i is not None:
            first[raw] = min(first.get(raw, i), i)
    out = []
    for i, _, h in rows:
        raw = (h or "").encode()
        to = first.get(raw)
        revisit = to is not None and to != i
        out.append((str(i), len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", to if revisit else None))
    return sorted(map(str, out))


def found(df):
    rows = warc.round_trip(df).collect()
    return sorted(str((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in rows)


def test_round_trip(spark):
    assert found(table(spark, PAGES)) == expected(PAGES)
    assert found(table(spark, [])) == []


def test_files_are_archives(spark, tmp_path):
    path = f"{tmp_path}/archives"
    warc.write_archives(table(spark, PAGES).coalesce(1), path)
    content = b"".join(gzip.decompress(f.read_bytes()) for f in sorted(Path(path).glob("*.gz")))
    at, n = 0, 0
    while at < len(content):
        head = content[at : content.index(b"\r\n\r\n", at)].decode().split("\r\n")
        assert head[0] == "WARC/1.1"
        fields = dict(line.split(": ", 1) for line in head[1:])
        assert "Evil" not in fields and fields["WARC-Type"] in ("response", "revisit")
        at += len("\r\n".join(head).encode()) + 4 + int(fields["Content-Length"])
        assert content[at : at + 4] == b"\r\n\r\n"
        at, n = at + 4, n + 1
    assert n == len(PAGES)


def test_index_is_in_global_order(spark, tmp_path):
    pages = table(spark, [(i, f"http://h{i % 7}.example/{i % 3}", "p" * i) for i in range(400)])
    warc.write_archives(pages.repartition(5), f"{tmp_path}/archives")
    index = warc.merged_index(warc.read_archives(spark, f"{tmp_path}/archives"))
    keys = [(r.url_key, r.captured, r.file, r.offset) for r in index.collect()]
    assert len(keys) == 400 and keys == sorted(keys)


def test_loser_tree():
    pick = random.Random(13)
    for n in range(9):
        runs = [sorted(pick.choices(range(50), k=pick.randint(0, 20))) for _ in range(n)]
        assert list(warc.LoserTree([iter(r) for r in runs], lambda x: x)) == sorted(sum(runs, []))


def test_url_keys():
    assert warc.url_key("https://www.A.example.org:80/Q?z=1#f") == "org,example,a:80)/q?z=1"
    assert warc.url_key("http://u@x.y") == "y,x)/"
    assert warc.url_key("urn:page:1") == "urn:page:1"
