"""Archives: round trip, de-duplication and merge order."""

import gzip
import hashlib
import random
import subprocess

import pytest

from ledgerline.llm import warc
from ledgerline.session import scratch_path


def table(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def rows_of():
    rng = random.Random(8)
    big = "é\r\n\r\nWARC/1.0\r\n" * 30
    rows = [(i, f"http://h{i % 7}.example.com/p{rng.randrange(9)}?q=1", rng.choice([None, "", "x", "y" * 99, "z" * 100, big, big, f"page {i} " * 50])) for i in range(300)]
    return rows + [(300, None, big), (301, "http://a\r\nX: b/", "w" * 200000), (5, rows[5][1], rows[5][2]), (None, "http://n/", big), (None, "http://n/", "only here " * 20)]


def brute(rows):
    out, first = [], {}
    for i, _, h in rows:
        h = (h or "").encode()
        if len(h) >= 100 and i is not None:
            first[h] = min(first.get(h, i), i)
    for i, _, h in rows:
        h = (h or "").encode()
        again = len(h) >= 100 and h in first and i != first[h]
        out.append((i, len(h), hashlib.sha256(h).hexdigest(), "revisit" if again else "response", first[h] if again else None))
    return sorted(out, key=str)


def test_archive_equals_brute_force_in_global_order(spark):
    rows = rows_of()
    pages = table(spark, rows).selectExpr("*", "1 as first", "2 as digest", "3 as n", "4 as part")
    got = warc.archive(pages, range_rows=20).orderBy("sequence").collect()
    digest = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got]
    assert sorted(digest, key=str) == brute(rows)
    assert [r.sequence for r in got] == list(range(len(rows)))
    keys = [warc.sort_key(r.url_key, r.timestamp, r.page_id) for r in got]
    assert keys == sorted(keys)


def test_files_are_plain_archives(spark):
    out = scratch_path(spark, "archive-test")
    warc.write(table(spark, rows_of()), out)
    files = [r.path.removeprefix("file:") for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(out).select("path").collect()]
    n = 0
    for f in files:
        assert subprocess.run(["gzip", "-t", f]).returncode == 0
        data = open(f, "rb").read()
        raw = gzip.decompress(data)
        for headers, block, at, length in warc.parse(data):
            record = raw[at : at + length]
            assert record.startswith(b"WARC/1.0\r\n") and record.endswith(b"\r\n\r\n") and block in record
            n += 1
    assert n == len(rows_of())
    with pytest.raises(ValueError):
        list(warc.parse(gzip.compress(raw[:-9])))


def test_damaged_payload_is_noticed():
    raw = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\nWARC-Date: 2020-01-01T00:00:00Z\r\nWARC-Payload-Digest: sha256:00\r\nContent-Length: 24\r\n\r\nContent-Length: 2\r\n\r\nab\r\n\r\n"
    raw = raw.replace(b"Content-Length: 24", b"Content-Length: 23")
    (record,) = warc.parse(gzip.compress(raw))
    with pytest.raises(ValueError):
        warc._entry("f", *record)


@pytest.mark.parametrize("k", [0, 1, 2, 3, 5, 8, 13])
def test_loser_tree(k):
    rng = random.Random(k)
    seqs = [sorted(rng.randrange(50) for _ in range(rng.choice([0, 1, 40]))) for _ in range(k)]
    assert list(warc.LoserTree(seqs, key=lambda x: x)) == sorted(x for s in seqs for x in s)


def test_url_key():
    assert warc.url_key("HTTP://WWW.Example.com:80/A?b=C#d") == "com,example,www)/A?b=C"
    assert warc.url_key("https://u:p@x.org:8443") == "org,x:8443)/"
    assert warc.url_key(None) == "" and warc.url_key("odd#x") == "odd"


def test_empty_table(spark):
    assert warc.archive(table(spark, []).where("false")).collect() == []
