"""WARC archives with payload de-duplication and a merged capture index.

Writing: the digest of each payload is compared by one aggregate and one join;
of equal payloads of a minimum size the smallest page_id is stored as response,
the others as revisit records without payload.  Records are plain text columns
whose record separator is the writer's line separator, so Spark's committer
writes the archive files (gzip) to any store it reaches.

Reading: each archive file is parsed and checked by one task and yields a run of
index entries sorted by URL key, timestamp and page_id.  Runs are cut at global
split keys taken from a bounded sample, and each key range is merged from all
its runs by a loser tree, which gives the capture histories in global order.
The split keys end in the page_id, so a URL with very many captures is spread
over several ranges.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_right

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import saved

MIN_BYTES = 100  # smaller payloads are always stored
RECORDS_PER_FILE = 10_000
RANGE_ROWS = 100_000  # index entries a merge aims at
SAMPLE_PER_RANGE = 64
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


# ----------------------------------------------------------------- writing ---


def _line(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def records(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """One row per page: its record as text (``value``), without the separator.

    The capture date of a page without one is 2020-01-01 plus page_id seconds.
    """
    captured = F.col("captured").cast("timestamp") if "captured" in pages.columns else F.lit(None).cast("timestamp")
    known = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A").alias("url"),
        F.coalesce("html", F.lit("")).alias("payload"),
        F.coalesce(captured, F.timestamp_seconds(F.lit(1577836800) + F.coalesce("page_id", F.lit(0)) % 1_000_000_000)).alias("date"),
    ).withColumn("digest", F.sha2(F.col("payload").cast("binary"), 256)).withColumn("bytes", F.octet_length("payload").cast("long"))
    repeated = (
        known.where(F.col("bytes") >= min_bytes)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "first")
    )
    rows = known.join(repeated, "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(END)
    )
    block = F.when(revisit, http).otherwise(F.concat(http, "payload"))
    head = F.concat(
        F.lit("WARC/1.0\r\n"),
        _line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _line("WARC-Record-ID", _record_id(F.col("page_id"))),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Date", F.date_format("date", "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        _line("WARC-Refers-To", F.when(revisit, _record_id(F.col("first")))),
        _line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        _line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
    )
    return rows.select(F.concat(head, block).alias("value"))


def write(pages: DataFrame, out: str, min_bytes: int = MIN_BYTES) -> None:
    """Write gzip archive files of at most RECORDS_PER_FILE records under ``out``."""
    (
        records(pages, min_bytes)
        .write.option("lineSep", END)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .text(out)
    )


# ----------------------------------------------------------------- reading ---


class _Stream:
    """Bytes of a gzip file, decompressed as they are asked for."""

    def __init__(self, data: bytes, step: int = 1 << 16):
        self.data, self.step, self.at = memoryview(data), step, 0
        self.inflate, self.held, self.offset = zlib.decompressobj(31), bytearray(), 0

    def _more(self) -> bool:
        if self.at >= len(self.data):
            return False
        part = self.data[self.at : self.at + self.step]
        self.at += len(part)
        self.held += self.inflate.decompress(part)
        while self.inflate.eof and self.inflate.unused_data:  # a further gzip member
            rest, self.inflate = self.inflate.unused_data, zlib.decompressobj(31)
            self.held += self.inflate.decompress(rest)
        return True

    def until(self, mark: bytes) -> bytes | None:
        """Bytes up to and without ``mark``, which is skipped; None at the end."""
        seen = 0
        while (k := self.held.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.held)
            if not self._more():
                if self.held:
                    raise ValueError("the archive ends within a record")
                return None
        return self.take(k + len(mark))[:k]

    def take(self, n: int) -> bytes:
        while len(self.held) < n:
            if not self._more():
                raise ValueError("the archive ends within a record")
        out = bytes(self.held[:n])
        del self.held[:n]
        self.offset += n
        return out


def parse(data: bytes):
    """Yield (headers by lower-case name, payload bytes, offset, length) per record."""
    stream, end = _Stream(data), END.encode()
    while True:
        at = stream.offset
        head = stream.until(end)
        if head is None:
            return
        lines = head.decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at {at}")
        headers = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
        block = stream.take(int(headers["content-length"]))
        if stream.take(len(end)) != end:
            raise ValueError(f"the record at {at} does not end")
        yield headers, block, at, stream.offset - at


def url_key(url: str | None) -> str:
    """Sort key of a URL: host labels reversed, then path and query; no scheme,
    default port, fragment or letter case of the host."""
    m = re.match(r"(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#]*)([^#]*)", url or "")
    if not m:
        return (url or "").partition("#")[0]
    host = re.sub(r":(80|443)?$", "", m[1].lower())
    name, colon, port = host.partition(":")
    return ",".join(reversed(name.split("."))) + colon + port + ")" + (m[2] or "/")


ENTRY = (
    "url_key string, timestamp string, page_id long, record_type string, payload_bytes long, payload_digest string, "
    "refers_to long, url string, file string, offset long, length long"
)
_NAMES = [f.split()[0] for f in ENTRY.split(", ")]


def sort_key(url_key, timestamp, page_id):
    """Order of index entries; a NULL page_id comes first."""
    return url_key, timestamp, page_id is not None, page_id or 0


def _entry(file, headers, block, offset, length):
    http, _, payload = block.partition(END.encode())
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = headers["warc-payload-digest"].removeprefix("sha256:")
    kind = headers["warc-type"]
    if kind == "response":
        if len(payload) != size or hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"damaged payload in {file} at {offset}")
    page = re.fullmatch(r"<urn:page:(-?\d+|none)>", headers["warc-record-id"])[1]
    to = headers.get("warc-refers-to")
    return (
        url_key(headers.get("warc-target-uri")),
        re.sub(r"\D", "", headers["warc-date"]),
        None if page == "none" else int(page),
        kind,
        size,
        digest,
        int(re.fullmatch(r"<urn:page:(-?\d+)>", to)[1]) if to else None,
        headers.get("warc-target-uri"),
        file,
        offset,
        length,
    )


def _columns(rows):
    import pyarrow as pa

    kinds = [pa.string() if f.endswith("string") else pa.int64() for f in ENTRY.split(", ")]
    cols = list(zip(*rows)) or [()] * len(kinds)
    return [pa.array(c, k) for c, k in zip(cols, kinds)]


def _run_batches(batches):
    import pyarrow as pa

    for b in batches:
        for k in range(b.num_rows):
            path = b.column(0)[k].as_py()
            file = path.rsplit("/", 1)[-1]
            rows = [_entry(file, *r) for r in parse(b.column(1)[k].as_buffer())]
            rows.sort(key=lambda r: sort_key(*r[:3]))
            cols = _columns(rows) + [pa.array(range(len(rows)), pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, [*_NAMES, "position"])


def runs(spark, path: str) -> DataFrame:
    """Index entries of every archive file, each file's sorted (``position``)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return files.mapInArrow(_run_batches, ENTRY + ", position long")


# ----------------------------------------------------------------- merging ---


class LoserTree:
    """k-way merge of sorted sequences: each inner node keeps the loser of its
    match, so the next item costs one match per level."""

    def __init__(self, sequences, key):
        self.key = key
        self.sources = [iter(s) for s in sequences]
        k = self.k = len(self.sources)
        self.heads = [self._next(i) for i in range(k)]
        self.losers = [0] * max(1, k)
        winners = [0] * k + list(range(k))
        for node in range(k - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            win, lose = (a, b) if self._wins(a, b) else (b, a)
            winners[node], self.losers[node] = win, lose
        self.losers[0] = winners[1] if k > 1 else 0  # the overall winner

    def _next(self, i):
        item = next(self.sources[i], None)
        return None if item is None else (self.key(item), item)

    def _wins(self, a, b):
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return (x[0], a) < (y[0], b)

    def __iter__(self):
        while self.k and self.heads[w := self.losers[0]] is not None:
            yield self.heads[w][1]
            self.heads[w] = self._next(w)
            node = (w + self.k) // 2
            while node:
                if self._wins(self.losers[node], w):
                    w, self.losers[node] = self.losers[node], w
                node //= 2
            self.losers[0] = w


def _range_batches(splits):
    def run(batches):
        import pyarrow as pa

        for b in batches:
            keys = zip(*(b.column(i).to_pylist() for i in range(3)))
            at = [bisect_right(splits, sort_key(*k)) for k in keys]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at, pa.int64())], [*b.schema.names, "part"])

    return run


def _merge_part(table):
    import pyarrow as pa

    by_run: dict[str, list] = {}
    rows = zip(*(table.column(n).to_pylist() for n in [*_NAMES, "position"]))
    for r in rows:
        by_run.setdefault(r[8], []).append(r)
    for run in by_run.values():
        run.sort(key=lambda r: r[-1])  # each run comes sorted; the shuffle may have mixed its blocks
    merged = [r[:-1] for r in LoserTree([by_run[f] for f in sorted(by_run)], key=lambda r: sort_key(*r[:3]))]
    part = table.column("part")[0].as_py()
    cols = _columns(merged) + [pa.array([part] * len(merged), pa.int64()), pa.array(range(len(merged)), pa.int64())]
    return pa.table(cols, names=[*_NAMES, "part", "local"])


def merge(entries: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Merge sorted runs into global order: the entries with ``sequence``, their
    number in the order of URL key, timestamp and page_id."""
    entries = saved(entries, "capture-runs")
    n = entries.count()
    ranges = max(1, -(-n // range_rows))
    splits = []
    if ranges > 1:
        want = SAMPLE_PER_RANGE * ranges  # at most this many keys reach the driver
        drawn = entries.select("url_key", "timestamp", "page_id").sample(min(1.0, want / n), seed=3).limit(want).collect()
        keys = sorted(sort_key(*r) for r in drawn)
        splits = sorted({keys[i * len(keys) // ranges] for i in range(1, ranges)}) if keys else []
    dealt = entries.mapInArrow(_range_batches(splits), ENTRY + ", position long, part long")
    merged = saved(dealt.groupBy("part").applyInArrow(_merge_part, ENTRY + ", part long, local long"), "captures")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    sizes = merged.groupBy("part").agg(F.count("*").alias("n"))
    base = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return merged.join(base, "part").withColumn("sequence", F.col("base") + F.col("local")).select(*_NAMES, "sequence")


def archive(pages: DataFrame, min_bytes: int = MIN_BYTES, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives under the shared folder,
    read them back and return the merged index, one row per page.

    NULL html is an empty payload; a NULL url has an empty key; a NULL page_id
    never is the response others refer to unless no page of its payload has an
    id, then all of them are responses; repeated rows with the smallest page_id
    all are responses; an empty table gives an empty index; other columns are
    ignored (``captured``, if there is one, is the capture time).
    """
    spark = pages.sparkSession
    out = scratch_path(spark, "archives")
    write(pages, out, min_bytes)
    return merge(runs(spark, out), range_rows)


def oracle(min_bytes: int = MIN_BYTES) -> str:
    return f"""
      WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
      q AS (SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes, sha256(h) AS payload_digest FROM p),
      f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM q)
      SELECT page_id, payload_bytes, payload_digest,
             CASE WHEN payload_bytes >= {min_bytes} AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
             CASE WHEN payload_bytes >= {min_bytes} AND page_id > first THEN first END AS refers_to
      FROM f"""
