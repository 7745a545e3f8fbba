"""Byte-level BPE of whole tables: every distinct word is encoded once.

1. Texts are cut into pre-tokens (``pieces.py``).  A task handles some million
   characters at a time, a chunk.  Its distinct words are numbered, the most
   frequent first, and the chunk becomes one row: its words, and the numbers of the
   words in order, per document.  So a word crosses the network once a chunk,
   however often it stands there.
2. The words of all chunks are shuffled in blocks by hash bucket; one task meets
   all occurrences of a word and encodes it once, by the ranks of a public
   vocabulary.  Every bucket has at most one block per chunk: no word is hot.
3. The ids of each block go back to its chunk, where every document is put
   together again from them by position.
4. Decoding joins every id with the table of token bytes (one row per token of
   the vocabulary, held by each worker) and puts them together in order.

The chunks are shuffled once and read by both 2 and 3; if an executor is lost, its
chunks are cut anew, the same as before where ``docs`` gives the same rows in the
same order (a table does; give ``common.saved`` of anything else).
"""

from __future__ import annotations

import zlib

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import pieces
from .common import worker_cache

RANKS = "byte_bpe_multi_50k.tiktoken"
CHUNK_CHARS = 1 << 23  # a chunk ends with the document that reaches this
BUCKETS = 512  # of words; a task holds the distinct words of one bucket
BATCH_BYTES = 1 << 23  # of ids in one output batch


def ranks_path(path: str | None = None) -> str:
    """The vocabulary file; its splitting pattern must be the one that is built in."""
    import public_tokenizers

    if public_tokenizers.PATTERN != pieces.PATTERN:
        raise ValueError("the vocabulary is made for another splitting pattern")
    return path or public_tokenizers.path(RANKS)


def load_ranks(path: str) -> dict[bytes, int]:
    import base64

    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def _cached(name, path, make):
    cache = worker_cache(name)
    if path not in cache:
        cache[path] = make(load_ranks(path))
    return cache[path]


# ------------------------------------------------------------------- cutting ---


class _Words:
    """Distinct words of one chunk and how often each stands there."""

    def __init__(self):
        self.index: dict[bytes, int] = {}

    def numbers(self, found):
        """Numbers of the words of an Arrow array, in order of appearance."""
        import numpy as np

        coded = found.dictionary_encode()
        index = self.index
        own = [index.setdefault(w, len(index)) for w in coded.dictionary.to_pylist()]
        return np.array(own, np.uint32)[coded.indices.to_numpy()] if own else np.zeros(0, np.uint32)

    def ranked(self, numbers):
        """(words, numbers) with the most frequent words first."""
        import numpy as np

        words = list(self.index)
        flat = np.concatenate(numbers) if numbers else np.zeros(0, np.uint32)
        order = np.argsort(-np.bincount(flat, minlength=len(words)), kind="stable")
        place = np.empty(len(words), np.uint32)
        place[order] = np.arange(len(words), dtype=np.uint32)
        return [words[i] for i in order.tolist()], place[flat] if flat.size else flat


def _packed(parts) -> bytes:
    """Arrays, each split into the planes of its bytes (high ones hold little), compressed."""
    import numpy as np
    import zstandard

    out = [np.array([len(parts), *(x for p in parts for x in (p.itemsize, p.size))], "<i8").tobytes()]
    out += [np.ascontiguousarray(p.view(np.uint8).reshape(-1, p.itemsize).T).tobytes() for p in parts]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def _unpacked(data: bytes):
    """The arrays, as unsigned integers."""
    import numpy as np
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(data)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    shapes, at, out = np.frombuffer(raw, "<i8", 2 * n, 8).reshape(n, 2).tolist(), 8 + 16 * n, []
    for wide, size in shapes:
        planes = np.frombuffer(raw, np.uint8, wide * size, at).reshape(wide, size)
        out.append(np.ascontiguousarray(planes.T).view(f"<u{wide}").reshape(-1))
        at += wide * size
    return out


def _bytes(items: list[bytes]):
    """Byte strings as two arrays, their lengths and their bytes."""
    import numpy as np

    return [np.array(list(map(len, items)), "<u4"), np.frombuffer(b"".join(items), np.uint8)]


def _items(sizes, data) -> list[bytes]:
    import numpy as np

    ends, data = np.cumsum(sizes).tolist(), data.tobytes()
    return [data[a:b] for a, b in zip([0, *ends], ends)]


def _order(words: list[bytes], buckets: int):
    """(bucket of each word, the words' indices by bucket and, within it, number)."""
    import numpy as np

    bucket = np.fromiter((zlib.crc32(w) % buckets for w in words), np.int32, len(words))
    return bucket, np.argsort(bucket, kind="stable")


def _cut_batches(chunk_chars):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        classes = pieces.unicode_classes()
        base, made = TaskContext.get().partitionId() << 33, 0
        found, doc_ids, counts, numbers, chars = _Words(), [], [], [], 0

        def flush():
            nonlocal found, doc_ids, counts, numbers, chars, made
            words, flat = found.ranked(numbers)
            ids = np.array([d or 0 for d in doc_ids], "<i8")
            known = np.array([d is not None for d in doc_ids], "<u1")
            data = _packed([ids, known, np.array(counts, "<u4"), flat.astype("<u4"), *_bytes(words)])
            chunk = base + made
            made += 1
            found, doc_ids, counts, numbers, chars = _Words(), [], [], [], 0
            return pa.RecordBatch.from_arrays([pa.array([chunk]), pa.array([data], pa.binary())], ["chunk", "data"])

        for b in batches:
            at = 0
            while at < b.num_rows:
                group, own = [], 0
                while at < b.num_rows and (not group or own < pieces.WINDOW_CHARS):
                    group.append((b.column(0)[at].as_py(), b.column(1)[at].as_py() or ""))
                    own += len(group[-1][1])
                    at += 1
                if own <= 2 * pieces.WINDOW_CHARS:
                    parts, inner, n = pieces.cut([t for _, t in group], classes)
                    numbers.append(found.numbers(parts.filter(pa.array(inner)) if len(group) > 1 else parts))
                    doc_ids += [i for i, _ in group]
                    counts += n.tolist()
                else:
                    for i, t in group:
                        got = [found.numbers(x) for x in pieces.cut_long(t, classes)]
                        numbers += got
                        doc_ids.append(i)
                        counts.append(sum(map(len, got)))
                chars += own
                if chars >= chunk_chars:
                    yield flush()
        if doc_ids:
            yield flush()

    return run


def chunks(docs: DataFrame, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """(chunk, data): the documents of each chunk as numbers of its words, and its words."""
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(_cut_batches(chunk_chars), "chunk long, data binary")


def words_of(data: bytes) -> list[bytes]:
    """The distinct words of a chunk, by number."""
    return _items(*_unpacked(data)[4:])


def _block_batches(buckets):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            for chunk, data in zip(b.column("chunk").to_pylist(), b.column("data")):
                words = words_of(data.as_py())
                bucket, by = _order(words, buckets)
                bounds = np.searchsorted(bucket[by], np.arange(buckets + 1)).tolist()
                full = [k for k in range(buckets) if bounds[k + 1] > bounds[k]]
                blocks = [_packed(_bytes([words[i] for i in by[bounds[k] : bounds[k + 1]].tolist()])) for k in full]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk] * len(full), pa.int64()), pa.array(full, pa.int32()), pa.array(blocks, pa.binary())],
                    ["chunk", "bucket", "data"],
                )

    return run


# ------------------------------------------------------------------- encoding ---


def _encode_batches(path):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        import tiktoken

        def encoding(ranks):
            return tiktoken.Encoding("words", pat_str=pieces.PATTERN, mergeable_ranks=ranks, special_tokens={})

        encode = _cached("encodings", path, encoding).encode_ordinary
        bucket, known = None, {}
        for b in batches:
            out = []
            for own, block in zip(b.column("bucket").to_pylist(), b.column("data").to_pylist()):
                if own != bucket:
                    bucket, known = own, {}
                words = _items(*_unpacked(block))
                for w in words:
                    if w not in known:
                        known[w] = np.array(encode(w.decode("utf-8", "surrogatepass")), "<u4").tobytes()
                ids = [known[w] for w in words]
                out.append(_packed([np.array(list(map(len, ids)), "<u4"), np.frombuffer(b"".join(ids), "<u4")]))
            yield pa.RecordBatch.from_arrays([b.column("chunk"), b.column("bucket"), pa.array(out, pa.binary())], ["chunk", "bucket", "data"])

    return run


def _binary(ends, data):
    """Arrow array of the byte strings that fill ``data`` from one end to the next."""
    import numpy as np
    import pyarrow as pa

    return pa.Array.from_buffers(
        pa.binary(), len(ends) - 1, [None, pa.py_buffer(np.asarray(ends).astype(np.int32)), pa.py_buffer(data)]
    )


def encode_blocks(blocks: DataFrame, path: str | None = None) -> DataFrame:
    """(chunk, bucket, data: words) -> (chunk, bucket, data: their ids); the blocks of a bucket meet in one task."""
    blocks = blocks.repartition("bucket").sortWithinPartitions("bucket")
    return blocks.mapInArrow(_encode_batches(ranks_path(path)), "chunk long, bucket int, data binary")


# ---------------------------------------------------------------- reassembly ---


def _taken(words, numbers):
    """The byte strings ``words`` at ``numbers``: where each ends (from 0), and their bytes in a row."""
    import numpy as np

    got = words.take(numbers)
    _, offsets, data = got.buffers()
    ends = np.frombuffer(offsets, np.int32)[got.offset : got.offset + len(got) + 1].astype(np.int64)
    return ends - ends[0], (data if data is not None else b"")[int(ends[0]) : int(ends[-1])]


def _assemble(batch_bytes, buckets):
    def run(heads, blocks):
        """One chunk and the ids of its words, by bucket -> its documents."""
        import numpy as np
        import pyarrow as pa

        schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])
        if not heads.num_rows:
            return pa.table({"doc_id": [], "ids": []}, schema=schema)
        doc_ids, known, counts, numbers, *own = _unpacked(heads.column("data")[0].as_py())
        doc_ids = pa.array(doc_ids.view(np.int64), mask=known == 0)
        blocks = blocks.sort_by("bucket").column("data")
        parts = [_unpacked(b.as_py()) for b in blocks]
        lengths = np.concatenate([p[0] for p in parts] or [np.zeros(0, np.uint32)]).astype(np.int64)
        words = _binary(np.append(0, np.cumsum(lengths)), b"".join(p[1].tobytes() for p in parts))
        _, by = _order(_items(*own), buckets)
        place = np.empty(by.size, np.int32)  # of a number among the words, which come by bucket
        place[by] = np.arange(by.size, dtype=np.int32)
        bounds = np.append(0, np.cumsum(counts, dtype=np.int64))  # of the documents, in words
        out, k = [], 0
        while k < len(doc_ids):  # some million words at a time
            end = max(k + 1, int(np.searchsorted(bounds, bounds[k] + batch_bytes // 8, "right")) - 1)
            ends, data = _taken(words, pa.array(place[numbers[bounds[k] : bounds[end]]]))
            ids = _binary(ends[bounds[k : end + 1] - bounds[k]], data)
            out.append(pa.RecordBatch.from_arrays([doc_ids.slice(k, end - k), ids], schema=schema))
            k = end
        return pa.Table.from_batches(out, schema=schema)

    return run


def encode(docs: DataFrame, path: str | None = None, chunk_chars: int = CHUNK_CHARS, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, ids) for every row of ``docs``: the token ids of its text as
    little-endian unsigned 32-bit integers.

    NULL and empty texts have no ids; repeated rows stay repeated; a NULL doc_id
    stays NULL; a very long text is cut a window at a time and never split over
    rows; an empty table gives an empty result; other columns are ignored.
    """
    cut = chunks(docs, chunk_chars).repartition("chunk")
    ids = encode_blocks(cut.mapInArrow(_block_batches(buckets), "chunk long, bucket int, data binary"), path)
    return cut.groupBy("chunk").cogroup(ids.groupBy("chunk")).applyInArrow(_assemble(BATCH_BYTES, buckets), "doc_id long, ids binary")


# ------------------------------------------------------------------- decoding ---


def _decode_batches(path):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        def table(ranks):
            tokens = [None] * (max(ranks.values()) + 1)
            for token, rank in ranks.items():
                tokens[rank] = token
            return pa.array(tokens, pa.binary())

        tokens = _cached("token bytes", path, table)
        known = tokens.is_valid().to_numpy(zero_copy_only=False)
        for b in batches:
            texts = []
            for x in b.column("ids"):
                ids = np.frombuffer(x.as_buffer() if x.is_valid else b"", "<u4")
                if ids.size and (int(ids.max()) >= known.size or not known[ids].all()):
                    raise ValueError("an id is outside the vocabulary")
                texts.append(bytes(_taken(tokens, pa.array(ids))[1]) if ids.size else b"")
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.binary())], [*b.schema.names, "bytes"])

    return run


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``encoded`` with ``bytes``, what its ``ids`` (as ``encode`` makes them) stand
    for: each id joined with its token's bytes, in order.  NULL ids give empty
    bytes; an id outside the vocabulary raises; all columns are kept."""
    schema = T.StructType([*encoded.schema.fields, T.StructField("bytes", T.BinaryType())])
    return encoded.mapInArrow(_decode_batches(ranks_path(path)), schema)


def digests(decoded: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of rows with ids and bytes."""
    return decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


def round_trip(docs: DataFrame, path: str | None = None, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """The digests of every text's ids and of what they decode to (see ``encode``)."""
    return digests(decode(encode(docs, path, chunk_chars), path))
