"""Token ids as wavelet matrices, one compressed file per shard.

A shard holds the ids of consecutive documents.  Its ids are stored as bit
planes from the highest bit down; each plane orders the ids by the bits above
it (zeros first, stable), and carries running counts of ones per block, which
give rank by one look-up and a popcount, and select by binary search.  Access
to one position, counts of an id and its k-th occurrence each walk the planes
once, without decoding anything else.

File: the magic line, a little-endian 32-bit length and a JSON header, then the
zstandard frames the header lists: document ids, document lengths, and per
plane its running counts and its bits.  Spark's writer commits the files (and
adds one final line feed), Spark's binary reader reads them back.
"""

from __future__ import annotations

import json
import zlib

from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import saved
from .tokens import documents

MAGIC = b"wavelet matrix 1\n"
SHARD_TOKENS = 1 << 22  # a shard ends with the document that reaches this
BLOCK = 1024  # bits per running count
END_ID = 0


class Shard:
    """One shard: ``doc_ids`` (None allowed), ``lengths`` and the bit planes."""

    def __init__(self, n, zeros, words, counts, doc_ids, lengths, key):
        self.n, self.zeros, self.words, self.counts = n, zeros, words, counts
        self.doc_ids, self.lengths, self.key = doc_ids, lengths, key

    # -------------------------------------------------------------- writing ---

    @classmethod
    def build(cls, ids, doc_ids, lengths, key=(0, 0)):
        import numpy as np

        ids = np.asarray(ids, np.uint32)
        width = int(ids.max()).bit_length() if ids.size else 0
        x = ids.astype(np.uint16) if width <= 16 else ids
        zeros, words, counts = [], [], []
        pad = -ids.size % BLOCK
        for b in range(width - 1, -1, -1):
            ones = x & x.dtype.type(1 << b) != 0
            bits = np.packbits(np.concatenate([ones, np.zeros(pad, bool)]), bitorder="little").view(np.uint64)
            per = np.bitwise_count(bits).reshape(-1, BLOCK // 64).sum(1, dtype=np.uint32)
            words.append(bits)
            counts.append(np.concatenate([np.zeros(1, np.uint32), np.cumsum(per, dtype=np.uint32)]))
            zeros.append(int(ids.size - counts[-1][-1]))
            x = np.concatenate([x.take(np.flatnonzero(~ones)), x.take(np.flatnonzero(ones))])
        return cls(ids.size, zeros, words, counts, list(doc_ids), list(lengths), tuple(key))

    def to_bytes(self) -> bytes:
        import numpy as np
        import zstandard

        pack = zstandard.ZstdCompressor(level=1).compress
        known = np.array([d is not None for d in self.doc_ids], np.uint8)
        frames = [
            pack(known.tobytes()),
            pack(np.array([d or 0 for d in self.doc_ids], np.int64).tobytes()),
            pack(np.array(self.lengths, np.uint32).tobytes()),
        ]
        for w, c in zip(self.words, self.counts):
            frames += [pack(c.tobytes()), pack(w.tobytes())]
        head = json.dumps(
            {"key": self.key, "tokens": self.n, "zeros": self.zeros, "frames": [len(f) for f in frames]}
        ).encode()
        return b"".join([MAGIC, len(head).to_bytes(4, "little"), head, *frames])

    # -------------------------------------------------------------- reading ---

    @classmethod
    def from_bytes(cls, data: bytes):
        import numpy as np
        import zstandard

        if not data.startswith(MAGIC):
            raise ValueError("not a wavelet matrix file")
        at = len(MAGIC) + 4
        size = int.from_bytes(data[at - 4 : at], "little")
        head = json.loads(data[at : at + size])
        at += size
        frames = []
        unpack = zstandard.ZstdDecompressor().decompress
        for k in head["frames"]:
            frames.append(unpack(data[at : at + k]))
            at += k
        known, doc_ids = np.frombuffer(frames[0], np.uint8), np.frombuffer(frames[1], np.int64)
        return cls(
            head["tokens"],
            head["zeros"],
            [np.frombuffer(f, np.uint64) for f in frames[4::2]],
            [np.frombuffer(f, np.uint32) for f in frames[3::2]],
            [int(d) if k else None for d, k in zip(doc_ids, known)],
            np.frombuffer(frames[2], np.uint32).tolist(),
            tuple(head["key"]),
        )

    def _ones(self, plane: int, i: int) -> int:
        """Ones among the first ``i`` bits of a plane."""
        import numpy as np

        block = i // BLOCK
        w = self.words[plane][block * (BLOCK // 64) : i // 64]
        n = int(self.counts[plane][block]) + int(np.bitwise_count(w).sum())
        if i % 64:
            n += (int(self.words[plane][i // 64]) & ((1 << i % 64) - 1)).bit_count()
        return n

    def _bit(self, plane: int, i: int) -> int:
        return int(self.words[plane][i // 64]) >> i % 64 & 1

    def access(self, i: int) -> int:
        """The id at position ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for p, z in enumerate(self.zeros):
            bit, ones = self._bit(p, i), self._ones(p, i)
            value = value * 2 + bit
            i = z + ones if bit else i - ones
        return value

    def _range(self, token: int, i: int):
        """Where the ids equal to ``token`` among the first ``i`` end up: [lo, hi)."""
        lo, hi = 0, i
        if token >> len(self.zeros):
            return 0, 0
        for p, z in enumerate(self.zeros):
            a, b = self._ones(p, lo), self._ones(p, hi)
            lo, hi = (z + a, z + b) if token >> (len(self.zeros) - 1 - p) & 1 else (lo - a, hi - b)
        return lo, hi

    def rank(self, token: int, i: int) -> int:
        """How often ``token`` occurs among the first ``i`` ids."""
        lo, hi = self._range(token, min(i, self.n))
        return hi - lo

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def _select(self, plane: int, bit: int, k: int) -> int:
        """Position of the k-th (from 0) one or zero of a plane."""
        import numpy as np

        c = self.counts[plane].astype(np.int64)
        if not bit:
            c = np.arange(c.size, dtype=np.int64) * BLOCK - c
        block = int(np.searchsorted(c, k, "right")) - 1
        bits = np.unpackbits(
            self.words[plane][block * (BLOCK // 64) : (block + 1) * (BLOCK // 64)].view(np.uint8), bitorder="little"
        )
        return block * BLOCK + int(np.flatnonzero(bits == bit)[k - int(c[block])])

    def select(self, token: int, k: int) -> int:
        """Position of the k-th (from 0) occurrence of ``token``."""
        lo, hi = self._range(token, self.n)
        if not 0 <= k < hi - lo:
            raise IndexError(k)
        i = lo + k
        for p in range(len(self.zeros) - 1, -1, -1):
            bit = token >> (len(self.zeros) - 1 - p) & 1
            i = self._select(p, bit, i - self.zeros[p] if bit else i)
        return i

    def ids(self):
        """All ids, decoded from the lowest plane up."""
        import numpy as np

        width = len(self.zeros)
        x = np.zeros(self.n, np.uint16 if width <= 16 else np.uint32)
        for p in range(width - 1, -1, -1):
            ones = np.unpackbits(self.words[p].view(np.uint8), bitorder="little")[: self.n].view(bool)
            up = np.empty_like(x)
            up[np.flatnonzero(~ones)] = x[: self.zeros[p]]
            up[np.flatnonzero(ones)] = x[self.zeros[p] :] | x.dtype.type(1 << (width - 1 - p))
            x = up
        return x.astype(np.uint32)


def _shard_batches(path, end_id, shard_tokens):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        part, seq = TaskContext.get().partitionId(), 0
        doc_ids, arrays, n = [], [], 0

        def flush():
            blob = Shard.build(np.concatenate(arrays), doc_ids, [a.size for a in arrays], (part, seq)).to_bytes()
            return pa.RecordBatch.from_arrays([pa.array([blob], pa.binary())], ["blob"])

        for doc_id, ids in documents(batches, path, end_id):
            doc_ids.append(doc_id)
            arrays.append(ids)
            n += ids.size
            if n >= shard_tokens:
                yield flush()
                doc_ids, arrays, n, seq = [], [], 0, seq + 1
        if doc_ids:
            yield flush()

    return run


def write(docs: DataFrame, out: str, tokenizer: str | None = None, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS):
    """Write the ids of every row's text (NULL: empty), each followed by
    ``end_id``, to shard files under ``out`` in ascending doc_id order (NULL
    first, equal ids ordered by text).

    Documents are dealt to tasks by doc_id range, so a shard covers consecutive
    documents; a shard file is bounded by ``shard_tokens`` plus one document.
    """
    ordered = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    blobs = ordered.mapInArrow(_shard_batches(tokenizer, end_id, shard_tokens), "blob binary")
    blobs.select(F.col("blob").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).text(out)


def _read_batches(batches):
    import numpy as np
    import pyarrow as pa

    for b in batches:
        for k in range(b.num_rows):
            shard = Shard.from_bytes(b.column(0)[k].as_py())
            ids = shard.ids().astype("<u4")
            ends = np.cumsum(shard.lengths, dtype=np.int64)
            crcs = [zlib.crc32(ids[e - n : e]) for e, n in zip(ends.tolist(), shard.lengths)]
            n = len(shard.lengths)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([shard.key[0]] * n, pa.int64()),
                    pa.array([shard.key[1]] * n, pa.int64()),
                    pa.array(shard.doc_ids, pa.int64()),
                    pa.array(ends - np.array(shard.lengths, np.int64)),
                    pa.array(shard.lengths, pa.int64()),
                    pa.array(crcs, pa.int64()),
                ],
                ["part", "seq", "doc_id", "local", "n_tokens", "ids_crc32"],
            )


def read(spark, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the shard files.

    start: ids of all documents before it, from running sums over the shards of
    a range and over the ranges, never over documents.
    """
    blobs = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    rows = saved(
        blobs.mapInArrow(
            _read_batches, "part long, seq long, doc_id long, local long, n_tokens long, ids_crc32 long"
        ),
        "token-rows",
    )
    shards = rows.groupBy("part", "seq").agg(F.sum("n_tokens").alias("n"))
    parts = shards.groupBy("part").agg(F.sum("n").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    starts = shards.join(parts, "part").select(
        "part", "seq", (F.col("base") + F.coalesce(F.sum("n").over(within), F.lit(0))).alias("base")
    )
    return rows.join(starts, ["part", "seq"]).select(
        "doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"
    )


def round_trip(docs: DataFrame, tokenizer: str | None = None, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Write the shard files under the shared folder and read them back.

    One row per row of ``docs``; NULL and empty texts hold the end id alone; an
    empty table writes no shard and gives an empty result; other columns are
    ignored.
    """
    spark = docs.sparkSession
    out = scratch_path(spark, "wavelet-shards")
    write(docs, out, tokenizer, shard_tokens=shard_tokens)
    return read(spark, out)
