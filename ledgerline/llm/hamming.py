"""Exact k nearest binary codes by incremental multi-index hashing.

A vector's code holds one bit per dimension (1 where the value is positive).
Codes are cut into segments; an index lists the codes by the value of each
segment.  A query looks up all segment values within radius 0, then 1, 2 ... of
its own.  After radius r in all m segments every code nearer than m * (r + 1)
has been met (some segment differs in at most r bits, else they add up to at
least m * (r + 1)), so the search ends as soon as the k-th verified distance is
below that: the result is exact.

Rows are dealt into index shards of bounded size, queries into blocks; each
(shard, block) pair is searched in one task and yields k rows per query, which a
second step merges.  Equal codes are one entry with its k smallest ids, so a
very common vector costs a shard one candidate.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

BITS = 64  # of a code, at most 64
SEGMENTS = 4
SHARD_ROWS = 1 << 17
BLOCK_QUERIES = 1 << 14
TOP = 10


def codes(vectors: DataFrame, bits: int = BITS) -> DataFrame:
    """(id, code LONG): bit i is 1 where element i is above zero; NULL, NaN and
    missing elements give 0.  Rows without an id or a vector have no code and are
    left out.  A vector of more than ``bits`` elements raises: its code would leave
    out the rest of it."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            out = np.zeros(b.num_rows, np.uint64)
            for k in range(b.num_rows):
                v = np.array([x if x is not None else 0.0 for x in b.column(1)[k].as_py()], float)
                if v.size > bits:
                    raise ValueError(f"a vector of {v.size} elements does not fit a code of {bits} bits")
                on = np.flatnonzero(v > 0).astype(np.uint64)
                out[k] = np.bitwise_or.reduce(np.uint64(1) << on) if on.size else 0
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out.view(np.int64))], ["id", "code"])

    known = vectors.where("vec_id is not null and embedding is not null")
    return known.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding")).mapInArrow(run, "id long, code long")


class Index:
    """Codes of one shard by segment value."""

    def __init__(self, ids, values, bits: int = BITS, segments: int = SEGMENTS, keep: int = TOP + 1):
        import numpy as np

        order = np.lexsort((ids, values))
        ids, values = ids[order], values[order]
        self.codes, first = np.unique(values, return_index=True)
        ends = np.append(first[1:], values.size)
        # of equal codes only the `keep` smallest ids can be among the nearest
        self.ids = [ids[a : min(b, a + keep)] for a, b in zip(first, ends)]
        self.width = [bits // segments + (s < bits % segments) for s in range(segments)]
        self.shift = [sum(self.width[:s]) for s in range(segments)]
        self.lists = []
        for s in range(segments):
            v = self._part(self.codes, s)
            by = np.argsort(v, kind="stable")
            starts = np.searchsorted(v[by], np.arange((1 << self.width[s]) + 1, dtype=np.uint64))
            self.lists.append((by, starts))
        self.flips = [[self._flips(w, 0)] for w in self.width]

    def _part(self, code, s):
        import numpy as np

        return (code >> np.uint64(self.shift[s])) & np.uint64((1 << self.width[s]) - 1)

    @staticmethod
    def _flips(width: int, radius: int):
        import numpy as np

        return np.array([sum(1 << b for b in c) for c in combinations(range(width), radius)], np.uint64)

    def _probe(self, code, s: int, radius: int):
        """Entries whose segment ``s`` differs from the query's in ``radius`` bits."""
        import numpy as np

        if radius > self.width[s]:
            return np.empty(0, np.int64)
        while len(self.flips[s]) <= radius:
            self.flips[s].append(self._flips(self.width[s], len(self.flips[s])))
        by, starts = self.lists[s]
        v = (self._part(code, s) ^ self.flips[s][radius]).astype(np.int64)
        a, n = starts[v], starts[v + 1] - starts[v]
        a, n = a[n > 0], n[n > 0]
        ends = np.cumsum(n)
        return by[np.arange(ends[-1] if ends.size else 0) + np.repeat(a - ends + n, n)]

    def nearest(self, query_id: int, code, k: int = TOP):
        """[(distance, id)] of the k nearest other rows, nearest first, ties by id;
        and the radius the search grew to."""
        import numpy as np

        seen = np.zeros(self.codes.size, bool)
        found: list[tuple[int, int]] = []
        m = len(self.width)
        for radius in range(max(self.width) + 1):
            hits = np.concatenate([self._probe(code, s, radius) for s in range(m)])
            hits = np.unique(hits[~seen[hits]])
            seen[hits] = True
            d = np.bitwise_count(self.codes[hits] ^ code).astype(np.int64)
            if len(found) >= k:
                hits, d = hits[d <= found[k - 1][0]], d[d <= found[k - 1][0]]
            elif hits.size > 4 * k:  # nothing beyond the k-th smallest distance, self included, can count
                limit = np.partition(d, k)[k]
                hits, d = hits[d <= limit], d[d <= limit]
            for h, dist in zip(hits.tolist(), d.tolist()):
                found += [(dist, i) for i in self.ids[h].tolist() if i != query_id]
            found = sorted(found)[:k]
            if len(found) == k and found[-1][0] < m * (radius + 1):
                break
        return found, radius


def _search(bits, segments, k):
    def run(rows, queries):
        import numpy as np
        import pyarrow as pa

        out = []
        if rows.num_rows:
            get = lambda t, c: t.column(c).to_numpy()
            index = Index(get(rows, "id"), get(rows, "code").view(np.uint64), bits, segments, k + 1)
            for q, code in zip(get(queries, "id").tolist(), get(queries, "code").view(np.uint64)):
                out += [(q, i, d) for d, i in index.nearest(q, code, k)[0]]
        cols = zip(*out) if out else ([], [], [])
        return pa.table([pa.array(c, pa.int64()) for c in cols], names=["query_id", "neighbor_id", "distance"])

    return run


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = TOP,
    bits: int = BITS,
    segments: int = SEGMENTS,
    shard_rows: int = SHARD_ROWS,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """(query_id, rank, neighbor_id, distance): the k rows of ``vectors`` with the
    smallest Hamming distance to each query, the row with the query's own id left
    out, ties by id; fewer if there are fewer.

    Both tables have vec_id and embedding.  Rows with a NULL id or vector are left
    out; empty vectors have code zero; a vec_id that repeats with the same code
    counts once, one with several codes is a row for each of them; vectors wider than
    the code raise; no query or no row gives an empty result; other columns are
    ignored.
    """
    index = saved(codes(vectors, bits).distinct(), "codes")
    asked = saved(codes(queries, bits).distinct(), "query-codes")
    shards = max(1, -(-index.count() // shard_rows))
    blocks = max(1, -(-asked.count() // block_queries))
    deal = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    # an index shard meets every block of queries, a query every shard
    left = index.withColumn("shard", deal(shards)).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = asked.withColumn("block", deal(blocks)).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    near = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInArrow(
        _search(bits, segments, k), "query_id long, neighbor_id long, distance long"
    )
    best = Window.partitionBy("query_id").orderBy("distance", "neighbor_id")
    return (
        near.distinct()
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "neighbor_id", "distance")
    )


def oracle(k: int = TOP, bits: int = BITS, every: int = 50) -> str:
    """All distances in DuckDB SQL."""
    return f"""
      WITH c AS (SELECT DISTINCT vec_id, list_transform(range(1, {bits + 1}), lambda i: CASE WHEN embedding[i] > 0 AND NOT isnan(embedding[i]) THEN 1 ELSE 0 END) AS code
                 FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
      x AS (SELECT vec_id, unnest(range(1, {bits + 1})) AS i, unnest(code) AS b FROM c),
      d AS (SELECT q.vec_id AS query_id, n.vec_id AS neighbor_id, CAST(count(*) FILTER (WHERE q.b <> n.b) AS BIGINT) AS distance
            FROM x q JOIN x n ON q.i = n.i AND q.vec_id <> n.vec_id WHERE q.vec_id % {every} = 0 GROUP BY ALL)
      SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS INTEGER) AS rank, neighbor_id, distance
      FROM d QUALIFY rank <= {k}"""
