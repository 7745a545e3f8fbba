"""SimHash near-duplicates with a distributed vantage-point tree.

1. Each text becomes a 64-bit fingerprint (majority of its shingles' hash bits).
2. Equal fingerprints collapse to one point, so a group of copies of any size
   is one row from here on.
3. A vantage-point tree is built over a bounded sample of the points: an inner
   node holds a vantage point ``v`` and a radius ``mu``.  Every point is dealt
   through it.  By the triangle inequality, two points within ``bits`` of each
   other are either both beyond ``mu``, or both within ``mu + bits`` of ``v``;
   so the outside branch gets distance > mu, the inside branch distance <=
   mu + bits.  Points in the overlap go to both, everything else is pruned, and
   every linked pair shares at least one shard.  The sample only shapes the
   tree: it cannot change a result.
4. Each shard goes on splitting its points by the same rule until a block is
   small, then verifies exact Hamming distances in that block.  A shard emits a
   forest (one link per point to its local root), never all pairs of a group.
5. Components over the links; members get the smallest doc_id of theirs.

Skew: copies are collapsed before any shuffle by value; near-copies share a
shard, whose size the tree bounds except for points that no split can separate
(all within ``bits`` of one another), which are settled in blocks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, unused
from .components import components

SHINGLE_WORDS = 3
MAX_BITS = 3
SHARD_POINTS = 8192  # points a shard aims at
SAMPLE_PER_SHARD = 64  # sampled points per shard of the tree
MAX_SAMPLE = 1 << 20  # 8 MB of fingerprints: the most the driver ever sees
BLOCK = 256  # below this many points, all distances of a block are computed


# ------------------------------------------------------------ fingerprints ---


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash (unsigned) of one text; no words: zero.

    Words are the runs without ASCII white space, A-Z lower-cased; a text of
    fewer than ``words`` words is one shingle.  A bit is 1 if set in more than
    half of the shingles' XXH64 values (seed 42), repeats counted.
    """
    import numpy as np
    from itertools import islice, repeat
    from xxhash import xxh64_intdigest

    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return 0
    n = max(1, len(w) - words + 1)
    shingles = map(b" ".join, zip(*(w[i:] for i in range(words)))) if len(w) >= words else iter([b" ".join(w)])
    hashes = map(xxh64_intdigest, shingles, repeat(42))
    ones = np.zeros(64, np.int64)
    while (part := np.fromiter(islice(hashes, 1 << 16), np.uint64)).size:
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def _fingerprint_batches(words):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            fps = np.fromiter((fingerprint(t, words) for t in b.column(1).to_pylist()), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return run


def _keyed_batches(words):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            fps = np.fromiter((fingerprint(t, words) for t in b.column("text").to_pylist()), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("hash"), pa.array(fps.view(np.int64))], ["doc_id", "hash", "fp"])

    return run


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp LONG: the 64 bits, signed) for every row of ``docs``."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _fingerprint_batches(words), "doc_id long, fp long"
    )


# -------------------------------------------------------- vantage-point tree ---


def _distances(points, vantage):
    import numpy as np

    return np.bitwise_count(points ^ vantage)


def _split(points, rng):
    """(vantage, mu) whose distances spread most among a few candidates; None if
    every candidate is equally far from all points."""
    import numpy as np

    probe = points if points.size <= 512 else points[rng.integers(0, points.size, 512)]
    best = None
    for v in points[rng.integers(0, points.size, 6)]:
        d = _distances(probe, v)
        spread = float(d.std())
        if best is None or spread > best[0]:
            best = (spread, v, int(np.median(d)))
    spread, v, mu = best
    return (v, mu) if spread > 0 else None


def build_tree(sample, shards: int, bits: int = MAX_BITS, seed: int = 7):
    """Nested tuples (vantage, mu, inside, outside); a leaf is its shard number.

    ``sample``: uint64 array.  About ``shards`` leaves; fewer if the sample has
    too few points to go on.
    """
    import numpy as np

    rng = np.random.default_rng(seed)
    leaves = 0

    def grow(points, left):
        nonlocal leaves
        cut = _split(points, rng) if left > 1 and points.size >= 8 else None
        if cut:
            d = _distances(points, cut[0])
            near, far = points[d <= cut[1] + bits], points[d > cut[1]]
            if max(near.size, far.size) < 0.95 * points.size:
                half = left // 2
                return (int(cut[0]), cut[1], grow(near, left - half), grow(far, half))
        leaves += 1
        return leaves - 1

    return grow(np.asarray(sample, np.uint64), shards)


def route(tree, points, bits: int = MAX_BITS):
    """Yield (shard, indices into ``points``) for every shard a point belongs to."""
    import numpy as np

    def walk(node, idx):
        if not idx.size:
            return
        if isinstance(node, int):
            yield node, idx
            return
        v, mu, inside, outside = node
        d = _distances(points[idx], np.uint64(v))
        yield from walk(inside, idx[d <= mu + bits])
        yield from walk(outside, idx[d > mu])

    yield from walk(tree, np.arange(points.size))


def local_links(points, bits: int = MAX_BITS, block: int = BLOCK):
    """Forest over distinct ``points``: arrays (i, root) for each point i that is
    linked to another, root being the first index of its local component.

    Splits by vantage points while that separates anything, then compares all
    pairs of a block, ``block`` rows at a time.
    """
    import numpy as np

    parent = np.arange(points.size)

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def union(a, b):
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)

    rng = np.random.default_rng(11)
    stack = [np.arange(points.size)]
    while stack:
        idx = stack.pop()
        if idx.size < 2:
            continue
        if idx.size > block and (cut := _split(points[idx], rng)):
            d = _distances(points[idx], cut[0])
            near, far = idx[d <= cut[1] + bits], idx[d > cut[1]]
            if max(near.size, far.size) < 0.9 * idx.size:
                stack += [near, far]
                continue
        own = points[idx]
        for k in range(0, idx.size, block):
            part = own[k : k + block]
            for at in range(k, idx.size, 16 * block):
                hit = np.bitwise_count(part[:, None] ^ own[None, at : at + 16 * block]) <= bits
                a, b = np.nonzero(hit)
                a, b = a + k, b + at
                a, b = idx[a[a < b]], idx[b[a < b]]
                while a.size:  # link each point to one partner, then drop the pairs that settles
                    first = np.unique(a, return_index=True)[1]
                    for x, y in zip(a[first].tolist(), b[first].tolist()):
                        union(x, y)
                    roots = _roots(parent)
                    a, b = a[roots[a] != roots[b]], b[roots[a] != roots[b]]
    roots = _roots(parent)
    moved = np.nonzero(roots != np.arange(points.size))[0]
    return moved, roots[moved]


def _roots(parent):
    import numpy as np

    up = parent
    while not np.array_equal(up[up], up):
        up = up[up]
    return up


def _route_batches(tree, bits):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            points = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for shard, idx in route(tree, points, bits):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(idx.size, shard, np.int64)), pa.array(points[idx].view(np.int64))],
                    ["shard", "fp"],
                )

    return run


def _link_shard(bits):
    def run(table):
        import numpy as np
        import pyarrow as pa

        points = np.unique(table.column("fp").to_numpy().view(np.uint64))
        moved, roots = local_links(points, bits)
        return pa.table(
            {"a": pa.array(points[moved].view(np.int64)), "b": pa.array(points[roots].view(np.int64))}
        )

    return run


def links(points: DataFrame, bits: int = MAX_BITS, shard_points: int = SHARD_POINTS) -> DataFrame:
    """Distinct fingerprints (fp) -> links (a, b) that connect exactly the points
    reachable through steps of at most ``bits`` differing bits."""
    import numpy as np

    n = points.count()
    shards = max(1, -(-n // shard_points))
    want = min(MAX_SAMPLE, SAMPLE_PER_SHARD * shards, n)
    sample = []
    if shards > 1:
        # at most `want` rows reach the driver, whatever the draw
        rows = points.sample(min(1.0, want / n), seed=5).limit(want).collect()
        sample = [r.fp for r in rows]
    tree = build_tree(np.array(sample, np.int64).view(np.uint64), shards, bits) if sample else 0
    dealt = points.mapInArrow(_route_batches(tree, bits), "shard long, fp long")
    return dealt.groupBy("shard").applyInArrow(_link_shard(bits), "a long, b long")


def _placed(fps: DataFrame, bits: int, shard_points: int) -> DataFrame:
    """(fp, low, root): every distinct fingerprint of ``fps`` (doc_id, fp ...), the
    smallest doc_id that has it, and the fingerprint its component is known by."""
    members = saved(fps.groupBy("fp").agg(F.min("doc_id").alias("low")), "points")
    roots = components(links(members.select("fp"), bits, shard_points))
    return members.join(roots, members.fp == roots.node, "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))


def near_duplicates(
    docs: DataFrame, words: int = SHINGLE_WORDS, bits: int = MAX_BITS, shard_points: int = SHARD_POINTS
) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per row of ``docs``.

    component_id is the smallest doc_id reachable through fingerprints that
    differ in at most ``bits`` bits, the document itself included.  NULL, empty
    and white-space texts have fingerprint zero and are linked like any other;
    repeated rows stay repeated; a NULL doc_id row keeps its fingerprint and
    joins its component, whose id ignores NULLs; an empty table gives an empty
    result; other columns are ignored.
    """
    fps = saved(fingerprints(docs, words), "fingerprints")
    placed = _placed(fps, bits, shard_points)
    lows = placed.groupBy("root").agg(F.min("low").alias("component_id"))
    named = placed.join(lows, "root").select("fp", "component_id")
    return fps.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def deduplicated(docs: DataFrame, words: int = SHINGLE_WORDS, bits: int = MAX_BITS) -> DataFrame:
    """Rows of ``docs`` that stay: of each component the one with the smallest
    doc_id, and of several such rows the one whose text has the smallest hash.

    A doc_id that stands for several texts keeps one row in each of their components.
    Rows without a doc_id cannot be named by a component and pass through unchanged.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    keyed = own.withColumn("hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    fps = saved(
        keyed.mapInArrow(_keyed_batches(words), "doc_id long, hash long, fp long"), "fingerprints"
    )
    placed = _placed(fps, bits, SHARD_POINTS).select(F.col("fp").alias("_fp"), "root")
    first = fps.groupBy("fp").agg(F.min(F.struct("doc_id", "hash")).alias("one"))
    first = first.join(placed, F.col("fp") == F.col("_fp")).groupBy("root").agg(F.min("one").alias("one"))
    number, mark = unused(docs, "_number"), unused(docs, "_mark")
    keep = first.select(F.col("one.doc_id").alias(number), F.col("one.hash").alias(mark)).distinct()
    rows = docs.withColumns({number: F.col("doc_id").cast("long"), mark: F.xxhash64(F.coalesce("text", F.lit("")))})
    named = rows.join(keep, [number, mark], "left_semi").dropDuplicates([number, mark])
    return named.select(*[F.col(f"`{c}`") for c in docs.columns]).unionByName(docs.where("doc_id is null"))
