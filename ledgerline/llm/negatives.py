"""Hard negatives by exact integer inner products in a residue number system.

Vectors of integers are multiplied as float32 matrices of their residues modulo
several small primes.  The primes are so small that every sum of a block of
columns stays below 2^24, where float32 holds integers exactly; as many are taken
as make their product exceed twice the largest possible score.  Chinese
remaindering then gives the signed scores exactly, whatever BLAS adds up first.

1. Positives: rows are dealt by label, so that an anchor meets only rows that may
   have its label; each pair of a shard of rows and a block of anchors is one
   task, which yields at most `positives` rows per anchor.  A window merges them.
2. Negatives: the anchors, now with the windows of scores their positives allow,
   meet all shards; a task yields at most `negatives` rows per positive.

A label, vector or id that a third of all rows share is spread over shards like
any other; a task holds one shard and one block, both bounded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

SCALE = 256
POSITIVES, NEGATIVES = 5, 3  # per anchor; per anchor and positive
LOW, HIGH = 50, 95  # per cent of the positive's score that a negative may have
COLUMNS = 64  # of a matrix product that must be exact in float32
LARGEST_PRIME = 1021  # 64 * 510^2 < 2^24
SHARD_ELEMENTS = 1 << 22  # vector components of a shard of rows, and of a block of anchors
LEAST_ROWS = 1024  # of a shard, where there are more cores than shards
LABEL_BUCKETS = 64
SCORE_LIMIT = float(1 << 62)


# ------------------------------------------------------------ residue numbers ---


def primes(bound: int) -> list[int]:
    """Primes from LARGEST_PRIME down whose product exceeds ``2 * bound + 1``."""
    out, product, p = [], 1, LARGEST_PRIME
    while product <= 2 * bound + 1:
        if all(p % q for q in range(3, int(p**0.5) + 1, 2)):
            out.append(p)
            product *= p
        p -= 2
    return out


def residues(matrix, p: int):
    """Residues in -(p-1)/2 .. (p-1)/2, as float32."""
    import numpy as np

    half = (p - 1) // 2
    return ((matrix + half) % p - half).astype(np.float32)


def multiply(a, b, p: int):
    """``a @ b.T`` modulo ``p`` (0 .. p-1) of residue matrices, COLUMNS columns at a time."""
    import numpy as np

    total = np.zeros((a.shape[0], b.shape[0]), np.int32)
    for at in range(0, a.shape[1], COLUMNS):
        total = (total + (a[:, at : at + COLUMNS] @ b[:, at : at + COLUMNS].T).astype(np.int32)) % p
    return total


def combine(parts, moduli):
    """Signed integers below half the product of ``moduli`` from their residues.

    Mixed radix digits, each taken nearest to zero, give the signed number without
    a final subtraction; all but the last partial sum fit 64 bits, and so does the
    result."""
    import numpy as np

    p = moduli[0]
    value = parts[0].astype(np.int64)
    value[value > p // 2] -= p
    product = p
    for part, p in zip(parts[1:], moduli[1:]):
        digit = (part - value) % p * pow(product, -1, p) % p
        digit[digit > p // 2] -= p
        value = value + digit * np.int64(product)
        product *= p
    return value


class Shard:
    """Rows of one shard, ready to be multiplied; ``bound`` on the size of any score."""

    def __init__(self, matrix, bound: int):
        self.moduli = primes(bound)
        self.parts = [residues(matrix, p) for p in self.moduli]

    def scores(self, anchors):
        """Exact inner products (anchors x rows) of an integer matrix of anchors."""
        return combine([multiply(residues(anchors, p), part, p) for part, p in zip(self.parts, self.moduli)], self.moduli)


def best(scores, k: int):
    """Indices of the k largest scores, largest first, ties by index."""
    import numpy as np

    idx = np.arange(scores.size)
    if scores.size > k:
        kth = np.partition(scores, scores.size - k)[scores.size - k]
        above = np.flatnonzero(scores > kth)
        idx = np.concatenate([above, np.flatnonzero(scores == kth)[: k - above.size]])
    return idx[np.lexsort((idx, -scores[idx]))]


# ------------------------------------------------------------------- in tasks ---


def _matrix(lists, width: int):
    """An integer matrix from an Arrow list column; short vectors end in zeros."""
    import numpy as np

    lists = lists.combine_chunks() if hasattr(lists, "combine_chunks") else lists
    sizes = np.asarray(lists.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    out = np.zeros((len(lists), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


_HITS = "anchor_id long, anchor_key long, window int, other_id long, other_key long, score long"


def _search(pick, bound: int, width: int):
    """Cogrouped (rows, anchors) of one pair of shard and block -> hits.

    ``pick(anchor, scores, same)`` yields (window, indices) for one anchor, where
    ``same`` tells the rows of its label."""

    def run(rows, anchors):
        import numpy as np
        import pyarrow as pa

        out = [[] for _ in range(6)]
        if rows.num_rows and anchors.num_rows:
            rows = rows.sort_by([("id", "ascending"), ("key", "ascending")])  # ties go to the smaller id
            ids, keys, labels = (rows.column(c).to_numpy() for c in ("id", "key", "label"))
            shard = Shard(_matrix(rows.column("vector"), width), bound)
            asked = anchors.drop_columns(["vector"]).to_pylist()
            matrix = _matrix(anchors.column("vector"), width)
            step = max(1, SHARD_ELEMENTS // rows.num_rows)
            for at in range(0, len(asked), step):
                scores = shard.scores(matrix[at : at + step])
                for anchor, own in zip(asked[at : at + step], scores):
                    self_ = (ids == anchor["id"]) & (keys == anchor["key"])
                    for window, idx in pick(anchor, own, labels == anchor["label"], self_):
                        n = idx.size
                        for column, part in zip(
                            out,
                            (np.full(n, anchor["id"]), np.full(n, anchor["key"]), np.full(n, window), ids[idx], keys[idx], own[idx]),
                        ):
                            column.append(part)
        names = [f.split()[0] for f in _HITS.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        flat = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in out]
        return pa.table([pa.array(c, k) for c, k in zip(flat, kinds)], names=names)

    return run


def _positive_rows(k):
    def pick(anchor, scores, same, self_):
        import numpy as np

        idx = np.flatnonzero(same & ~self_)
        yield 0, idx[best(scores[idx], k)]

    return pick


def _negative_rows(k, low, high):
    def pick(anchor, scores, same, self_):
        import numpy as np

        other = np.flatnonzero(~same)
        theirs = scores[other]
        for window, score in enumerate(anchor["scores"]):
            first, last = -(-low * score // 100), high * score // 100
            idx = other[(theirs >= first) & (theirs <= last)] if first <= last else other[:0]
            yield window, idx[best(scores[idx], k)]

    return pick


# --------------------------------------------------------------------- plans ---


def quantised(vectors: DataFrame, label: Column | str = "label", scale: int = SCALE) -> DataFrame:
    """(id, key, label, vector): each component x as floor(scale * x), x as double.

    Rows without an id, a label or a vector, and those with a NULL, NaN or infinite
    component are left out; rows equal in id, label and vector are one.  ``key``
    tells rows of one id apart."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    known = vectors.select(F.col("vec_id").cast("long").alias("id"), F.col(label) if isinstance(label, str) else label.alias("label"), "embedding")
    known = known.toDF("id", "label", "embedding").where("id is not null and label is not null and embedding is not null").where(finite)
    whole = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("double"))
    rows = known.select("id", F.col("label").cast("long").alias("label"), whole.alias("vector"))
    return rows.distinct().withColumn("key", F.xxhash64("label", "vector"))


def _pairs(rows: DataFrame, anchors: DataFrame, bucket: Column, width: int, run) -> DataFrame:
    """Every shard of a bucket's rows with every block of its anchors, one task a pair."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    size = {r.bucket: r["count"] for r in rows.groupBy(bucket.alias("bucket")).count().collect()}  # at most LABEL_BUCKETS rows
    asked = {r.bucket: r["count"] for r in anchors.groupBy(bucket.alias("bucket")).count().collect()}
    most = max(1, SHARD_ELEMENTS // max(1, width))
    least = max(1, cores // max(1, len(size)))
    shards = [max(-(-size.get(b, 0) // most), min(least, -(-size.get(b, 0) // LEAST_ROWS))) for b in range(LABEL_BUCKETS)]
    blocks = [-(-asked.get(b, 0) // most) for b in range(LABEL_BUCKETS)]

    def of(numbers):
        return F.element_at(F.array(*map(F.lit, numbers)), F.col("bucket") + 1)

    def dealt(df, own, own_n, other, other_n):
        df = df.withColumn("bucket", bucket).withColumns({"own": of(own_n), "all": of(other_n)}).where("own > 0 and all > 0")
        place = F.pmod(F.xxhash64("id", "key", F.lit("deal")), F.col("own").cast("long")).cast("int")
        return df.withColumn(own, place).withColumn(other, F.explode(F.sequence(F.lit(0), F.col("all") - 1))).drop("own", "all")

    left = dealt(rows, "shard", shards, "block", blocks).groupBy("bucket", "shard", "block")
    right = dealt(anchors, "block", blocks, "shard", shards).groupBy("bucket", "shard", "block")
    return left.cogroup(right).applyInArrow(run, _HITS)


def mine(
    rows: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows`` as ``quantised`` gives them; ``anchors`` tells which of them are anchors.
    A score is the inner product; vectors of unequal width count as if the
    shorter one ended in zeros.  Positives are an anchor's first rows of the same
    label, itself left out; negatives of one are the first rows of other labels with
    ``low`` to ``high`` per cent of its score.  Higher scores come first, ties by id.
    A positive without a negative, and one with a score below zero, has no row.  No
    anchor or no row gives an empty result.

    Raises ValueError if a score might not fit 64 bits.
    """
    rows = saved(rows, "vectors")
    square = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    size, width = rows.agg(F.max(square), F.max(F.size("vector"))).first()  # Cauchy-Schwarz: no score exceeds `size`
    if size is not None and size >= SCORE_LIMIT:
        raise ValueError(f"inner products of up to {size:.3g} do not fit 64 bits")
    bound, width = int(size or 0) + 1, int(width or 0)
    if bound > 1 << 53:  # the sum above was rounded
        bound += bound >> 20
    whole = F.transform("vector", lambda x: x.cast("long"))
    rows = rows.withColumn("vector", whole)
    anchors = rows.where(anchors).select(*[F.col(c).alias(c) for c in rows.columns])  # columns of its own

    by_label = F.pmod(F.xxhash64("label"), F.lit(LABEL_BUCKETS)).cast("int")
    near = _pairs(rows, anchors, by_label, width, _search(_positive_rows(positives), bound, width))
    first = Window.partitionBy("anchor_id", "anchor_key").orderBy(F.desc("score"), "other_id", "other_key")
    near = near.withColumn("place", F.row_number().over(first)).where(F.col("place") <= positives)
    near = saved(near.withColumn("place", F.col("place") - 1), "positives")

    scores = F.transform(F.array_sort(F.collect_list(F.struct("place", "score"))), lambda x: x["score"])
    lists = near.groupBy(F.col("anchor_id").alias("id"), F.col("anchor_key").alias("key")).agg(scores.alias("scores"))  # short ones
    ready = anchors.join(lists, ["id", "key"]).select("id", "key", "label", "vector", "scores")
    far = _pairs(rows, ready, F.lit(0), width, _search(_negative_rows(negatives, low, high), bound, width))
    best_ = Window.partitionBy("anchor_id", "anchor_key", "window").orderBy(F.desc("score"), "other_id", "other_key")
    far = far.withColumn("rank", F.row_number().over(best_)).where(F.col("rank") <= negatives)
    far = far.select("anchor_id", "anchor_key", F.col("window").alias("place"), "rank", F.col("other_id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = near.select("anchor_id", "anchor_key", "place", F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return far.join(named, ["anchor_id", "anchor_key", "place"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def oracle(every: int = 50) -> str:
    """All scores in DuckDB SQL (sums of these whole numbers are exact in DOUBLE)."""
    return f"""
      WITH v AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                        list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS e
                 FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                  AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
      s AS (SELECT a.vec_id AS anchor_id, a.label = n.label AS same, n.vec_id, CAST(list_dot_product(a.e, n.e) AS BIGINT) AS score
            FROM v a JOIN v n ON a.vec_id <> n.vec_id WHERE a.vec_id % {every} = 0),
      p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES})
      SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
             s.vec_id AS negative_id, positive_score, s.score AS negative_score
      FROM p JOIN s USING (anchor_id)
      WHERE NOT s.same AND {LOW} * positive_score <= 100 * s.score AND 100 * s.score <= {HIGH} * positive_score
      QUALIFY rank <= {NEGATIVES}"""
