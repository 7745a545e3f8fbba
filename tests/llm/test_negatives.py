"""Hard negatives against brute force in Python integers."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import negatives


def brute(rows, every=5, positives=5, top=3, low=50, high=95, scale=256):
    """rows: (vec_id, vector, label).  Sorted result rows."""
    ready = set()
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        ready.add((i, label, tuple(math.floor(scale * float(np.float32(x))) for x in v)))
    ready = sorted(ready)
    out = []
    for a in ready:
        if a[0] % every:
            continue
        scored = [(-sum(x * y for x, y in zip(a[2], b[2])), b[0], b) for b in ready if b != a]
        scored.sort()
        near = [s for s in scored if s[2][1] == a[1]][:positives]
        for ps, pid, _ in near:
            far = [s for s in scored if s[2][1] != a[1] and low * -ps <= 100 * -s[0] <= high * -ps][:top]
            out += [(a[0], pid, k + 1, s[1], -ps, -s[0]) for k, s in enumerate(far)]
    return sorted(out)


def mined(spark, rows, every=5, **kw):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = negatives.mine(negatives.quantised(df), F.col("id") % every == 0, **kw)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, got.collect()))


def vectors(n, width, labels, seed, spread=1.0):
    r = random.Random(seed)
    centres = [[r.gauss(0, 1) for _ in range(width)] for _ in range(labels)]
    out = []
    for i in range(n):
        k = r.randrange(labels)
        out.append((i, [float(np.float32(spread * (0.7 * c + r.gauss(0, 0.8)))) for c in centres[k]], k if r.random() < 0.8 else r.randrange(labels)))
    return out


def test_primes_keep_products_exact():
    for bound in (1, 10**6, 1 << 62):
        p = negatives.primes(bound)
        assert len(set(p)) == len(p) and math.prod(p) > 2 * bound
        assert all(negatives.COLUMNS * (q // 2) ** 2 < 1 << 24 for q in p)
        assert all(q % d for q in p for d in range(2, q))


@pytest.mark.parametrize("width, size", [(3, 255), (64, 255), (200, 255), (70, 1 << 24), (1, (1 << 30) - 1)])
def test_scores_are_exact(width, size):
    r = np.random.default_rng(width)
    a, b = r.integers(-size, size + 1, (7, width)), r.integers(-size, size + 1, (11, width))
    want = [[sum(int(x) * int(y) for x, y in zip(u, v)) for v in b] for u in a]
    shard = negatives.Shard(b, width * size * size)
    assert shard.scores(a).tolist() == want


def test_best_breaks_ties_by_index():
    s = np.array([5, 9, 5, 9, 1, 5, -3])
    assert negatives.best(s, 4).tolist() == [1, 3, 0, 2]
    assert negatives.best(s, 99).tolist() == [1, 3, 0, 2, 5, 4, 6]
    assert negatives.best(s[:0], 3).size == 0


@pytest.mark.parametrize("width, labels", [(8, 3), (70, 2), (5, 40)])
def test_equals_brute_force(spark, width, labels):
    rows = vectors(160, width, labels, seed=width)
    assert mined(spark, rows) == brute(rows)


def test_many_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(negatives, "SHARD_ELEMENTS", 40)
    monkeypatch.setattr(negatives, "LEAST_ROWS", 7)
    rows = vectors(120, 6, 3, seed=1)
    assert mined(spark, rows) == brute(rows)


def test_ties_repeats_and_rows_that_take_no_part(spark):
    rows = vectors(60, 4, 2, seed=2)
    same = [(1000 + i, [0.5, 0.5, 0.5, 0.5], i % 2) for i in range(40)]  # one common vector
    again = rows[:10] + same[:5]  # repeated rows count once
    other = [(rows[10][0], rows[11][1], 1), (rows[10][0], rows[12][1], 0)]  # one id, several vectors
    bad = [
        (2000, None, 0), (2005, [0.1, None, 0.1, 0.1], 0), (2010, [0.1, float("nan"), 0.1, 0.1], 1),
        (2015, [float("inf"), 0.1, 0.1, 0.1], 1), (2020, [0.5, 0.5, 0.5, 0.5], None), (None, [0.5, 0.5, 0.5, 0.5], 1),
    ]
    short = [(3000, [0.9], 0), (3005, [], 1), (3010, [0.2, 0.1, 0.7, 0.3, 0.8, 0.9], 0)]
    everything = rows + same + again + other + bad + short
    got = mined(spark, everything)
    assert got == brute(everything)
    assert not {2000, 2005, 2010, 2015, 2020} & {r[0] for r in got}


def test_fewer_than_asked_for_and_none(spark):
    assert mined(spark, [(0, [1.0], 1), (1, [1.0], 1)]) == []  # no other label
    assert mined(spark, [(0, [1.0], 1), (1, [0.9], 2)]) == []  # no positive
    one = [(0, [1.0], 1), (1, [1.0], 1), (2, [0.7], 2)]
    assert mined(spark, one) == brute(one) == [(0, 1, 1, 2, 65536, 45824)]
    assert mined(spark, [(0, [1.0], 1), (1, [-1.0], 1), (2, [-0.7], 2)]) == []  # scores below zero
    assert mined(spark, []) == []


def test_extra_columns_and_other_parameters(spark):
    rows = vectors(80, 4, 3, seed=5)
    df = spark.createDataFrame([(*r, 7, 8, 9) for r in rows], "vec_id long, embedding array<float>, label int, id int, key int, shard int")
    got = negatives.mine(negatives.quantised(df, F.col("label") * 1), F.col("id") % 4 == 0, positives=2, negatives=6, low=10, high=100)
    assert sorted(map(tuple, got.collect())) == brute(rows, 4, 2, 6, 10, 100)


def test_large_components(spark):
    rows = [(i, [float(2**20 + 3 * i), float(-i)], i % 2) for i in range(30)]
    assert mined(spark, rows) == brute(rows)
    with pytest.raises(ValueError, match="64 bits"):
        mined(spark, [(0, [1e30], 1), (1, [1e30], 1)])


def test_every_pair_meets_once(spark):
    """Same-label candidates are spread over shards; none is lost or doubled."""
    rows = [(i, [1.0 + i / 100], 0) for i in range(50)] + [(100 + i, [0.4 + i / 100], 1) for i in range(30)]
    got = mined(spark, rows)
    per = defaultdict(set)
    for a, p, *_ in got:
        per[a].add(p)
    assert got == brute(rows) and all(len(v) <= 5 for v in per.values())
