"""Exact top-k against brute force."""

import random

import numpy as np
import pytest

from ledgerline.llm import hamming


def brute(codes, queries, k):
    out = []
    for q, c in queries:
        near = sorted((int(c ^ x).bit_count(), i) for i, x in set(codes) if i != q)[:k]
        out += [(q, r + 1, i, d) for r, (d, i) in enumerate(near)]
    return sorted(out)


@pytest.mark.parametrize("segments,bits", [(4, 64), (8, 64), (5, 24), (1, 8)])
def test_index_is_exact(segments, bits):
    rng = random.Random(bits + segments)
    values = [rng.getrandbits(bits) for _ in range(300)]
    values += [values[0]] * 40 + [values[1] ^ (1 << rng.randrange(bits)) for _ in range(30)]
    ids = np.arange(len(values))
    index = hamming.Index(ids, np.array(values, np.uint64), bits, segments, 8)
    codes = list(zip(ids.tolist(), values))
    for q in [*range(0, 370, 23)]:
        got, radius = index.nearest(q, np.uint64(values[q]), 7)
        assert [(q, r + 1, i, d) for r, (d, i) in enumerate(got)] == brute(codes, [codes[q]], 7)
    # the hot code is settled without growing the radius
    assert index.nearest(0, np.uint64(values[0]), 7)[1] == 0


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_top_k_over_shards_and_blocks(spark):
    rng = np.random.default_rng(2)
    v = rng.normal(size=(400, 64))
    v[50:90] = v[3]
    rows = [(i, [float(x) for x in row], 0) for i, row in enumerate(v)]
    rows += [rows[7], rows[7], (400, [], 0), (401, [None] * 64, 0), (402, [float("nan"), 1.0], 0), (None, [1.0], 0), (405, None, 0)]
    df = table(spark, rows).selectExpr("*", "1 as id", "2 as code", "3 as shard")
    got = hamming.top_k(df, df.where("vec_id % 50 = 0"), 5, shard_rows=100, block_queries=4)
    code = lambda e: sum(1 << i for i, x in enumerate((e or [])[:64]) if x is not None and x > 0)
    codes = [(i, code(e)) for i, e, _ in rows if i is not None and e is not None]
    assert sorted(tuple(r) for r in got.collect()) == brute(codes, sorted({c for c in codes if c[0] % 50 == 0}), 5)


def test_small_tables(spark):
    none = table(spark, []).where("false")
    one = table(spark, [(0, [1.0], 0), (1, [1.0], 0)])
    assert hamming.top_k(none, none).collect() == [] == hamming.top_k(one, none).collect() == hamming.top_k(none, one).collect()
    assert [tuple(r) for r in hamming.top_k(one, one.where("vec_id = 0")).collect()] == [(0, 1, 1, 0)]


def test_a_vector_wider_than_the_code_raises(spark):
    """Two vectors that differ beyond the code's bits must not come back as equal."""
    wide = table(spark, [(0, [1.0] * 128, 0), (1, [1.0] * 64 + [-1.0] * 64, 0)])
    with pytest.raises(Exception, match="does not fit a code of 64 bits"):
        hamming.top_k(wide, wide).collect()


def test_one_id_with_two_codes(spark):
    df = table(spark, [(0, [1.0], 0), (1, [1.0], 0), (1, [-1.0], 0)])
    assert sorted(tuple(r) for r in hamming.top_k(df, df.where("vec_id = 0")).collect()) == [(0, 1, 1, 0), (0, 2, 1, 1)]
