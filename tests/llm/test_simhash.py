"""SimHash near-duplicates against brute force."""

import random
import re

import numpy as np
import pytest
from xxhash import xxh64

from ledgerline.llm import simhash
from ledgerline.llm.components import components


def brute_fingerprint(text, words=3):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall("[^\x20\x09-\x0d]+", t)
    if not w:
        return 0
    sh = [" ".join(w[i : i + words]) for i in range(max(1, len(w) - words + 1))]
    hs = [xxh64(s.encode(), seed=42).intdigest() for s in sh]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


def brute_components(points, bits):
    parent = {p: p for p in points}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    pts = sorted(points)
    for i, x in enumerate(pts):
        for y in pts[:i]:
            if (x ^ y).bit_count() <= bits:
                a, b = find(x), find(y)
                parent[max(a, b)] = min(a, b)
    return {p: find(p) for p in pts}


TEXTS = [
    None, "", " \t\n", "One", "one TWO", "a b c", "A B C d", "é È x y z", "\x85 y z w",
    "lorem " * 500, "x y z " * 40000, "a b c", "ÀB cd ef gh",
]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint_equals_brute_force(text):
    assert simhash.fingerprint(text) == brute_fingerprint(text)


def clustered(rng, n):
    out = set()
    while len(out) < n:
        p = rng.getrandbits(64)
        out.add(p)
        for _ in range(rng.choice([0, 0, 0, 2, 6])):
            for _ in range(rng.randint(1, 4)):
                p ^= 1 << rng.randrange(64)
            out.add(p)
    return sorted(out)


@pytest.mark.parametrize("bits", [0, 1, 3, 6])
def test_tree_shards_keep_every_link(bits):
    rng = random.Random(bits)
    pts = np.array(clustered(rng, 3000), np.uint64)
    tree = simhash.build_tree(pts[rng.sample(range(pts.size), 400)], 12, bits)
    shards = [pts[i] for _, i in simhash.route(tree, pts, bits)]
    assert len(shards) > 2 and max(s.size for s in shards) < pts.size
    edges = []
    for s in shards:
        moved, roots = simhash.local_links(s, bits, block=16)
        edges += list(zip(s[moved].tolist(), s[roots].tolist()))
    want = brute_components(pts.tolist(), bits)
    parent = {p: p for p in pts.tolist()}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    assert {p: find(p) for p in parent} == want


def test_one_dense_group_is_settled_in_blocks():
    base = random.Random(1).getrandbits(64)
    pts = np.array(sorted({base ^ (1 << i) ^ (1 << j) for i in range(64) for j in range(64)}), np.uint64)
    moved, roots = simhash.local_links(pts, 3, block=64)
    assert moved.size == pts.size - 1 and set(roots.tolist()) == {0}


def test_components_match_brute_force(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(-200, 200), rng.randrange(-200, 200)) for _ in range(160)] + [(5, 5), (None, 1)]
    edges += [(i, i + 1) for i in range(1000, 1090)]  # a long chain
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    adj = {}
    for a, b in edges:
        if a is not None and a != b:
            adj.setdefault(a, set()).add(b)
            adj.setdefault(b, set()).add(a)
    want = {}
    for start in sorted(adj):
        if start in want:
            continue
        todo = [start]
        while todo:
            x = todo.pop()
            if x in want:
                continue
            want[x] = start
            todo += adj[x]
    assert got == {k: v for k, v in want.items() if k != v}


def near_copies(rng):
    rows = []
    for i in range(60):
        w = [rng.choice("abcdefghij") + str(rng.randrange(500)) for _ in range(rng.choice([1, 2, 5, 300]))]
        rows.append((len(rows), " ".join(w)))
        for _ in range(rng.randrange(4)):
            v = list(w)
            v[rng.randrange(len(v))] = "changed"
            rows.append((len(rows), " ".join(v)))
    return rows


def check(df, rows, words=3, bits=3):
    fps = [(i, brute_fingerprint(t, words)) for i, t in rows]
    comp = brute_components({f for _, f in fps}, bits)
    low = {}
    for i, f in fps:
        if i is not None:
            low[comp[f]] = min(low.get(comp[f], i), i)
    want = sorted(((i, f"{f:016x}", low.get(comp[f])) for i, f in fps), key=str)
    assert sorted((tuple(r) for r in df.collect()), key=str) == want


def test_near_duplicates_equal_brute_force(spark, docs_of):
    rng = random.Random(9)
    rows = near_copies(rng)
    rows += [(len(rows) + k, t) for k, t in enumerate(TEXTS)]
    rows += [rows[3], rows[3], (None, "orphan words here"), (None, rows[0][1])]
    docs = docs_of(rows)
    check(simhash.near_duplicates(docs, shard_points=16), rows)
    # columns named like the operator's own do not disturb it
    clash = docs.selectExpr("*", "1 as fp", "2 as component_id", "3 as fingerprint", "4 as shard")
    check(simhash.near_duplicates(clash, bits=10, shard_points=16), rows, bits=10)


def test_empty_table(docs_of):
    assert simhash.near_duplicates(docs_of([]).where("false")).collect() == []


def test_deduplicated_keeps_one_of_each_group(docs_of):
    rows = [(5, "a b c d"), (3, "a b c d"), (3, "a b c d"), (9, "quite another text here"), (None, "z"), (7, None), (8, "")]
    kept = simhash.deduplicated(docs_of(rows))
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [3, 7, 9, None]
    assert kept.columns == docs_of(rows).columns
