"""The Merkle manifest against a plain tree in memory."""

import hashlib
import random
import zlib

import pytest

from ledgerline.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf_of(r, text):
    return H(*map(field, (r[0], r[1], r[2], r[3], text)))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i : i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def siblings(levels, i):
    out = []
    for nodes in levels[:-1]:
        k = i - i % 16
        out.append((nodes[k:i], nodes[i + 1 : k + 16]))
        i //= 16
    return out


def brute(rows):
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r, r[4])))
    trees = {s: tree([leaf_of(r, r[4]) for r in by[s]]) for s in names}
    top = tree([trees[s][-1][0] for s in names])
    root, out = top[-1][0] if rows else None, []
    for k, s in enumerate(names):
        for i, r in enumerate(by[s]):
            around = siblings(trees[s], i) + siblings(top, k)
            text = r[4]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and text is not None:
                text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
            node = leaf_of(r, text)
            for a, b in around:
                node = H(*a, node, *b)
            out.append((r[0], leaf_of(r, r[4]), trees[s][-1][0], root, H(*[x for a, b in around for x in a + b]), node, node == root))
    return sorted(out, key=str)


def verified(spark, rows, schema=SCHEMA):
    got = merkle.Manifest(spark.createDataFrame(rows, schema)).verify()
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, got.collect()), key=str)


def rows_of(sizes, seed=0):
    r, out, i = random.Random(seed), [], 0
    for k, n in enumerate(sizes):
        for _ in range(n):
            i += r.randrange(1, 4)
            out.append((i, f"src{k}", "en", 3, r.choice(["ABC", "abc", "Äé", "", None])))
    r.shuffle(out)
    return out


@pytest.mark.parametrize("sizes", [[1], [2], [16], [17], [1, 15, 16, 17, 33], [300], [1] * 20, [270, 3] + [2] * 16])
def test_equals_brute_force(spark, sizes):
    rows = rows_of(sizes)
    assert verified(spark, rows) == brute(rows)


def test_several_distributed_levels(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", 1)
    monkeypatch.setattr(merkle, "BLOCK", 16)
    rows = rows_of([1, 16, 17, 290, 2] + [1] * 30, seed=3)
    assert verified(spark, rows) == brute(rows)


def test_a_source_larger_than_a_block(spark):
    rows = [(i, "big", None, i, "Text" if i % 3 else None) for i in range(4096 + 20)] + [(-5, None, "x", None, "A")]
    assert verified(spark, rows) == brute(rows)


def test_nulls_ties_and_repeats(spark):
    rows = [
        (None, None, None, None, None), (None, "a", "en", 1, "A"), (None, "a", "en", 1, "B"), (7, "a", "en", 2, "x"),
        (7, "a", "en", 2, "x"), (7, "a", "de", 2, "X"), (7, None, "en", 2, "X"), (-3, "", "en", 0, ""), (9, "ü", "en", 1, "\U0001f600"),
        (10, "z", "en", 1, "A"),
    ] * 3
    assert verified(spark, rows) == brute(rows)


def test_empty_table_long_text_and_extra_columns(spark):
    assert verified(spark, []) == []
    rows = [(1, "a", "en", 10**7, "Ab " * 3_000_000), (15, "a", "en", 1, "A")]
    assert verified(spark, rows) == brute(rows)
    extra = [(*r, "v", 1, "g") for r in rows_of([5, 3])]
    names = SCHEMA + ", leaf string, pos int, g string"
    assert verified(spark, extra, names) == brute([r[:5] for r in extra])


def test_versions_share_what_they_do_not_copy():
    block = merkle.Block([H(str(i)) for i in range(300)], merkle.height(300))
    for i in (0, 17, 255, 299):
        copied = block.version(i, H("other"))
        assert sorted(copied) == [(k, i // 16**k) for k in range(4)]  # the leaf and its ancestors only
        changed = [H(str(j)) for j in range(300)]
        changed[i] = H("other")
        assert copied[3, 0] == tree(changed)[-1][0] != block.root
        assert merkle.fold(H("other"), block.path(i)) == copied[3, 0]
        assert block.version(i, H(str(i)))[3, 0] == block.root


def test_subroots_and_root(spark):
    rows = rows_of([20, 1, 40])
    m = merkle.Manifest(spark.createDataFrame(rows, SCHEMA))
    want = brute(rows)
    assert m.root.collect()[0].node == want[0][3]
    assert {r.node for r in m.subroots.collect()} == {w[2] for w in want}
