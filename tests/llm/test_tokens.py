"""Token ids, wavelet files and packing against the tokenizer itself."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerline.llm import packing, wavelet
from ledgerline.llm.tokens import Encoder, parts

ODD = [
    "", "a <|endoftext|> b", "naïve — “quotes” 漢字\u0085x", "  two  spaces \n\n x's 'S don't 12 3 \t ", "a b " * 700000,
    "é \x1c \x0b x", "x" * 40000, "'ll 're''ve\r\n\r\n  y", "Ω µ ª º × ÷ ǅ", " ", "\n", "1 2,3 $$$ ###a",
]


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda s: t.encode(s or "", add_special_tokens=False).ids


@pytest.mark.parametrize("known", [3, 1_000_000])
def test_encoder_equals_the_tokenizer(plain, known):
    e = Encoder(known=known)
    for _ in range(2):
        assert [x.tolist() for x in e.encode(ODD)] == [plain(s) for s in ODD]
    assert len(e.index) <= known
    assert e.encode([]) == []


def test_pieces_of_some_million_characters_are_looked_up_once(plain):
    e, merged = Encoder(known=1), []
    learn = e._learn
    e._learn = lambda pieces: (merged.append(len(pieces)), learn(pieces))
    texts = ["one two three " * 50000 + end for end in ("", "x9", "é")]
    assert [x.tolist() for x in e.encode(texts)] == [plain(s) for s in texts]
    # "one", " one", " two", " three", the last blank, " x", "9", " é"
    assert merged == [8] and len(e.index) == 1


def test_parts_are_the_text():
    for t in ODD:
        assert "".join(parts(t, 1000)) == t


@pytest.mark.parametrize("n", [0, 1, 63, 64, 1023, 1024, 5000])
def test_wavelet_queries_equal_the_array(n):
    rng = np.random.default_rng(n)
    ids = rng.choice([0, 1, 5, 7, 300, 70000], n).astype(np.uint32)
    data = wavelet.Shard.build(ids, [None, 4], [n, 0], (2, 9)).to_bytes()
    s = wavelet.Shard.from_bytes(data + b"\n")
    assert s.key == (2, 9) and s.doc_ids == [None, 4] and s.lengths == [n, 0]
    assert (s.ids() == ids).all()
    for i in rng.integers(0, n, min(n, 40)).tolist():
        assert s.access(i) == ids[i]
    for t in (0, 1, 2, 5, 300, 70000, 1 << 20):
        where = np.flatnonzero(ids == t)
        assert s.count(t) == where.size
        for i in (0, n // 2, n):
            assert s.rank(t, i) == (ids[:i] == t).sum()
        for k in range(0, where.size, max(1, where.size // 7)):
            assert s.select(t, k) == where[k]
        with pytest.raises(IndexError):
            s.select(t, where.size)
    with pytest.raises(IndexError):
        s.access(n)
    with pytest.raises(ValueError):
        wavelet.Shard.from_bytes(b"other")


def rows_of():
    rng = random.Random(4)
    rows = [(i * 3 % 101, " ".join(rng.choice(["the", "Être", "x9", "\n", "zz!"]) for _ in range(rng.randrange(60)))) for i in range(101)]
    return rows + [(500 + i, t) for i, t in enumerate(ODD)] + [(7, "tie b"), (7, "tie a"), (7, "tie a"), (900, None), (None, "no id")]


def test_wavelet_round_trip_equals_brute_force(spark, docs_of, plain):
    rows = rows_of()
    docs = docs_of(rows).selectExpr("*", "1 as part", "2 as seq", "3 as n_tokens", "4 as start")
    got = sorted((tuple(r) for r in wavelet.round_trip(docs, shard_tokens=2000).collect()), key=lambda r: r[1])
    start, want = 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array(plain(t) + [0], "<u4")
        want.append((i, start, ids.size, zlib.crc32(ids)))
        start += ids.size
    assert got == want


def test_wavelet_of_an_empty_table(docs_of):
    assert wavelet.round_trip(docs_of([]).where("false")).collect() == []


def test_capacity_tree_finds_the_tightest():
    rng = random.Random(2)
    tree, have = packing.CapacityTree(64), []
    for k in range(2000):
        if rng.random() < 0.5:
            c = rng.randint(1, 64)
            tree.put(c, k)
            have.append(c)
        else:
            need = rng.randint(1, 64)
            got = tree.tightest(need)
            best = min((c for c in have if c >= need), default=None)
            assert (got and got[0]) == best
            if got:
                have.remove(best)


def test_pack_covers_every_position_once_without_padding():
    rng = random.Random(1)
    for _ in range(300):
        lengths = [rng.choice([1, 2, 5, 100, 2047, 2048, 2049, 5000, rng.randint(1, 3000)]) for _ in range(rng.randint(0, 60))]
        cover = [np.zeros(n, int) for n in lengths]
        for seq in packing.pack(lengths):
            size = sum(p[2] for p in seq)
            assert 0 < size <= 2048 and (size == 2048 or size.bit_count() == 1)
            for i, at, n in seq:
                cover[i][at : at + n] += 1
        assert all((c == 1).all() for c in cover)


def test_packed_rows_hold_every_id_once(spark, docs_of, plain):
    rows = [r for r in rows_of() if r[0] != 7]
    docs = docs_of(rows).selectExpr("*", "1 as start", "2 as length", "3 as sequence_id")
    out = packing.packed(docs, window=256, group_tokens=3000, with_ids=True).collect()
    assert packing.packed(docs).columns == [f.split()[0] for f in packing.SCHEMA.split(", ")][:-1]
    by_doc, by_seq = {}, {}
    for r in out:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4")) and r.length == len(r.ids) > 0
    assert set(by_doc) == {i for i, _ in rows}
    for i, t in rows:
        pieces = sorted(by_doc[i], key=lambda r: r.start)
        ids = plain(t) + [1]
        assert [x for p in pieces for x in p.ids] == ids
        assert [p.start for p in pieces] == np.cumsum([0] + [p.length for p in pieces[:-1]]).tolist()
        assert {p.doc_tokens for p in pieces} == {len(ids)}
    for pieces in by_seq.values():
        pieces.sort(key=lambda r: r.offset)
        assert [p.offset for p in pieces] == np.cumsum([0] + [p.length for p in pieces[:-1]]).tolist()
        total = sum(p.length for p in pieces)
        assert total == 256 or (total < 256 and total.bit_count() == 1)


def test_packing_an_empty_table_and_repeated_rows(docs_of):
    assert packing.packed(docs_of([]).where("false")).collect() == []
    rows = packing.packed(docs_of([(1, "a b"), (1, "a b")])).collect()
    assert sum(r.length for r in rows) == 2 * rows[0].doc_tokens
