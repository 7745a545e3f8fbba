"""Pre-token cutting and byte-level BPE against the tiktoken library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import bpe, pieces

ALPHABET = "  \n\t'''stmdrevlabcXYZ019.,!?-  éßñ漢字२३՘\U000187f8\U0001f600\r\x1c\x85\0　"


@pytest.fixture(scope="module")
def plain():
    return tiktoken.Encoding(
        "plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(bpe.ranks_path()), special_tokens={}
    )


def coded(words, plain):
    return [i for w in words for i in plain.encode_ordinary(w.decode())]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from(ALPHABET) | st.characters(exclude_categories=["Cs"]), max_size=30), min_size=1, max_size=4))
def test_cut_is_the_pattern(plain, texts):
    found, inner, counts = pieces.cut(texts, pieces.unicode_classes())
    words = [w for w, i in zip(found.to_pylist(), inner) if i]
    assert sum(counts) == len(words)
    at = 0
    for t, n in zip(texts, counts):
        own = words[at : at + n]
        assert b"".join(own) == t.encode() and coded(own, plain) == plain.encode_ordinary(t)
        at += n


@pytest.mark.parametrize("window", [10, 64])
def test_long_texts_a_window_at_a_time(plain, window):
    r = random.Random(window)
    for _ in range(200):
        t = "".join(r.choices(ALPHABET, k=r.randrange(0, 200))) + r.choice(["", "a" * 90, " " * 90, "'" * 40 + "s"])
        words = [w for a in pieces.cut_long(t, pieces.unicode_classes(), window) for w in a.to_pylist()]
        assert b"".join(words) == t.encode() and coded(words, plain) == plain.encode_ordinary(t)


def test_the_pattern_is_the_public_one(monkeypatch):
    assert pieces.PATTERN == public_tokenizers.PATTERN
    monkeypatch.setattr(public_tokenizers, "PATTERN", r"\w+")
    with pytest.raises(ValueError, match="pattern"):
        bpe.ranks_path()


def brute(rows, plain):
    out = []
    for doc_id, text in rows:
        ids = plain.encode_ordinary(text or "")
        out.append(
            (
                doc_id,
                len(ids),
                hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                hashlib.sha256((text or "").encode()).hexdigest(),
            )
        )
    return sorted(out, key=str)


def tables(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def some_texts(n, seed=0):
    r = random.Random(seed)
    words = ["".join(r.choices("abcdefgh", k=r.randrange(1, 9))) for _ in range(50)] + list(ALPHABET)
    return [(i, " ".join(r.choices(words, k=r.randrange(0, 40)))) for i in range(n)]


@pytest.mark.parametrize("chunk_chars", [1, 500, bpe.CHUNK_CHARS])
def test_round_trip(spark, plain, chunk_chars):
    """One document a chunk, several, and all in one."""
    rows = some_texts(120)
    got = bpe.round_trip(tables(spark, rows), chunk_chars=chunk_chars)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, plain)


@pytest.mark.parametrize("buckets", [1, 7, 100_000])
def test_any_number_of_buckets(spark, plain, buckets):
    rows = some_texts(60, seed=9)
    got = bpe.digests(bpe.decode(bpe.encode(tables(spark, rows), chunk_chars=300, buckets=buckets))).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, plain)


def test_edges(spark, plain):
    rows = [(1, None), (2, ""), (None, "a b"), (None, None), (3, "x y"), (3, "x y"), (3, "other"), (4, "<|endoftext|>"), (5, " "), (6, "\0\0 \0")]
    assert sorted(map(tuple, bpe.round_trip(tables(spark, rows)).collect()), key=str) == brute(rows, plain)
    assert bpe.round_trip(tables(spark, [])).collect() == []
    assert sorted(map(tuple, bpe.round_trip(tables(spark, [(1, None), (2, "")])).collect()), key=str) == brute([(1, None), (2, "")], plain)
    extra = spark.createDataFrame([(1, "a b", 2, 3, "w")], "doc_id long, text string, chunk int, k int, word string")
    assert sorted(map(tuple, bpe.round_trip(extra).collect()), key=str) == brute([(1, "a b")], plain)


def test_very_long_texts(spark, plain):
    rows = [(1, "word " * 900_000), (2, "ab漢 1'll\n\n" * 300_000), (3, "short")]
    assert sorted(map(tuple, bpe.round_trip(tables(spark, rows)).collect()), key=str) == brute(rows, plain)


def test_a_word_crosses_once_a_chunk_and_is_encoded_once(spark, monkeypatch):
    cut = bpe.chunks(tables(spark, [(i, "the same words again and again") for i in range(500)]), chunk_chars=1 << 20)
    for r in cut.collect():
        words = bpe.words_of(bytes(r.data))
        assert words[0] == b" again"  # the most frequent first
        assert sorted(words) == sorted([b"the", b" same", b" words", b" again", b" and"])
    calls = []

    class Counting:
        def encode_ordinary(self, w):
            calls.append(w)
            return [len(w)]

    monkeypatch.setattr(tiktoken, "Encoding", lambda *a, **k: Counting())
    monkeypatch.setattr(bpe, "_cached", lambda name, path, make: make({}))
    import pyarrow as pa

    block, other = bpe._packed(bpe._bytes([b"x", b"yy"])), bpe._packed(bpe._bytes([b"z"]))
    batch = pa.RecordBatch.from_pydict({"chunk": [1, 2, 2], "bucket": [0, 0, 1], "data": [block, block, other]})
    out = [r for b in bpe._encode_batches(bpe.ranks_path())(iter([batch])) for r in b.to_pylist()]
    assert calls == ["x", "yy", "z"] and [bpe._unpacked(r["data"])[1].tolist() for r in out] == [[1, 2], [1, 2], [1]]


def test_ids_are_little_endian_and_decode(spark, plain):
    rows = some_texts(20, seed=4)
    coded_rows = bpe.encode(tables(spark, rows))
    ids = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in coded_rows.collect()}
    assert ids == {i: plain.encode_ordinary(t) for i, t in rows}
    assert {r.doc_id: bytes(r.bytes).decode() for r in bpe.decode(coded_rows).collect()} == dict(rows)


def test_decode_refuses_foreign_ids(spark):
    df = spark.createDataFrame([(1, bytearray(np.array([50256], "<u4").tobytes()))], "doc_id long, ids binary")
    with pytest.raises(Exception, match="outside the vocabulary"):
        bpe.decode(df).collect()
    empty = spark.createDataFrame([(1, None), (2, bytearray(b""))], "doc_id long, ids binary")
    assert [bytes(r.bytes) for r in bpe.decode(empty).collect()] == [b"", b""]
