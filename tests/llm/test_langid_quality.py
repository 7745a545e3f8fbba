"""Language identification and the quality classifier: held-out accuracy, EM on
known labellers, edge cases."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import langid, quality, textfeatures

from ..conftest import SF_CHECK

EDGES = [(1, None), (2, ""), (3, " \n 12 !!"), (4, "a"), (5, "The and of it. " * 30000), (None, "the of and"), (6, "퟿ 漢字"), (6, "퟿ 漢字")]


def test_ngram_counts_equal_brute_force():
    rng = random.Random(1)
    text = "".join(rng.choice("abc é漢") for _ in range(5000))
    c = textfeatures.code_points(text)
    whole = textfeatures.ngram_counts(c)
    assert (textfeatures.ngram_counts(c, chunk=7) == whole).all()
    assert whole.sum() == 3 * c.size - 3
    assert "".join(map(chr, textfeatures.letters_only(textfeatures.code_points("A-bÉ  9Ç.")))) == " a bé ç "


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    got = langid.identify(docs)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    r = got.join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    row = r.agg(F.count("*").alias("n"), F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("acc"), F.min("score").alias("lo"), F.max("score").alias("hi")).first()
    assert row.n > 150 and row.acc > 0.99 and 0 <= row.lo <= row.hi <= 1
    assert got.where("held_out").count() == docs.where("crc32(cast(cast(doc_id as string) as binary)) % 4 = 2").count()


def test_prediction_ignores_lang_source_and_id(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    model = langid.fit(docs)
    a = docs.where("doc_id < 100")
    b = a.select((F.col("doc_id") + 5000).alias("doc_id"), "text", F.lit("xx").alias("lang"), F.lit(None).cast("string").alias("source"))
    f = lambda df, off: sorted((r.doc_id - off, r.lang_pred, r.score) for r in langid.predict(df, model).collect())
    assert f(a, 0) == f(b, 5000)


def test_language_edges(spark, docs_of):
    assert langid.identify(docs_of(EDGES).where("false")).collect() == []
    rows = langid.identify(docs_of([(i, t, None) for i, t in EDGES])).collect()  # nothing to learn from
    assert len(rows) == len(EDGES) and {(r.lang_pred, r.score) for r in rows} == {("und", 0.0)}
    train = [(10 + i, f"the of and it {i}", "en") for i in range(40)]
    one = {r.doc_id: r for r in langid.identify(docs_of(train + EDGES)).collect()}
    assert one[4].lang_pred == "en" and one[1].lang_pred == one[2].lang_pred == one[3].lang_pred == "und"
    train += [(60 + i, f"der und die das {i}", "de") for i in range(40)] + [(110 + i, f"les des une est {i}", "fr") for i in range(40)]
    docs = docs_of(train + EDGES).selectExpr("*", "1 as held_out", "2 as score", "3 as lang_pred")
    got = {r.doc_id: r.lang_pred for r in langid.identify(docs).collect()}
    assert all(got[i] == lang for i, _, lang in train)
    kept = langid.accepted(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    assert 1 not in ids and 2 not in ids and 3 not in ids and {i for i, _, _ in train} <= set(ids)


def test_texts_of_no_learned_language_are_rejected(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    foreign = [
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw.",
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan.",
        "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar.",
        "Все люди рождаются свободными и равными в своем достоинстве и правах.",
        "人人生而自由在尊严和权利上一律平等",
    ]
    rng = random.Random(3)
    hexes = [" ".join(f"{rng.randrange(1 << 32):08x}" for _ in range(n)) for n in (8, 200)]
    tokens = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(90))
    letters = " ".join("".join(rng.choice("qwxzjkvbpfg") for _ in range(12)) for _ in range(30))
    digits = " ".join(str(rng.randrange(10**16)) for _ in range(6)) + " the"
    junk = [*foreign, *[t * 50 for t in foreign], *hexes, tokens, letters, digits]
    clean = ["A.", "Re.", "De.", "This.", "Éaux.", "Die tz.", "In. The.", "Of " * 300, "Hean. Esanwh 2353820953013749 thheed hand, threingat."]
    planted = [(1_000_000 + i, t) for i, t in enumerate(junk + clean)]
    rows = spark.createDataFrame([(i, t, "en", "src0", len(t)) for i, t in planted], docs.schema)
    model = langid.fit(docs)
    assert {t: model.fits(t) for t in junk} == dict.fromkeys(junk, False)
    assert {t: model.fits(t) for t in clean} == dict.fromkeys(clean, True)
    got = langid.accepted(docs.union(rows))
    ids = {r.doc_id for r in got.where("doc_id >= 1000000").collect()}
    assert ids == {i for i, t in planted if t in clean}
    assert got.where("doc_id < 1000000").count() >= 0.998 * docs.count()


def test_learns_only_from_the_allowed_rows(spark, docs_of):
    held = [i for i in range(400) if __import__("zlib").crc32(str(i).encode()) % 4 == 2]
    rows = [(i, "the of and it", "zz") for i in held] + [(1000 + i, "the of and it", "en") for i in range(40)]
    assert {r.lang_pred for r in langid.identify(docs_of(rows)).collect()} == {"en"}


def test_em_recovers_labeller_accuracies():
    rng = np.random.default_rng(5)
    n, k = 20000, len(quality.LABELLERS)
    good = rng.random(n) < 0.85
    fires_bad = np.array([0.5, 0.4, 0.6, 0.3, 0.5, 0.4])
    patterns, truth = {}, {}
    for i in range(n):
        p = ["-" if rng.random() < (0.01 if good[i] else f) else "0" for f in fires_bad]
        p += ["+" if rng.random() < (0.8 if good[i] else 0.1) else "0" for _ in range(k - 6)]
        key = "".join(p)
        patterns[key] = patterns.get(key, 0) + 1
        truth.setdefault(key, []).append(good[i])
    posterior, accuracy, share = quality.estimate(patterns)
    assert abs(share - 0.85) < 0.02
    right = sum(sum(x == (posterior[key] >= 0.5) for x in v) for key, v in truth.items())
    assert right / n > 0.97
    assert 0.8 < accuracy["symbols"] < 1 and accuracy["prose"] > 0.95


def test_em_without_documents_or_votes():
    posterior, accuracy, share = quality.estimate({})
    assert posterior == {} and all(math.isnan(a) for a in accuracy.values())
    posterior, _, _ = quality.estimate({"0" * len(quality.LABELLERS): 7})
    assert list(posterior.values())[0] > 0.5


def test_quality_against_labels(spark):
    d = "/root/testdata/sf0.1"
    got = quality.classify(spark.read.parquet(f"{d}/documents.parquet"))
    assert got.columns == ["doc_id", "posterior", "score", "keep"]
    labels = spark.read.parquet(f"{d}/labels.parquet")
    rows = {(r.quality, r.keep): r["count"] for r in got.join(labels, "doc_id").groupBy("quality", "keep").count().collect()}
    assert rows.get((1, False), 0) <= 0.002 * rows[1, True]  # clean documents stay
    assert rows[0, False] >= 0.9 * (rows[0, False] + rows.get((0, True), 0))


def test_quality_edges(spark, docs_of):
    assert quality.classify(docs_of([]).where("false")).collect() == []
    docs = docs_of(EDGES).selectExpr("*", "1 as score", "2 as keep", "3 as votes")
    rows = quality.classify(docs).collect()
    assert len(rows) == len(EDGES)
    assert all(r.score == 0 and not r.keep for r in rows if r.doc_id in (1, 2))
    assert all(0 <= r.score <= 1 and 0 <= r.posterior <= 1 for r in rows)
    kept = quality.kept(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((r.doc_id for r in rows if r.keep), key=str)
