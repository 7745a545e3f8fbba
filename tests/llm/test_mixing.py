"""Mixing against a numpy version of classifier and fit."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import mixing

NAMES = ["good", "poor", "toxic"]


def corpus(n=400):
    rng = random.Random(12)
    rows, labels = [], []
    for i in range(n):
        kind = rng.choices(NAMES, [0.7, 0.2, 0.1])[0]
        own = {"good": ["fine", "clear", "well"], "poor": ["$$$", "!!", "###"], "toxic": ["idiot", "clown", "vile"]}[kind]
        words = [rng.choice(own if rng.random() < 0.3 else ["the", "of", "and", "x", "Y"]) for _ in range(rng.randrange(1, 60))]
        rows.append((i, " ".join(words)))
        if i % 2:
            labels.append((i, kind))
    return rows, labels


def words(text):
    return (text or "").encode().lower().split()


def brute_marks(text):
    t = text or ""
    return {w for w in re.split("[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+", t.lower()) if w} | set(re.findall(r"[!#$%&*+|<>{}\[\]=~^@\\_]+", t))


def brute_shares(text):
    t = text or ""
    n, lines = max(1, len(t)), t.split("\n")
    own = [w for w in re.split(r"[\x20\x09-\x0D]+", t) if w]
    return [len(re.findall(r"[!#$%&*+|<>{}\[\]=~^@\\_]", t)) / n, len(re.findall("[A-Z]", t)) / n, 1 - len(set(lines)) / len(lines), min(1.0, len(brute_marks(t)) / max(1, len(own)))]


def brute_memberships(rows, model):
    """Softmax of the weights over marks and shares recomputed in Python."""
    both = [(m.coefficientMatrix.toArray(), m.interceptVector.toArray()) for m in (model.model, model.calibrator)]
    out = {}
    for i, t in rows:
        x = np.array([float(m in brute_marks(t)) for m in model.vocabulary] + [mixing.SHARE_SCALE * s for s in brute_shares(t)])
        for w, bias in both:
            x = w @ x + bias
        e = np.exp(x - x.max())
        out[i] = e / e.sum()
    return out


def test_memberships_equal_brute_force(spark, docs_of):
    rows, labels = corpus()
    rows += [(900, "Ünï 9x ÉÉ\n$$$ a_b\n$$$ a_b\n"), (901, ""), (902, None), (903, "\n\n  \t")]
    lab = spark.createDataFrame(labels + [(None, "good"), (3, "other")], "doc_id long, domain string")
    model = mixing.fit(docs_of(rows), lab, NAMES, vocabulary=30)
    got = mixing.memberships(docs_of(rows), model).collect()
    want, texts = brute_memberships(rows, model), dict(rows)
    assert len(got) == len(rows) and len(model.vocabulary) <= 30 and {"idiot", "$$$", "fine"} <= set(model.vocabulary)
    for r in got:
        assert r.tokens == len(words(texts[r.doc_id])) and r.copies == 1
        assert np.allclose([r.p0, r.p1, r.p2], want[r.doc_id], atol=1.1e-3)
        assert abs(r.p0 + r.p1 + r.p2 - 1) < 1e-9 and min(r.p0, r.p1, r.p2) >= 0


def test_texts_are_measured_once(spark, docs_of):
    rows, labels = corpus(60)
    rows += [(900, "tab\tfeed\x0c\x0breturn\r\n two  \n")]
    model = mixing.fit(docs_of(rows), spark.createDataFrame(labels, "doc_id long, domain string"), NAMES, vocabulary=30)
    out = mixing.memberships(docs_of(rows), model)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"lower\(coalesce\(text#", plan)) == 1 and "lambda" not in plan
    assert len(re.findall(r"regexp_\w+\(coalesce\(text#", plan)) == 1
    assert {r.doc_id: r.tokens for r in out.collect()} == {i: len(words(t)) for i, t in rows}


def test_rounded_shares_sum_to_one_and_are_not_negative(spark):
    cases = [(0.3336, 0.3336, 0.3326, 0.0002), (1.0, 0.0, 0.0, 0.0), (0.25, 0.25, 0.25, 0.25), (0.9996, 0.0002, 0.0001, 0.0001), (0.0005, 0.9985, 0.0005, 0.0005)]
    df = spark.createDataFrame(cases, "a double, b double, c double, d double")
    for case, r in zip(cases, df.select(*mixing._rounded([F.col(c) for c in "abcd"])).collect()):
        assert abs(sum(r) - 1) < 1e-12 and min(r) >= 0 and all(abs(x - y) <= 1.0001e-3 for x, y in zip(case, r))


@pytest.fixture(scope="module")
def labelled(spark):
    d = "/root/testdata/sf0.1"
    return spark.read.parquet(f"{d}/documents.parquet"), mixing.domains(spark.read.parquet(f"{d}/labels.parquet"))


def test_posteriors_are_calibrated_on_held_out_labels(labelled):
    docs, lab = labelled
    part = F.pmod(F.xxhash64("doc_id", F.lit("split")), F.lit(2))
    model = mixing.fit(docs, lab.where(part == 0), NAMES)
    held = mixing.memberships(docs, model).join(lab.where(part == 1), "doc_id")
    rows = held.collect()
    assert len(rows) > 1500
    for k, name in enumerate(NAMES):
        p, is_ = np.array([r[f"p{k}"] for r in rows]), np.array([r.domain == name for r in rows])
        assert abs(p.mean() - is_.mean()) < 0.015
        for lo, hi in ((0, 0.1), (0.1, 0.9), (0.9, 1.01)):
            own = (p >= lo) & (p < hi)
            assert own.sum() < 30 or abs(p[own].mean() - is_[own].mean()) < (0.15 if lo == 0.1 else 0.06)
    right = sum(r.domain == NAMES[int(np.argmax([r.p0, r.p1, r.p2]))] for r in rows)
    assert right / len(rows) > 0.95


def test_labelled_shares_come_within_a_point_of_the_targets(labelled):
    docs, lab = labelled
    rows = mixing.rates(docs, lab).join(lab, "doc_id").groupBy("domain").agg(F.sum(F.col("tokens") * F.col("rate")).alias("w"), F.max("rate").alias("most")).collect()
    total = sum(r.w for r in rows)
    for r in rows:
        assert abs(r.w / total - mixing.TARGETS[r.domain]) < 0.01 and r.most < 2


def test_rates_stay_below_their_bound(spark):
    cells = [(100.0, 1.0, 0.0), (10.0, 0.0, 1.0)]
    df = spark.createDataFrame(cells, "t double, p0 double, p1 double")
    got = {r.t: r.rate for r in mixing.solve(df, [50.0, 100.0], most=4.0).collect()}
    assert got[10.0] == 4.0 and abs(got[100.0] - 0.5) < 0.01


def test_mixing_takes_any_column_names(spark, docs_of):
    rows, labels = corpus(60)
    lab = spark.createDataFrame(labels, "doc_id long, domain string")
    docs = docs_of(rows).selectExpr("*", "1 as _hash", "2 as _copies", "3 as _id", "4 as row", "5 as p0", "6 as marks", "7 as features", "8 as text_hash", "9 as copy")
    out = mixing.mixed(docs, lab)
    assert out.columns == docs.columns and {tuple(r) for r in out.collect()} <= {tuple(r) for r in docs.collect()}


def brute_fit(t, p, goal, steps=20000):
    r = np.ones(len(t))
    size = 1 / ((t @ p) / goal).max()
    for _ in range(steps):
        e = ((r * t) @ p - goal) / goal
        r = np.maximum(0, r - size * p @ e)
    return r


def test_rates_reach_the_targets_and_the_least_squares_fit(spark, docs_of):
    rows, labels = corpus()
    lab = spark.createDataFrame(labels, "doc_id long, domain string")
    targets = {"good": 0.9, "poor": 0.08, "toxic": 0.02}
    got = mixing.rates(docs_of(rows), lab, targets, vocabulary=30).collect()
    t = np.array([r.tokens for r in got], float)
    p = np.array([[r.p_good, r.p_poor, r.p_toxic] for r in got])
    r = np.array([x.rate for x in got])
    goal = t.sum() * np.array([targets[k] for k in NAMES])
    assert (r >= 0).all() and np.allclose((r * t) @ p, goal, rtol=2e-3)
    assert np.allclose(r, brute_fit(t, p, goal), atol=0.02)


def test_unreachable_targets_give_the_nearest_nonnegative_fit(spark):
    # the second domain never occurs alone, the third target is out of reach
    cells = [(100.0, 0.9, 0.1, 0.0), (50.0, 0.5, 0.5, 0.0), (20.0, 0.2, 0.7, 0.1)]
    goal = [10.0, 100.0, 60.0]
    df = spark.createDataFrame(cells, "t double, p0 double, p1 double, p2 double")
    got = {tuple(r)[:4]: r.rate for r in mixing.solve(df, goal).collect()}
    a = np.array(cells)
    want = brute_fit(a[:, 0], a[:, 1:], np.array(goal))
    assert np.allclose([got[c] for c in cells], want, rtol=1e-2, atol=1e-2)
    assert min(got.values()) == 0


def test_unsettled_and_missed_targets_do_not_pass_silently(spark, caplog):
    cells = spark.createDataFrame([(100.0, 0.9, 0.1), (50.0, 0.2, 0.8)], "t double, p0 double, p1 double")
    with pytest.raises(RuntimeError, match="not settled after 1 steps"):
        mixing.solve(cells, [10.0, 300.0], steps=1)
    with caplog.at_level("INFO", logger=mixing.__name__):
        got = mixing.report(cells.selectExpr("*", "1.0D as rate"), ["good", "toxic"], [100.0, 80.0])
    assert got == {"good": (pytest.approx(100.0), 100.0), "toxic": (pytest.approx(50.0), 80.0)}
    assert [(r.levelname, r.args[0]) for r in caplog.records] == [("INFO", "good"), ("WARNING", "toxic")]


def test_mixed_draws_by_rate(spark, docs_of):
    rows, labels = corpus()
    docs = docs_of(rows)
    lab = spark.createDataFrame(labels, "doc_id long, domain string")
    targets = {"good": 0.5, "poor": 0.3, "toxic": 0.2}
    rate = {r.doc_id: r.rate for r in mixing.rates(docs, lab, targets).collect()}
    out = mixing.mixed(docs, lab, targets)
    assert out.columns == docs.columns
    drawn = [r.doc_id for r in out.collect()]
    for i, x in rate.items():
        assert drawn.count(i) in (math.floor(x), math.floor(x) + 1)
    assert abs(len(drawn) - sum(rate.values())) < 4 * math.sqrt(len(rate)) / 2


def test_edges(spark, docs_of):
    lab = spark.createDataFrame([(1, "good"), (2, "toxic")], "doc_id long, domain string")
    none = docs_of([]).where("false")
    assert mixing.rates(none, lab).collect() == [] == mixing.mixed(none, lab).collect()
    rows = [(1, None), (2, ""), (3, "a " * 50000), (4, "same"), (4, "same"), (4, "other"), (None, "no id"), (None, "no id")]
    docs = docs_of(rows).selectExpr("*", "1 as copies", "2 as rate", "3 as words", "4 as tokens", "5 as t")
    for labels in (lab, lab.where("false")):
        got = {(r.doc_id, r.tokens): r.copies for r in mixing.rates(docs, labels).collect()}
        assert got[None, 2] == 2 and got[3, 50000] == 1 and len(got) == 5 + (0 if (4, 1) not in got else 0)
        assert mixing.mixed(docs, labels).columns == docs.columns


def test_domains(spark):
    rows = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (3, 0, 0), (4, None, None)], "doc_id long, quality int, toxic int")
    assert [r.domain for r in mixing.domains(rows).orderBy("doc_id").collect()] == ["good", "toxic", "poor", "poor"]


@pytest.mark.parametrize("budget", [0.5])
def test_budget(spark, docs_of, budget):
    rows, labels = corpus()
    lab = spark.createDataFrame(labels, "doc_id long, domain string")
    got = mixing.rates(docs_of(rows), lab, budget=budget).collect()
    assert abs(sum(r.rate * r.tokens for r in got) / sum(r.tokens for r in got) - budget) < 0.01


def test_a_rare_domain_far_below_its_target(spark):
    # a few cells must grow twentyfold while another shrinks tenfold
    cells = [(9e5, 0.99, 0.0, 0.01), (1e4, 0.9, 0.1, 0.0), (1e5, 0.0, 0.0, 1.0), (500.0, 0.2, 0.8, 0.0)]
    total = sum(c[0] for c in cells)
    goal = [0.97 * total, 0.02 * total, 0.01 * total]
    df = spark.createDataFrame(cells, "t double, p0 double, p1 double, p2 double")
    got = mixing.solve(df, goal).collect()
    for i in range(3):
        assert abs(sum(r.rate * r.t * r[f"p{i}"] for r in got) - goal[i]) <= 2e-3 * goal[i]
