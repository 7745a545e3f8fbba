"""Mixing documents to target domain weights by soft membership.

1. A labelled table (doc_id, domain) fits a multinomial logistic classifier on a
   bounded sample of labelled documents.  Its features are the presence of the
   words and symbol runs that tell most about the domain, and a few shares of the
   text (symbols, capitals, repeats).  A second one, fitted on the third of the sample
   that the first has not seen, turns its scores into calibrated posteriors.  All
   weights have a prior of a fixed width, so little evidence moves them little.
2. Every document gets posteriors over the domains (they sum to one) from the whole
   of its text.
3. Rates 0 <= r <= MAX_RATE are fitted so that the expected tokens of each domain,
   the sum of rate * tokens * posterior, match the targets: projected gradient
   descent on the squared relative errors, from r = 1.  A step moves a document only
   along its posteriors, so documents of equal (rounded) posteriors share a rate, and
   each step is an aggregate over these cells.

DataFrame and SQL functions and the DataFrame classifiers of Spark throughout.  A
posterior and a rate depend on the row alone and on tables whose size is bounded
(vocabulary, cells), so no text is shuffled.
"""

from __future__ import annotations

import logging
import math

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved

TARGETS = {"good": 0.97, "poor": 0.02, "toxic": 0.01}
SAMPLE = 20_000  # labelled documents the classifier is fitted on (expected number)
VOCABULARY = 500  # words and symbol runs
WEIGHT_VARIANCE = 3.0  # of the classifier's weights, before any document is seen
SHARE_SCALE = 10.0  # of a share against the presence of a word
MAX_RATE = 1.9  # most copies of a document that the fit may ask for: none is multiplied
DECIMALS = 3  # posteriors are rounded to
STEPS = 300
STEPS_PER_TABLE = 20  # between two written tables of rates
PLAIN_STEPS = 10  # after a scaled step that the bounds spoilt
LEAST_PART = 1 / 8  # of a scaled step that is tried
SETTLED = 0.99  # of the cost before the plain steps: where more is left, the fit ends
STALLED = 1e-5  # share of each target a step must move to be followed by another
TOLERANCE = 1e-3  # relative error of each domain's tokens at which the fit ends

log = logging.getLogger(__name__)


def words_in(text: Column) -> Column:
    """Number of white-space words.  Where blanks and line feeds are the only white
    space, splitting at a single character costs half as much as by a pattern."""
    t = F.coalesce(text, F.lit(""))
    other = [F.contains(t, F.lit(c)) for c in "\t\x0B\f\r"]
    words = F.when(other[0] | other[1] | other[2] | other[3], F.split(t, r"[\x20\x09-\x0D]+"))
    return F.size(F.array_remove(words.otherwise(F.split(F.replace(t, F.lit("\n"), F.lit(" ")), " ")), ""))


def domains(labels: DataFrame) -> DataFrame:
    """The labels table (doc_id, quality, toxic) as (doc_id, domain)."""
    return labels.select(
        "doc_id", F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").otherwise("poor").alias("domain")
    )


# -------------------------------------------------------------- classifier ---

# What lies between words (runs of letters and digits), and symbols that are no punctuation of prose.
# Classes that list their characters are looked up in a table, ranges are tried one by one.
_WORD_GAPS = "[" + "".join(rf"\x{i:02X}" for i in range(128) if not chr(i).isalnum()) + "]+"
_SYMBOLS = r"!#$%&*+|<>{}\[\]=~^@\\_"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


SHARES = 4


class Classifier:
    """Domain names, the vocabulary, Spark's fitted model and the one that calibrates
    its scores (None: no labelled document, all domains equally likely everywhere)."""

    def __init__(self, names: list[str], vocabulary: list[str], model=None, calibrator=None):
        self.names, self.vocabulary, self.model, self.calibrator = names, vocabulary, model, calibrator


def _features(rows: DataFrame, vocabulary: list[str]) -> DataFrame:
    """Rows with ``marks`` and ``shares`` -> the same with the vector ``features``."""
    seen = CountVectorizerModel.from_vocabulary(vocabulary or ["\0"], inputCol="marks", outputCol="seen").setBinary(True)
    scaled = rows.withColumn("scaled", array_to_vector(F.array(*[F.col("shares")[i] * SHARE_SCALE for i in range(SHARES)])))
    return VectorAssembler(inputCols=["seen", "scaled"], outputCol="features").transform(seen.transform(scaled)).drop("seen", "scaled")


def _measured(rows: DataFrame, text: str) -> DataFrame:
    """``rows`` with ``tokens`` (white-space words), ``marks`` (distinct words of the
    text in lower case, and its distinct symbol runs) and ``shares`` in 0..1: symbols,
    capitals, repeated lines, marks against words.

    In steps, so that what several of them need is computed once: all but capitals
    and symbol runs is first cut down to blanks, and the rest of the work on them
    is done on the short text that remains."""
    t = F.coalesce(F.col(text), F.lit(""))
    kept = rows.columns
    short = F.regexp_replace(t, f"[^{_CAPITALS}{_SYMBOLS}]+", " ")
    rows = rows.select(*kept, words_in(t).cast("long").alias("tokens"), F.split(t, "\n").alias("lines"), short.alias("short"))
    rows = rows.withColumn("runs", F.regexp_extract_all("short", F.lit(f"[{_SYMBOLS}]+"), F.lit(0)))
    marks = F.array_remove(F.array_distinct(F.concat(F.split(F.lower(t), _WORD_GAPS), F.col("runs"))), "")
    chars = F.greatest(F.lit(1), F.length(t))
    rows = rows.select(
        *kept, "tokens", marks.alias("marks"),
        (F.length(F.array_join("runs", "")) / chars).alias("symbols"),
        (F.regexp_count("short", F.lit(f"[{_CAPITALS}]")) / chars).alias("capitals"),
        (F.lit(1.0) - F.size(F.array_distinct("lines")) / F.size("lines")).alias("repeats"),
    )
    rare = F.least(F.lit(1.0), F.size("marks") / F.greatest(F.lit(1), F.col("tokens")))
    return rows.select(*kept, "tokens", "marks", F.array("symbols", "capitals", "repeats", rare).alias("shares"))


def fit(docs: DataFrame, labelled: DataFrame, names: list[str], sample: int = SAMPLE, vocabulary: int = VOCABULARY) -> Classifier:
    """Logistic weights of the most informative words, symbol runs and shares.

    Labelled rows of other domains, without a doc_id or without a document are
    ignored; a doc_id labelled twice counts twice.  One empty document per domain is
    added, so each has a probability.  Without any labelled document all domains are
    equally likely everywhere.
    """
    usable = labelled.where(F.col("domain").isin(names) & F.col("doc_id").isNotNull()).select("doc_id", "domain")
    total = usable.count()
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("long"), F.lit("mixing sample")), F.lit(1_000_000))
    drawn = draw < F.lit(1e6 * sample / max(1, total))
    fold = F.pmod(F.xxhash64(F.col("doc_id").cast("long"), F.lit("calibration")), F.lit(3)).alias("fold")
    texts = _measured(docs.where(drawn).select("doc_id", fold, "text"), "text")
    everything = saved(texts.join(usable.where(drawn), "doc_id").select("fold", "domain", "marks", "shares"), "labelled")
    rows, unseen = everything.where("fold > 0").drop("fold"), everything.where("fold = 0").drop("fold")
    # the empty word stands for the document itself
    exploded = rows.select("domain", F.explode(F.concat(F.array(F.lit("")), "marks")).alias("word"))
    counts = exploded.groupBy("word").agg(*[F.count(F.when(F.col("domain") == d, 1)).alias(f"n{k}") for k, d in enumerate(names)])
    counts = saved(counts, "domain-words")
    sizes = counts.where("word = ''").first()
    sizes = [int(sizes[f"n{k}"]) if sizes else 0 for k in range(len(names))]
    n = sum(sizes)
    if not n:
        return Classifier(names, [])
    # mutual information of presence and domain
    held = sum(F.col(f"n{k}") for k in range(len(names)))
    gain = F.lit(0.0)
    for k, s in enumerate(sizes):
        for part, all_ in ((F.col(f"n{k}"), held), (F.lit(s) - F.col(f"n{k}"), F.lit(n) - held)):
            gain = gain + F.when(part > 0, part / n * F.log(part * n / (all_ * F.lit(max(1, s))))).otherwise(0.0)
    best = counts.where((F.col("word") != "") & (held > 1)).orderBy(gain.desc(), "word").limit(vocabulary)
    known = [r.word for r in best.select("word").collect()]  # at most `vocabulary` rows
    number = F.array_position(F.array(*[F.lit(d) for d in names]), F.col("domain")) - 1
    empty = rows.sparkSession.createDataFrame([(d, [], [0.0] * SHARES) for d in names], "domain string, marks array<string>, shares array<double>")
    data = _features(rows.unionByName(empty).withColumn("label", number.cast("double")), known)
    model = _logistic(n + len(names)).fit(data)
    held = model.transform(_features(unseen.unionByName(empty).withColumn("label", number.cast("double")), known))
    held = held.select("label", F.col("rawPrediction").alias("scores"))
    return Classifier(names, known, model, _logistic(unseen.count() + len(names), "scores", "calibrated").fit(held))


def _logistic(n: int, features: str = "features", posterior: str = "probability") -> LogisticRegression:
    """Multinomial regression over ``n`` documents, its prior weighed against their mean loss."""
    return LogisticRegression(
        featuresCol=features, probabilityCol=posterior, rawPredictionCol=f"raw_{posterior}" if posterior != "probability" else "rawPrediction",
        predictionCol=f"of_{posterior}", family="multinomial", maxIter=60, regParam=1.0 / (WEIGHT_VARIANCE * n), standardization=False,
    )


def _rounded(parts: list[Column]) -> list[Column]:
    """Shares that sum to one, rounded so that they still do and none is negative:
    all are cut off, and the units left go to the largest rests, first ones first."""
    unit = 10**DECIMALS
    whole = [F.floor(p * unit) for p in parts]
    rest = [p * unit - w for p, w in zip(parts, whole)]
    left = F.lit(unit) - sum(whole, F.lit(0))
    out = []
    for i, r in enumerate(rest):
        ahead = [((q > r) if j > i else (q >= r)).cast("int") for j, q in enumerate(rest) if j != i]
        out.append((whole[i] + (sum(ahead, F.lit(0)) < left).cast("int")) / F.lit(float(unit)))
    return out


def _with_posteriors(rows: DataFrame, model: Classifier, text: str) -> DataFrame:
    """``rows`` (whose columns include ``text``) with ``tokens``, white-space words,
    and p0, p1 ..., the rounded posteriors."""
    k = range(len(model.names))
    kept = rows.columns
    measured = _measured(rows, text)
    if model.model is None:
        parts = [F.lit(1.0 / len(model.names)) for _ in k]
        scored = measured
    else:
        scored = model.model.transform(_features(measured, model.vocabulary)).withColumnRenamed("rawPrediction", "scores")
        scored = model.calibrator.transform(scored).withColumn("posterior", vector_to_array("calibrated"))
        parts = [F.coalesce(F.try_element_at("posterior", F.lit(i + 1)), F.lit(0.0)) for i in k]
    return scored.select(*kept, "tokens", *[p.alias(f"p{i}") for i, p in enumerate(_rounded(parts))])


def _key(docs: DataFrame) -> list[Column]:
    return [F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash")]


def memberships(docs: DataFrame, model: Classifier) -> DataFrame:
    """(doc_id, text_hash, copies, tokens, p0, p1 ...) per distinct document: rows
    that repeat both doc_id and text are one, with their number in ``copies``.
    tokens are white-space words."""
    p = [f"p{i}" for i in range(len(model.names))]
    rows = _with_posteriors(docs.select(*_key(docs), "text"), model, "text").drop("text")
    counted = rows.groupBy("doc_id", "text_hash", "tokens", *p).agg(F.count("*").alias("copies"))
    return counted.select("doc_id", "text_hash", "copies", "tokens", *p)


# ------------------------------------------------------------------- rates ---


def _moved(rate: Column, moves: list[list[float]], domains: range, most: float) -> Column:
    """The rate after some steps; a move is step length times relative error by domain.

    The moves are one array literal, so every step of the fit has the same plan
    and runs the same compiled code."""

    def step(r, move):
        return F.least(F.lit(most), F.greatest(F.lit(0.0), r - sum((move[i] * F.col(f"p{i}") for i in domains), F.lit(0.0))))

    return F.aggregate(F.lit(moves), rate, step)


def _moments(state: DataFrame, errors: list[float], most: float) -> list[list[float]]:
    """Token moments (domains x domains) of the cells that a step can move: not of
    those at a bound that the gradient points beyond."""
    k = range(len(errors))
    slope = sum((F.col(f"p{i}") * errors[i] for i in k), F.lit(0.0))
    free = ((F.col("rate") > 0) | (slope < 0)) & ((F.col("rate") < most) | (slope > 0))
    t = F.when(free, F.col("t")).otherwise(0.0)
    values = [float(v or 0.0) for v in state.agg(*[F.sum(t * F.col(f"p{i}") * F.col(f"p{j}")) for i in k for j in k]).first()]
    return [values[i * len(errors) : (i + 1) * len(errors)] for i in k]


def _solved(matrix: list[list[float]], right: list[float]) -> list[float] | None:
    """The solution of a small linear system by elimination; None if it has none to rely on."""
    rows = [[*r, b] for r, b in zip(matrix, right)]
    n, scale = len(rows), max((abs(x) for r in matrix for x in r), default=0.0)
    for i in range(n):
        pivot = max(range(i, n), key=lambda r: abs(rows[r][i]))
        rows[i], rows[pivot] = rows[pivot], rows[i]
        if abs(rows[i][i]) <= 1e-12 * scale:
            return None
        for r in range(n):
            if r != i:
                by = rows[r][i] / rows[i][i]
                rows[r] = [x - by * y for x, y in zip(rows[r], rows[i])]
    return [rows[i][n] / rows[i][i] for i in range(n)]


def solve(
    cells: DataFrame, targets: list[float], steps: int = STEPS, tolerance: float = TOLERANCE, most: float = float("inf")
) -> DataFrame:
    """Cells (t, p0, p1 ...) -> the same rows with ``rate``.

    Minimises the sum over domains of (expected - target)^2 / target over rates
    from 0 to ``most``, in the inner product weighted by tokens.  There the gradient of a cell
    is its posteriors times the relative errors, and the largest curvature is at
    most the largest ratio of present to target tokens: posteriors sum to one.  The
    first step has that length, and it always lowers the cost; longer ones are
    taken back if the cost rises above that of the last three.  The
    gradient is first scaled by the token moments (domains x domains) of the cells it
    can move, which meets targets within reach in a few steps; such a step
    is shortened, then left for plain ones, unless it lowers the cost accordingly.  A domain with target zero is left out
    of the sum by a floor of one token.

    Raises RuntimeError if neither the targets are met nor the rates have settled
    after ``steps``.
    """
    goal = [max(1.0, t) for t in targets]
    k = range(len(goal))
    state = cells.withColumn("rate", F.lit(1.0))
    tokens = [F.sum(F.col("rate") * F.col("t") * F.col(f"p{i}")) for i in k]
    change = F.sum(F.col("t") * (F.col("rate") - F.col("last")) ** 2)
    now = [float(x or 0.0) for x in state.agg(*tokens).first()]
    safe = size = 1.0 / max(max(n / g for n, g in zip(now, goal)), 1e-9)
    errors = [(n - g) / g for n, g in zip(now, goal)]
    past, moves, base = [sum(e * e * g for e, g in zip(errors, goal))], [], state
    gram = None
    plain, part, mark = 0, 1.0, past[0]  # plain steps before the next scaled one; part of it to take; cost before the plain ones
    for step in range(1, steps + 1):
        if all(abs(e) <= tolerance for e in errors):
            break
        last = _moved(F.col("rate"), moves, k, most) if moves else F.col("rate")
        scaled = None
        if not plain:
            if gram is None:
                gram = _moments(state, errors, most)
            scaled = _solved(gram, [n - g for n, g in zip(now, goal)])
        moves.append([part * x for x in scaled] if scaled else [size * e for e in errors])
        state = base.withColumns({"last": last, "rate": _moved(F.col("rate"), moves, k, most)})
        length, *new = [float(x or 0.0) for x in state.agg(change, *tokens).first()]
        after = [(n - g) / g for n, g in zip(new, goal)]
        cost = sum(e * e * g for e, g in zip(after, goal))
        if scaled and cost > (1 - part / 2) * past[-1]:  # the bounds are in the way
            moves.pop()
            state = base.withColumn("rate", _moved(F.col("rate"), moves, k, most)) if moves else base
            if part > LEAST_PART:
                part /= 2
            else:
                plain, part, mark = PLAIN_STEPS, 1.0, past[-1]
            continue
        if size > safe and not scaled and cost > max(past[-3:]):  # too long: go back and take a shorter step
            moves.pop()
            state = base.withColumn("rate", _moved(F.col("rate"), moves, k, most)) if moves else base
            size = max(safe, size / 8)
            continue
        past.append(cost)
        state, gram = state.drop("last"), None
        if len(moves) == STEPS_PER_TABLE:
            state = base = saved(state, "rates")
            moves = []
        moved, turned = [n - b for n, b in zip(new, now)], [x - y for x, y in zip(after, errors)]
        now, errors = new, after
        if scaled:
            part = min(1.0, 2 * part)
            continue
        if plain == 1 and past[-1] > SETTLED * mark:
            break  # all of the plain steps together were not worth it
        plain = max(0, plain - 1)
        if all(abs(m) <= STALLED * g for m, g in zip(moved, goal)):
            break  # the targets are out of reach, or the rest is not worth a step
        # next step length from the curvature met on this one (Barzilai and Borwein)
        curve = sum(m * x for m, x in zip(moved, turned))
        size = max(safe, length / curve) if curve > 0 else safe
    else:
        if any(abs(e) > tolerance for e in errors):
            raise RuntimeError(f"mixing rates not settled after {steps} steps; relative errors by domain: {errors}")
    return state


def report(fitted: DataFrame, names: list[str], targets: list[float]) -> dict[str, tuple[float, float]]:
    """{domain: (expected tokens, target)} of fitted cells, logged; a missed target as a warning."""
    sums = [F.sum(F.col("rate") * F.col("t") * F.col(f"p{i}")) for i in range(len(names))]
    out = {d: (float(x or 0.0), t) for d, x, t in zip(names, fitted.agg(*sums).first(), targets)}
    for d, (got, want) in out.items():
        missed = abs(got - want) > TOLERANCE * max(1.0, want)
        log.log(logging.WARNING if missed else logging.INFO, "mixing: %s expects %.0f tokens, target %.0f", d, got, want)
    return out


def _fitted(soft: DataFrame, names: list[str], targets: dict[str, float], budget: float, max_rate: float) -> DataFrame:
    """(p0, p1 ..., rate): the rates of all cells of documents of equal posteriors."""
    p = [f"p{i}" for i in range(len(names))]
    cells = saved(soft.groupBy(*p).agg(F.sum(F.col("tokens") * F.col("copies")).cast("double").alias("t")), "cells")
    total = float(cells.agg(F.sum("t")).first()[0] or 0.0)
    scale = budget * total / sum(targets.values())
    goal = [targets[d] * scale for d in names]
    fitted = saved(solve(cells, goal, most=max_rate).select(*p, "t", "rate"), "rates")
    report(fitted, names, goal)
    # of three domains there are at most 501,501 cells, some 20 MB
    return F.broadcast(fitted.drop("t")) if len(names) <= 3 else fitted.drop("t")


def rates(
    docs: DataFrame,
    labelled: DataFrame,
    targets: dict[str, float] = TARGETS,
    budget: float = 1.0,
    sample: int = SAMPLE,
    vocabulary: int = VOCABULARY,
    max_rate: float = MAX_RATE,
) -> DataFrame:
    """(doc_id, text_hash, copies, tokens, p_<domain> ..., rate) per distinct document.

    ``budget``: total tokens wanted, as a share of those present; ``max_rate``: the
    highest rate.  A document without words has posteriors and a rate, but no tokens;
    expected tokens and targets by domain are logged, missed ones as warnings;
    a NULL doc_id stays NULL.  An empty table gives an empty result; other columns
    are ignored.
    """
    names = sorted(targets)
    model = fit(docs, labelled, names, sample, vocabulary)
    soft = saved(memberships(docs, model), "memberships")
    p = [f"p{i}" for i in range(len(names))]
    return soft.join(_fitted(soft, names, targets, budget, max_rate), p).select(
        "doc_id", "text_hash", "copies", "tokens", *[F.col(c).alias(f"p_{d}") for c, d in zip(p, names)], "rate"
    )


def mixed(
    docs: DataFrame, labelled: DataFrame, targets: dict[str, float] = TARGETS, budget: float = 1.0, max_rate: float = MAX_RATE
) -> DataFrame:
    """Rows of ``docs`` drawn by their rates: a rate of 2.3 gives two copies, and a
    third with probability 0.3 by a hash of doc_id and text.

    All columns are kept, whatever their names; NULL and empty texts and NULL ids are
    drawn like others; repeated rows are drawn alike."""
    names = sorted(targets)
    model = fit(docs, labelled, names)
    soft = saved(memberships(docs, model), "memberships")
    p = [f"p{i}" for i in range(len(names))]
    # the whole row travels as one column, beside columns of names of its own
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *_key(docs), F.col("text"))
    met = _with_posteriors(rows, model, "text").drop("text").join(_fitted(soft, names, targets, budget, max_rate), p)
    chance = F.pmod(F.xxhash64("doc_id", "text_hash", F.lit("mixing draw")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    copies = F.floor(F.col("rate") + chance).cast("int")
    return met.select("row", F.explode(F.array_repeat(F.lit(1), copies)).alias("copy")).select("row.*")
