"""Quality classifier from weak labels.

1. Heuristic labellers vote bad (-1), good (+1) or nothing (0) on whole texts.
2. Expectation-maximisation estimates, from the counts of vote patterns over all
   documents, how each labeller votes on good and on bad documents, and the
   share of good ones.  Patterns are at most 3^labellers rows whatever the size
   of the corpus, counted with map-side combine.
3. The posteriors label a bounded sample of documents, and a logistic scorer is
   fitted on them (Spark's LogisticRegression) over hashed character n-grams
   and the labellers' measurements.  It scores every document.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import ArrowUDFType, arrow_udf

from .common import saved, worker_cache
from .textfeatures import DIMS, code_points, ngram_counts, unit

SAMPLE = 4000  # documents the scorer is fitted on (expected number)
KEEP = 0.5  # a document is kept from this score on
SHARE_WEIGHT = 10.0  # of a measured share against the unit n-gram vector
LABELLERS = ("symbols", "shouting", "capitals", "tables", "repeated_lines", "stuttering", "variety", "prose")


def measure(text: str | None) -> list[float]:
    """Shares in 0..1 the labellers look at: symbols, exclamation runs, capitals,
    cell bars, repeated lines, repeated neighbouring words, distinct words, words
    that end a sentence; then the numbers of words, lines and letters."""
    t = text or ""
    words = t.split()
    lines = [x for x in t.split("\n") if x.strip()]
    n = max(1, len(words))
    letters = sum(map(len, words)) or 1
    symbols = sum(t.count(c) for c in "#$%&*|<>{}[]=~^@\\_")
    upper = len(t) - len(t.translate(_no_capitals()))
    same = sum(a == b for a, b in zip(words, words[1:]))
    return [
        min(1.0, symbols / letters),
        min(1.0, sum(w.endswith("!!") for w in words) / n),
        min(1.0, upper / letters),
        words.count("|") / n,
        1 - len(set(lines)) / max(1, len(lines)),
        same / n,
        len(set(words)) / n,
        sum(w[-1] in ".?!" for w in words) / n,
        float(len(words)),
        float(len(lines)),
        float(letters),
    ]


def _no_capitals():
    cache = worker_cache("capitals")
    if not cache:
        cache["table"] = dict.fromkeys(i for i in range(0x0530) if chr(i).isupper())
    return cache["table"]


def votes(m: list[float]) -> str:
    """One character per labeller: ``-`` bad, ``+`` good, ``0`` no vote."""
    symbols, shouting, capitals, bars, lines, stutter, variety, ends, n_words, n_lines, letters = m
    out = [
        "-" if symbols > 0.04 and letters >= 20 else "0",
        "-" if shouting > 0.1 and n_words >= 5 else "0",
        "-" if capitals > 0.4 and letters >= 40 else "0",
        "-" if bars > 0.1 and n_words >= 5 else "0",
        "-" if lines > 0.4 and n_lines >= 4 else "0",
        "-" if stutter > 0.15 and n_words >= 10 else "0",
        "-" if variety < 0.25 and 40 <= n_words <= 1000 else "+" if variety > 0.5 and n_words >= 10 else "0",
        "+" if ends > 0.02 and symbols < 0.02 and stutter < 0.05 and shouting == 0 else "0",
    ]
    return "".join(out) if n_words else "-" * len(out)


def estimate(patterns: dict[str, int], rounds: int = 200):
    """EM over vote pattern counts.

    Returns (posterior of good by pattern, accuracy by labeller, share of good).
    Start: a pattern with a bad vote is probably bad.  Each labeller has its own
    vote distribution per class, smoothed by pseudo-counts; an accuracy is the
    expected share of its votes that name the right class (NaN if it never votes).
    """
    import numpy as np

    keys = sorted(patterns)
    k = len(LABELLERS)
    count = np.array([patterns[p] for p in keys], float)
    v = np.array([["-0+".index(c) for c in p] for p in keys], int).reshape(len(keys), k)
    one_hot = v[:, :, None] == np.arange(3)
    good = np.array([0.05 if "-" in p else 0.95 for p in keys])
    share = 0.9
    for _ in range(rounds):
        share = (good @ count + 1) / (count.sum() + 2)
        log = np.zeros((2, len(keys)))
        for c, weight in enumerate((1 - good, good)):
            seen = np.einsum("p,pjv->jv", weight * count, one_hot)
            p = (seen + 0.1) / (seen.sum(1, keepdims=True) + 0.3)
            log[c] = np.log(p)[np.arange(k), v].sum(1) + np.log(share if c else 1 - share)
        new = 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))
        done = new.size == 0 or np.abs(new - good).max() < 1e-9
        good = new
        if done:
            break
    with np.errstate(invalid="ignore"):
        right = (one_hot[:, :, 2].T * good * count + one_hot[:, :, 0].T * (1 - good) * count).sum(1)
        cast = ((v != 1).T * count).sum(1)
        accuracy = dict(zip(LABELLERS, (right / cast).tolist()))
    return dict(zip(keys, good.tolist())), accuracy, float(share)


def features(text: str | None, m: list[float]):
    """Unit n-gram vector of the raw text followed by the eight shares.  Both count
    less the less text they were measured on, so a few words decide little."""
    import numpy as np

    c = code_points(text or "")
    trust = SHARE_WEIGHT * m[8] / (m[8] + 10)
    return np.concatenate([unit(ngram_counts(c)) * (c.size / (c.size + 100)), trust * np.array(m[:8])])


def _vote_batches(batches):
    import pyarrow as pa

    for b in batches:
        got = [votes(measure(t)) for t in b.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(got, pa.string())], ["votes"])


def _sample_batches(posterior):
    def run(batches):
        import pyarrow as pa

        for b in batches:
            for t in b.column(0).to_pylist():
                m = measure(t)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([posterior.get(votes(m), 0.5)]), pa.array([features(t, m).tolist()], pa.list_(pa.float64()))],
                    ["p", "x"],
                )

    return run


class Model:
    def __init__(self, posterior, accuracy, share, weights, bias):
        self.posterior, self.accuracy, self.share = posterior, accuracy, share
        self.weights, self.bias = weights, bias

    def score(self, text: str | None) -> tuple[float, float]:
        """(posterior of the labellers, score of the linear scorer), both 0..1."""
        import math

        m = measure(text)
        p = self.posterior.get(votes(m), 0.5)
        if not (text or "").strip():
            return p, 0.0
        z = float(self.weights @ features(text, m)) + self.bias
        return p, 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model:
    import numpy as np

    texts = docs.select("text")
    counted = texts.mapInArrow(_vote_batches, "votes string").groupBy("votes").count()
    patterns = {r.votes: r["count"] for r in counted.collect()}  # at most 3^labellers rows
    posterior, accuracy, share = estimate(patterns)
    total = sum(patterns.values())
    zero = np.zeros(DIMS + 8)
    if not total:
        return Model(posterior, accuracy, share, zero, 0.0)
    draw = F.pmod(F.xxhash64("text", F.lit("quality sample")), F.lit(1_000_000))
    chosen = docs.where(F.col("text").isNotNull() & (draw < 1e6 * sample / total)).select("text")
    rows = saved(chosen.mapInArrow(_sample_batches(posterior), "p double, x array<double>"), "quality")
    sides = rows.select(
        (F.col("p") >= 0.5).cast("double").alias("label"),
        F.abs(2 * F.col("p") - 1).alias("w"),  # certain posteriors weigh most
        array_to_vector("x").alias("features"),
    ).where("w > 0")
    if sides.select("label").distinct().count() < 2:  # one class only: a constant scorer
        return Model(posterior, accuracy, share, zero, float(np.log((share + 1e-6) / (1 - share + 1e-6))))
    m = LogisticRegression(maxIter=100, regParam=1e-5, weightCol="w", standardization=False).fit(sides)
    return Model(posterior, accuracy, share, m.coefficients.toArray(), float(m.intercept))


def _score_batches(model, keep):
    def run(batches):
        import pyarrow as pa

        for b in batches:
            got = [model.score(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    pa.array([g[0] for g in got], pa.float64()),
                    pa.array([g[1] for g in got], pa.float64()),
                    pa.array([g[1] >= keep for g in got], pa.bool_()),
                ],
                ["doc_id", "posterior", "score", "keep"],
            )

    return run


def classify(docs: DataFrame, sample: int = SAMPLE, keep: float = KEEP) -> DataFrame:
    """(doc_id, posterior, score, keep) for every row of ``docs``.

    posterior: of being good, by the labellers alone; score: of the scorer; keep:
    score >= ``keep``.  NULL, empty and white-space texts score 0 and are not kept.
    Repeated rows and NULL ids stay as they are; an empty table gives an empty
    result; other columns are ignored.
    """
    model = fit(docs, sample)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _score_batches(model, keep), "doc_id long, posterior double, score double, keep boolean"
    )


def _keeps(model, keep):
    def run(texts):
        import pyarrow as pa

        return pa.array([model.score(t.as_py())[1] >= keep for t in texts], pa.bool_())

    return arrow_udf(run, "boolean", ArrowUDFType.SCALAR)


def kept(docs: DataFrame, sample: int = SAMPLE, keep: float = KEEP) -> DataFrame:
    """Rows of ``docs`` that score at least ``keep``, all columns."""
    return docs.where(_keeps(fit(docs, sample), keep)("text"))  # only the texts leave the JVM
