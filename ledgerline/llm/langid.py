"""Language identification in two steps: family, then language within it.

Both steps are linear support vector machines over hashed character n-grams of
the whole text: one machine for each pair of families, and one for each pair of
languages of one family; the class with most wins is predicted, ties go to the
larger summed margin, then to the first name.  The machines are fitted by
Spark's LinearSVC on a bounded sample of the labelled rows; prediction is one
pass over the texts with no shuffle.

A prediction names the nearest learned language, however far it is.  Whether a
text is in a learned language at all is decided apart from it, by the mean
n-gram log-likelihood under the languages' profiles (see ``Model.fits``).
"""

from __future__ import annotations

from itertools import combinations

from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import ArrowUDFType, arrow_udf

from .common import saved
from .textfeatures import DIMS, code_points, letters_only, ngram_counts, unit

# Families of common languages; any other language is its own family.
FAMILIES = {
    "germanic": ("da", "de", "en", "is", "nl", "no", "sv"),
    "romance": ("ca", "es", "fr", "it", "pt", "ro"),
    "slavic": ("bg", "cs", "pl", "ru", "sk", "uk"),
}
UNKNOWN = "und"
SAMPLE_PER_LANGUAGE = 1000  # labelled rows per language the machines are fitted on (expected number)
ITERATIONS = 20
MIN_SCORE = 0.05  # below it the prediction is rejected (see ``accepted``)
MAX_MISFIT = 4.6  # standard deviations a text may lie below the mean log-likelihood of its best profile
MIN_WORD_SHARE = 0.2  # of the visible characters that are letters of words without digits
MIN_GRAMS = 20_000  # n-grams a profile is learnt from; a thinner one rejects nothing


def family_of(lang: str) -> str:
    return next((f for f, members in FAMILIES.items() if lang in members), f"only {lang}")


def held_out():
    """True for documents nothing may be learnt from; false where doc_id is NULL."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def features(text: str | None):
    """Unit vector of n-gram counts; None if the text has no letter."""
    c = letters_only(code_points(text or ""))
    return unit(ngram_counts(c)) if c.size else None


def _feature_batches(batches):
    import pyarrow as pa

    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if (x := features(text)) is not None:
                n = 3.0 * letters_only(code_points(text)).size - 3
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang]), pa.array([x.tolist()], pa.list_(pa.float64())), pa.array([n])], ["lang", "x", "n"]
                )


def _sample(docs: DataFrame, per_language: int) -> DataFrame:
    """About ``per_language`` learnable rows of each language, chosen by a hash of
    doc_id: no sort, no window, the same rows whatever the partitioning."""
    known = docs.where(~held_out() & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = known.groupBy("lang").count().collect()  # one row per language
    draw = F.pmod(F.xxhash64("doc_id", F.lit("language sample")), F.lit(1_000_000))
    rate = F.lit(0.0)
    for r in sizes:
        rate = F.when(F.col("lang") == r.lang, F.lit(1e6 * per_language / r["count"])).otherwise(rate)
    return known.where(draw < rate).select("lang", "text")


def _machine(rows: DataFrame, first: list[str], second: list[str]):
    """(weights, bias) of a linear SVM that is positive for the languages ``first``."""
    data = rows.where(F.col("lang").isin(first + second)).select(
        F.col("lang").isin(first).cast("double").alias("label"), array_to_vector("x").alias("features")
    )
    m = LinearSVC(maxIter=ITERATIONS, regParam=1e-3, standardization=False).fit(data)
    return m.coefficients.toArray(), float(m.intercept)


def _profiles(rows: DataFrame) -> dict:
    """Per language with enough text: (log share of each n-gram cell, its mean and
    standard deviation over the language's n-grams).  Every text counts the same."""
    import numpy as np

    total = F.aggregate("x", F.lit(0.0), lambda a, b: a + b)
    shares = array_to_vector(F.transform("x", lambda v: v / F.col("total")))
    mean = vector_to_array(Summarizer.mean(shares)).alias("p")
    out = {}
    for r in rows.withColumn("total", total).groupBy("lang").agg(mean, F.sum("n").alias("n")).collect():  # one row per language
        if r.n >= MIN_GRAMS:
            p = np.array(r.p) + 1e-5
            p /= p.sum()
            log = np.log(p)
            mean_log = float(p @ log)
            out[r.lang] = (log, mean_log, max(1e-9, float(np.sqrt(p @ (log - mean_log) ** 2))))
    return out


def word_share(text: str | None) -> float:
    """Share of the visible characters that are letters of words without a digit."""
    words = (text or "").split()
    letters = sum(sum(map(str.isalpha, w)) for w in words if not any(map(str.isdigit, w)))
    return letters / max(1, sum(map(len, words)))


class Model:
    """Families, their languages, one machine per pair, and profiles (plain arrays)."""

    def __init__(self, families: dict[str, list[str]], machines: dict, profiles: dict | None = None):
        self.families, self.machines, self.profiles = families, machines, profiles or {}

    def _vote(self, x, names: list[str]) -> tuple[str, float]:
        import math

        wins, sums, low = dict.fromkeys(names, 0), dict.fromkeys(names, 0.0), dict.fromkeys(names, math.inf)
        for a, b in combinations(names, 2):
            w, bias = self.machines[a, b]
            m = float(w @ x) + bias
            for name, margin in ((a, m), (b, -m)):
                wins[name] += margin > 0 or (margin == 0 and name == a)
                sums[name] += margin
                low[name] = min(low[name], margin)
        best = min(names, key=lambda n: (-wins[n], -sums[n], n))
        return best, 1.0 if len(names) == 1 else 1 / (1 + math.exp(-max(-30.0, min(30.0, 4 * low[best]))))

    def predict(self, text: str | None) -> tuple[str, float]:
        return self._predict(features(text))

    def _predict(self, x) -> tuple[str, float]:
        if x is None or not self.families:
            return UNKNOWN, 0.0
        family, p = self._vote(x, sorted(self.families))
        lang, q = self._vote(x, self.families[family])
        return lang, p * q

    def misfit(self, x) -> float:
        """Standard deviations the mean log-likelihood of the n-grams lies below the
        mean of the best profile.  The deviation is that of as many independent
        n-grams as the text has different ones (inverse Simpson index), so a short
        text and a repeated word are given more room than a long varied one."""
        import math

        share = x / x.sum()
        effective = 1 / float(share @ share)
        return min((mean - float(share @ log)) / sd for log, mean, sd in self.profiles.values()) * math.sqrt(effective)

    def fits(self, text: str | None, min_score: float = MIN_SCORE) -> bool:
        """Is the text in a learned language?  Not where nothing is predicted, where
        words are a small part of it (dumps of digits, keys) or where no profile fits.
        A language with too little text for a profile takes what is predicted as it."""
        x = features(text)
        lang, score = self._predict(x)
        if lang == UNKNOWN or score < min_score or word_share(text) < MIN_WORD_SHARE:
            return False
        return lang not in self.profiles or self.misfit(x) <= MAX_MISFIT


def fit(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """Fit on text and lang only.  No labelled row: a model that predicts ``und``;
    one language: a model that always predicts it."""
    rows = saved(_sample(docs, per_language).mapInArrow(_feature_batches, "lang string, x array<double>, n double"), "languages")
    langs = sorted(r.lang for r in rows.select("lang").distinct().collect())  # one row per language
    families: dict[str, list[str]] = {}
    for lang in langs:
        families.setdefault(family_of(lang), []).append(lang)
    machines = {}
    for a, b in combinations(sorted(families), 2):
        machines[a, b] = _machine(rows, families[a], families[b])
    for members in families.values():
        for a, b in combinations(members, 2):
            machines[a, b] = _machine(rows, [a], [b])
    return Model(families, machines, _profiles(rows))


def _predict_batches(model):
    def run(batches):
        import pyarrow as pa

        for b in batches:
            got = [model.predict(t) for t in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                [*b.schema.names[:-1], "lang_pred", "score"],
            )

    return run


def predict(docs: DataFrame, model: Model) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), "text").mapInArrow(
        _predict_batches(model), "doc_id long, held_out boolean, lang_pred string, score double"
    )


def identify(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of ``docs``.

    NULL texts and texts without a letter: ``und``, score 0.  Repeated rows stay
    repeated; a NULL doc_id is predicted, never learnt from; an empty table gives
    an empty result; other columns are ignored.  score is the product of the two
    steps' logistic margins.
    """
    return predict(docs, fit(docs, per_language))


def _fits(model, min_score):
    def run(texts):
        import pyarrow as pa

        return pa.array([model.fits(t.as_py(), min_score) for t in texts], pa.bool_())

    return arrow_udf(run, "boolean", ArrowUDFType.SCALAR)


def accepted(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, min_score: float = MIN_SCORE) -> DataFrame:
    """Rows of ``docs`` whose language is recognised: not ``und``, a score of at least
    ``min_score``, and a text that fits a learned language (``Model.fits``).  All
    columns are kept."""
    return docs.where(_fits(fit(docs, per_language), min_score)("text"))  # only the texts leave the JVM


__all__ = ["DIMS", "accepted", "fit", "identify", "predict"]
