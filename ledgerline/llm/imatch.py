"""I-Match fingerprints over a band of inverse document frequencies.

1. Exact document frequencies over all documents, in two passes: terms frequent
   within some task, then their counts everywhere.
2. The lexicon is the terms whose share of the documents lies within a band.
   At most (mean distinct terms per document) / (lower share) terms can reach the
   lower share, whatever the size of the corpus, so the lexicon may be sent to
   every task; the bound is checked.
3. A text's fingerprint hashes its sorted distinct lexicon terms, and again for
   each of several random subsets of the lexicon of decreasing density: dense
   subsets tell small changes apart, sparse ones survive large changes.
"""

from __future__ import annotations

import hashlib

from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

LOW_SHARE = 0.0005  # a lexicon term is in at least this share of the documents (and in two)
HIGH_SHARE = 0.10  # and at most in this one
DENSITIES = (3, 5, 7, 9)  # subsets keep a term with probability 1 / 2^density
SUBSETS = 16  # per density
PUNCTUATION = b".,;:!?\"'()[]{}|#$%&*"
MAX_LEXICON = 1 << 22  # terms, 32 MB; more is an error, never a cut
TERMS_HELD = 1 << 22  # entries a task gathers before it merges them into its counts
EMPTY = "-"


def terms(text: str | None):
    """Sorted 64-bit hashes of the distinct terms: white-space words, A-Z folded,
    outer ASCII punctuation removed."""
    import numpy as np
    from xxhash import xxh64_intdigest

    words = {w.strip(PUNCTUATION) for w in set((text or "").encode("utf-8", "surrogatepass").lower().split())}
    words.discard(b"")
    out = np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))
    out.sort()
    return out


class _Counts:
    """Documents by term, merged whenever TERMS_HELD new entries have come in."""

    def __init__(self):
        import numpy as np

        self.terms, self.counts = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.held, self.size, self.documents = [], 0, 0

    def add(self, terms):
        self.held.append(terms)
        self.size += terms.size
        self.documents += 1
        if self.size >= TERMS_HELD:
            self.merge()

    def merge(self):
        import numpy as np

        every = np.concatenate([self.terms, *self.held])
        weight = np.ones(every.size, np.int64)
        weight[: self.counts.size] = self.counts
        self.terms, at = np.unique(every, return_inverse=True)
        self.counts = np.bincount(at, weight, self.terms.size).astype(np.int64)
        self.held, self.size = [], 0

    def batch(self, keep=None):
        import pyarrow as pa

        t, n = (self.terms, self.counts) if keep is None else (self.terms[keep], self.counts[keep])
        return pa.RecordBatch.from_arrays([pa.array(t.view("int64")), pa.array(n)], ["term", "n"])


def _frequent_batches(low):
    """Terms that reach the lower share among the documents of this task."""

    def run(batches):
        seen = _Counts()
        for b in batches:
            for text in b.column(0).to_pylist():
                seen.add(terms(text))
        if seen.documents:
            seen.merge()
            yield seen.batch(seen.counts >= low * seen.documents * (1 - 1e-9))

    return run


def _count_batches(only=None):
    """Documents of this task by term, of all terms or of a sorted array of them."""

    def run(batches):
        import numpy as np

        seen = _Counts()
        for b in batches:
            for text in b.column(0).to_pylist():
                t = terms(text)
                if only is not None and only.size:
                    t = t[only[np.minimum(np.searchsorted(only, t), only.size - 1)] == t]
                seen.add(t)
        if seen.documents:
            seen.merge()
            yield seen.batch()

    return run


def lexicon(docs: DataFrame, low: float = LOW_SHARE, high: float = HIGH_SHARE, most: int = MAX_LEXICON):
    """Sorted array of the term hashes within the band.

    A term that reaches the lower share of all documents reaches it in at least
    one task, so only terms frequent within a task are candidates, and a second
    pass counts these exactly; rare terms are never shuffled.  Should the tasks be
    so small that there are more than ``most`` candidates, all terms are counted;
    the result is the same.
    """
    import numpy as np

    texts = docs.select("text")
    array = lambda df: np.sort(df.toArrow().column(0).to_numpy().astype(np.int64).view(np.uint64))
    frequent = texts.mapInArrow(_frequent_batches(low), "term long, n long").select("term").distinct()
    only = array(frequent.limit(most + 1))
    counter = _count_batches(only if only.size <= most else None)
    counted = texts.mapInArrow(counter, "term long, n long").groupBy("term").agg(F.sum("n").alias("df"))
    total = docs.count()
    band = counted.where((F.col("df") >= max(2, low * total)) & (F.col("df") <= max(2, high * total))).select("term")
    got = array(band.limit(MAX_LEXICON + 1))
    if got.size > MAX_LEXICON:
        raise RuntimeError("the band holds too many terms to send to every task; raise the lower share")
    return got


def _member_masks(t):
    """Rows: subsets; columns: terms."""
    import numpy as np

    seeds = np.arange(1, len(DENSITIES) * SUBSETS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = t[None, :] ^ seeds[:, None]
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    masks = np.repeat(np.array([(1 << d) - 1 for d in DENSITIES], np.uint64), SUBSETS)
    return x & masks[:, None] == 0


def fingerprint(text: str | None, lex) -> str:
    """Space-joined hashes: of all band terms (16 digits), then of each subset (6
    digits, ``-`` for a subset the text has no term of).  A text without any band
    term is hashed whole, with the mark ``=``."""
    import numpy as np
    from xxhash import xxh64_hexdigest

    t = terms(text)
    if lex.size and t.size:
        at = np.minimum(np.searchsorted(lex, t), lex.size - 1)
        t = t[lex[at] == t]
    else:
        t = t[:0]
    if not t.size:
        return "=" + xxh64_hexdigest((text or "").encode("utf-8", "surrogatepass"))
    out = [xxh64_hexdigest(t.tobytes())]
    for mask in _member_masks(t):
        own = t[mask]
        out.append(xxh64_hexdigest(own.tobytes())[:6] if own.size else EMPTY)
    return " ".join(out)


def likeness(a: str, b: str) -> float:
    """Share of equal hashes among those that either fingerprint has (0 to 1)."""
    if a == b:
        return 1.0
    if a[0] == "=" or b[0] == "=":
        return 0.0
    pairs = [(x, y) for x, y in zip(a.split(" "), b.split(" ")) if x != EMPTY or y != EMPTY]
    return sum(x == y for x, y in pairs) / len(pairs)


def fingerprints(docs: DataFrame, low: float = LOW_SHARE, high: float = HIGH_SHARE) -> DataFrame:
    """(doc_id, fingerprint) for every row of ``docs``; NULL texts count as empty."""
    lex = lexicon(docs, low, high)

    def run(batches):
        import pyarrow as pa

        for b in batches:
            got = [fingerprint(t, lex) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, pa.string())], ["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fingerprint string")


# ------------------------------------------------------------ edited texts ---

RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _compare(doc_id, text, own, after, after_fp, lex):
    n = len(text)
    half = n // 2
    edited = text[: n - half] + after[:half]
    changed = fingerprint(edited, lex)
    digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
    return doc_id, n, digest, own, changed, likeness(own, changed), likeness(own, after_fp)


def _batch(rows, schema):
    import pyarrow as pa

    kinds = {"long": pa.int64(), "string": pa.string(), "double": pa.float64(), "int": pa.int32()}
    fields = [f.split() for f in schema.split(", ")]
    cols = zip(*rows) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(cols, fields)], [n for n, _ in fields])


_EDGES = RESULT + ", part int, head string, tail string"


def _run_batches(lex, rows_out=2000):
    """Rows in descending order: each is compared with the one after it; the first
    text of the partition and the last, which has no successor here, are handed on."""

    def run(batches):
        part = TaskContext.get().partitionId()
        out, before = [], None
        for b in batches:
            texts = b.column(1)
            for k, doc_id in enumerate(b.column(0).to_pylist()):
                text = texts[k].as_py() or ""
                own = fingerprint(text, lex)
                if before is None:
                    out.append((None,) * 7 + (part, text, None))
                else:
                    out.append(_compare(*before, text, own, lex) + (part, None, None))
                before = doc_id, text, own
                if len(out) >= rows_out:
                    yield _batch(out, _EDGES)
                    out = []
        if before is not None:
            out.append((before[0],) + (None,) * 6 + (part, None, before[1]))
            yield _batch(out, _EDGES)

    return run


def _edge_batches(lex):
    def run(batches):
        for b in batches:
            rows = []
            for doc_id, text, after in zip(*(c.to_pylist() for c in b.columns)):
                rows.append(_compare(doc_id, text, fingerprint(text, lex), after, fingerprint(after, lex), lex))
            yield _batch(rows, RESULT)

    return run


def edit_report(docs: DataFrame, low: float = LOW_SHARE, high: float = HIGH_SHARE) -> DataFrame:
    """Each text's fingerprint beside that of its edited text and of the next one.

    The next document is the one with the next smaller doc_id, after the smallest
    the largest (NULL ids come last, equal ids are ordered by text); the edited
    text keeps the first half (rounded up) of the code points and goes on with as
    many of the next document's first ones.  Documents are dealt to tasks by
    doc_id range and compared as they stream by; only the texts at the ends of a
    range (one row each) are matched up afterwards.

    NULL texts count as empty; a single document is its own successor; an empty
    table gives an empty result; other columns are ignored.
    """
    lex = lexicon(docs, low, high)
    ordered = (
        docs.select(F.col("doc_id").cast("long"), "text")
        .repartitionByRange(F.desc("doc_id"))
        .sortWithinPartitions(F.desc("doc_id"), "text")
    )
    rows = saved(ordered.mapInArrow(_run_batches(lex), _EDGES), "edits")
    heads = rows.where("head is not null").select("part", "head")
    order = Window.orderBy("part")  # one row per range
    steps = heads.select("part").select(
        "part", F.coalesce(F.lead("part").over(order), F.first("part").over(order)).alias("after")
    )
    tails = rows.where("tail is not null").select("part", "doc_id", "tail")
    pairs = tails.join(steps, "part").join(heads.select(F.col("part").alias("after"), "head"), "after")
    last = pairs.select("doc_id", "tail", "head").mapInArrow(_edge_batches(lex), RESULT)
    inner = rows.where("head is null and tail is null")
    return inner.select(*[f.split()[0] for f in RESULT.split(", ")]).unionByName(last)
