"""Licence scan over whole texts with a positional rare-token index.

1. One pass counts, for every word of the licence templates, the documents that
   hold it.
2. Of each template the (at most two) words of highest IDF are indexed with
   their position in the template; words in more than a tenth of the documents
   are indexed only if the template has nothing rarer.
3. One pass looks the indexed words up in each text, shifts their positions to
   where the template would begin, intersects those beginnings over the
   template's indexed words, and verifies the mandatory phrase there.

Everything is expressions over one row; the only shuffle is the word count of
the first pass (one row per template word and task).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower

# Label, mandatory phrase, strength (a bare name 0.5, a name with
# its version or clause 0.8, wording of the licence text itself 1.0).
BASE = (
    ("gpl", "gnu general public license", 0.5),
    ("apache", "apache license", 0.5),
    ("cc-by", "cc by", 0.5),
    ("mit", "mit license", 0.5),
)
MORE = (
    ("agpl", "gnu affero general public license", 0.8),
    ("apache-2.0", "apache license version 2 0", 0.8),
    ("bsd", "redistribution and use in source and binary forms", 1.0),
    ("cc-by-nc", "cc by nc", 0.8),
    ("cc-by-nd", "cc by nd", 0.8),
    ("cc-by-sa", "cc by sa", 0.8),
    ("creative-commons", "creative commons attribution", 0.8),
    ("gpl-2", "gnu general public license version 2", 0.8),
    ("gpl-3", "gnu general public license version 3", 0.8),
    ("lgpl", "gnu lesser general public license", 0.8),
    ("mit-text", "permission is hereby granted free of charge", 1.0),
    ("mpl-2.0", "mozilla public license version 2 0", 0.8),
)
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
INDEXED_WORDS = 2  # per template
COMMON = 0.1  # a word in a larger share of the documents is not indexed, if avoidable


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def _literals(words) -> Column:
    return F.array(*[F.lit(w) for w in words])


def document_frequencies(docs: DataFrame, templates=BASE + MORE) -> tuple[dict[str, int], int]:
    """(documents holding each template word, documents); at most one row per
    template word comes back."""
    vocabulary = sorted({w for _, phrase, _ in templates for w in phrase.split()})
    found = docs.select(F.array_intersect(words_of(F.col("text")), _literals(vocabulary)).alias("found"))
    # the empty word stands for the document itself
    counted = found.select(F.explode(F.concat(F.array(F.lit("")), "found")).alias("word")).groupBy("word").count()
    df = {r.word: r["count"] for r in counted.collect()}
    total = df.pop("", 0)
    return {w: df.get(w, 0) for w in vocabulary}, total


def index_words(phrase: str, df: dict[str, int], total: int) -> list[tuple[str, int]]:
    """(word, position) of the rarest words that occur once in the phrase."""
    words = phrase.split()
    once = [w for w in words if words.count(w) == 1] or words[:1]
    once.sort(key=lambda w: (df.get(w, 0), words.index(w)))
    rare = [w for w in once if df.get(w, 0) <= COMMON * total] or once[:1]
    return [(w, words.index(w)) for w in rare[:INDEXED_WORDS]]


def _beginnings(word: str, position: int) -> Column:
    """Where a template would begin, by the looked-up places of one of its words."""
    return F.transform(F.filter("hits", lambda h: h["w"] == word), lambda h: h["i"] - F.lit(position))


def _starts(phrase: str, indexed: list[tuple[str, int]]) -> Column:
    """Word positions where the phrase stands, from the looked-up hits."""
    words = phrase.split()
    starts = None
    for word, position in indexed:
        here = _beginnings(word, position)
        starts = here if starts is None else F.array_intersect(starts, here)
    wanted = _literals(words)
    return F.filter(
        starts,
        lambda s: (s >= 0) & (F.slice("words", F.greatest(s + 1, F.lit(1)), F.lit(len(words))) == wanted),
    )


def scan(docs: DataFrame, base=BASE, more=MORE) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score),
    one row per row of ``docs``.

    n_base counts every place of a base phrase, first_word and last_word are the
    smallest and largest of their beginnings (NULL if none); base_labels and
    labels are distinct, sorted and comma-joined (empty if none); score is the
    largest strength of a template found, else 0.  NULL and empty texts have no
    words; a NULL doc_id stays; repeated rows stay repeated; an empty table gives
    an empty result; other columns are ignored.
    """
    templates = [*base, *more]
    df, total = document_frequencies(docs, templates)
    indexed = {phrase: index_words(phrase, df, total) for _, phrase, _ in templates}
    looked_up = _literals(sorted({w for hits in indexed.values() for w, _ in hits}))
    none = "array<struct<w:string,i:int>>"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), words_of(F.col("text")).alias("words"))
    rows = rows.select(
        "doc_id",
        "words",
        F.when(
            F.arrays_overlap("words", looked_up),
            F.filter(
                F.transform("words", lambda w, i: F.struct(w.alias("w"), i.alias("i"))),
                lambda h: F.array_contains(looked_up, h["w"]),
            ),
        )
        .otherwise(F.array().cast(none))
        .alias("hits"),
    )
    places = [F.when(F.size("hits") > 0, _starts(p, indexed[p])).otherwise(F.array().cast("array<int>")).alias(f"t{k}") for k, (_, p, _) in enumerate(templates)]
    rows = rows.select("doc_id", F.size("words").cast("long").alias("n_words"), *places)
    found = lambda k: F.size(f"t{k}") > 0
    names = lambda ks: F.concat_ws(
        ",", F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.when(found(k), F.lit(templates[k][0])) for k in ks]))))
    )
    own, every = range(len(base)), range(len(templates))
    rows = rows.withColumn("places", F.concat(*[F.col(f"t{k}") for k in own]))
    return rows.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"),
        F.array_max("places").cast("long").alias("last_word"),
        names(own).alias("base_labels"),
        names(every).alias("labels"),
        F.greatest(F.lit(0.0), *[F.when(found(k), F.lit(templates[k][2])).otherwise(F.lit(0.0)) for k in every]).alias("score"),
    )


def oracle() -> str:
    """The same result in DuckDB SQL: every phrase tried at every word."""
    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    templates = [*BASE, *MORE]
    longest = max(len(p.split()) for _, p, _ in templates)
    following = ", ".join(f"lead(w, {k}) OVER (PARTITION BY r ORDER BY i) AS w{k}" for k in range(1, longest))
    found = " UNION ALL ".join(
        f"SELECT r, i, '{label}' AS label, {k < len(BASE)} AS base, CAST({strength} AS DOUBLE) AS strength FROM n WHERE "
        + " AND ".join(f"w{j or ''} = '{word}'" for j, word in enumerate(phrase.split()))
        for k, (label, phrase, strength) in enumerate(templates)
    )
    return f"""
      WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                        regexp_extract_all({low}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
      x AS (SELECT r, generate_subscripts(words, 1) - 1 AS i, unnest(words) AS w FROM d),
      n AS (SELECT *, {following} FROM x),
      f AS ({found}),
      g AS (SELECT r, count(*) FILTER (WHERE base) AS n_base, min(i) FILTER (WHERE base) AS first_word,
                   max(i) FILTER (WHERE base) AS last_word,
                   string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels,
                   string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(strength) AS score
            FROM f GROUP BY r)
      SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
             CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
             coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
      FROM d LEFT JOIN g USING (r)"""


__all__ = ["BASE", "MORE", "oracle", "scan"]
