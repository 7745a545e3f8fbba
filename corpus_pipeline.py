"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run``
writes as Parquet under the shared checkpoint folder and rereads as the next
stage's ``docs``.  All stages but the last return the columns of documents.
"""

from __future__ import annotations

from ledgerline.llm import langid, mixing, packing, quality, simhash
from ledgerline.llm.common import read, saved


def language(spark, docs, sf_dir):
    """Documents whose language is recognised.

    NULL and empty texts and texts without a letter go; a very long text is judged
    whole; repeated rows stay repeated, NULL ids and other columns as they are; an
    empty table stays empty.
    """
    return langid.accepted(docs)


def good_quality(spark, docs, sf_dir):
    """Documents the quality scorer keeps.

    NULL, empty and white-space texts go; everything else as in ``language``.
    """
    return quality.kept(docs)


def near_duplicates(spark, docs, sf_dir):
    """One document of each group of near-duplicates, the one with the smallest doc_id.

    Of repeated rows one stays; texts that share a doc_id but are no near-duplicates
    all stay; rows without a doc_id cannot be named by a group and all stay; empty
    texts are near-duplicates of one another.
    """
    return simhash.deduplicated(docs)


TARGETS = mixing.TARGETS


def domain_mix(spark, docs, sf_dir):
    """Documents drawn at rates that bring the domains to their target weights.

    At most ``mixing.MAX_RATE`` copies of a document; NULL and empty texts carry no
    tokens and are drawn by their posteriors; repeated rows are drawn alike; columns
    of any name are kept; without labels every document stays once.
    """
    return mixing.mixed(docs, mixing.domains(read(spark, sf_dir, "labels")), TARGETS)


def pack(spark, docs, sf_dir):
    """Pieces of packed sequences with their token ids.

    NULL and empty texts are the end id alone; a text longer than a sequence is cut.
    """
    return packing.packed(docs, with_ids=True)


STAGES = [
    ("language", language),
    ("quality", good_quality),
    ("near duplicates", near_duplicates),
    ("mixing", domain_mix),
    ("packing", pack),
]

# Trained models, iterated rates and a tokenizer: not SQL.  The stages are tested
# against brute-force versions.
ORACLE_SQL = None


def run(spark, sf_dir):
    out = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = saved(stage(spark, out, sf_dir), name.replace(" ", "-"))
    return out
