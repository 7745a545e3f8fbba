"""The registered queries of this subpackage and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import bpe, hamming, imatch, langid, licences, merkle, mixing, negatives, packing, quality, simhash, warc, wavelet
from .common import read


def op1_simhash_near_dedup(spark, sf_dir):
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op2_language_id(spark, sf_dir):
    return langid.identify(read(spark, sf_dir, "documents"))


def op3_wavelet_tokens(spark, sf_dir):
    return wavelet.round_trip(read(spark, sf_dir, "documents"))


def op7_packing(spark, sf_dir):
    return packing.packed(read(spark, sf_dir, "documents"))


def op4_quality_classifier(spark, sf_dir):
    return quality.classify(read(spark, sf_dir, "documents"))


def op9_licence_scan(spark, sf_dir):
    return licences.scan(read(spark, sf_dir, "documents"))


def op6_imatch_fingerprints(spark, sf_dir):
    return imatch.edit_report(read(spark, sf_dir, "documents"))


def op10_hamming_top_k(spark, sf_dir):
    """Queries: every row whose id is divisible by 50, against all rows."""
    vectors = read(spark, sf_dir, "embeddings")
    return hamming.top_k(vectors, vectors.where("vec_id % 50 = 0"))


def op5_mixing(spark, sf_dir):
    """Every document's rate; repeated rows of one document are one row."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    return mixing.rates(docs, mixing.domains(labels))


def op8_warc_archive(spark, sf_dir):
    index = warc.archive(read(spark, sf_dir, "pages"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_hard_negatives(spark, sf_dir):
    """Anchors: every row whose id is divisible by 50; ids divisible by 7 carry the next label."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = negatives.quantised(read(spark, sf_dir, "embeddings"), label)
    return negatives.mine(rows, F.col("id") % 50 == 0)


def op12_merkle_manifest(spark, sf_dir):
    return merkle.Manifest(read(spark, sf_dir, "documents")).verify()


def op13_byte_bpe(spark, sf_dir):
    return bpe.round_trip(read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_language_id": op2_language_id,
    "op3_wavelet_tokens": op3_wavelet_tokens,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_mixing": op5_mixing,
    "op6_imatch_fingerprints": op6_imatch_fingerprints,
    "op7_packing": op7_packing,
    "op8_warc_archive": op8_warc_archive,
    "op9_licence_scan": op9_licence_scan,
    "op10_hamming_top_k": op10_hamming_top_k,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_byte_bpe": op13_byte_bpe,
}

ORACLE: dict[str, str] = {
    "op8_warc_archive": warc.oracle(),
    "op9_licence_scan": licences.oracle(),
    "op10_hamming_top_k": hamming.oracle(),
    "op11_hard_negatives": negatives.oracle(),
}
