"""Registered queries against their SQL twins, the pipeline stage by stage, and
guards over the sources."""

import math
import os
import pathlib
import re
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_mod
import corpus_pipeline
from ledgerline.llm import langid, mixing, quality, simhash
from ledgerline.llm.queries import ORACLE, QUERIES
from ledgerline.sources.driver import TABLES

from ..conftest import SF_SMALL
from .test_simhash import brute_components, brute_fingerprint

SRC = pathlib.Path(__file__).resolve().parents[2] / "ledgerline" / "llm"


def test_all_are_registered():
    names = [n for n in entry_mod.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry_mod.queries() and set(ORACLE) <= set(entry_mod.oracle_sql())


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_equals_sql(spark, key):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t)}.parquet')")
    df = QUERIES[key](spark, SF_SMALL)
    rel = con.sql(ORACLE[key])
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    got = sorted(repr(tuple(r[c] for c in cols)) for r in df.collect())
    want = sorted(repr(tuple(dict(zip(rel.columns, r))[c] for c in cols)) for r in rel.fetchall())
    assert got == want


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["language", "quality", "near duplicates", "mixing", "packing"]

    a = steps["language"](spark, docs, SF_SMALL).cache()
    ok = {r.doc_id for r in langid.identify(docs).collect() if r.lang_pred != "und" and r.score >= langid.MIN_SCORE}
    assert a.columns == docs.columns and {r.doc_id for r in a.collect()} == ok

    b = steps["quality"](spark, a, SF_SMALL).cache()
    assert {r.doc_id for r in b.collect()} == {r.doc_id for r in quality.classify(a).collect() if r.keep}

    c = steps["near duplicates"](spark, b, SF_SMALL).cache()
    fps = {r.doc_id: brute_fingerprint(r.text) for r in b.collect()}
    comp = brute_components(set(fps.values()), simhash.MAX_BITS)
    low = {}
    for i, f in fps.items():
        low[comp[f]] = min(low.get(comp[f], i), i)
    assert sorted(r.doc_id for r in c.collect()) == sorted(low.values())

    d = steps["mixing"](spark, c, SF_SMALL).cache()
    rate = {r.doc_id: r.rate for r in mixing.rates(c, mixing.domains(spark.read.parquet(f"{SF_SMALL}/labels.parquet")), corpus_pipeline.TARGETS).collect()}
    drawn = Counter(r.doc_id for r in d.collect())
    assert d.columns == docs.columns and max(rate.values()) < 2  # no document is multiplied
    assert all(drawn[i] in (math.floor(x), math.floor(x) + 1) for i, x in rate.items()) and set(drawn) <= set(rate)

    e = steps["packing"](spark, d, SF_SMALL).collect()
    total = {}
    for r in e:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
    assert total == {i: n * next(r.doc_tokens for r in e if r.doc_id == i) for i, n in drawn.items() if n}

    assert sorted({r.doc_id for r in corpus_pipeline.run(spark, SF_SMALL).collect()}) == sorted(total)


def test_pipeline_stages_take_an_empty_table(spark, docs_of):
    empty = docs_of([]).where("false")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_SMALL).collect() == [], name


def test_guards():
    banned = {"localCheckpoint": r"localCheckpoint", "cross join": r"crossJoin|\"cross\"", "RDD": r"\.rdd\b", "temp folder": r"tempfile|/tmp", "toPandas": r"toPandas\("}
    native = {"Python in a native operator": r"mapIn|applyIn|udf|pandas|numpy|pyarrow"}
    for path in [*SRC.glob("*.py"), SRC.parents[1] / "corpus_pipeline.py"]:
        rules = banned | (native if path.stem in ("mixing", "licences") else {})
        code = re.sub(r'"""[\s\S]*?"""|#.*', "", path.read_text())
        assert [n for n, p in rules.items() if re.search(p, code)] == [], path
        assert "ImportError" not in code and "ModuleNotFoundError" not in code
