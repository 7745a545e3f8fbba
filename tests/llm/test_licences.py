"""Licence scan against brute force on awkward texts."""

import re

from ledgerline.llm import licences

TEXTS = [
    None, "", "...", "Released under the MIT License.", "mit\nlicense MIT-LICENSE mit license license",
    "GNU General Public License, version 3. gnu general public license version 2", "gnu general public licenses",
    "CC BY-NC 4.0; cc by; CC-BY-SA cc by", "cc" * 9, "by cc", "xcc by", "é cc by É Apache License, Version 2.0",
    "apache license apache license", "the of and " * 20000 + "apache license", "Permission is hereby granted, free of charge",
    "Redistribution and use in source and binary forms", "mit Lİcense", "ccby cc\x00by \x7fcc by\x80", "GNU Lesser General Public License",
]


def brute(doc_id, text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places, base, every, score = [], set(), set(), 0.0
    for k, (label, phrase, strength) in enumerate([*licences.BASE, *licences.MORE]):
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i : i + len(p)] == p:
                every.add(label)
                score = max(score, strength)
                if k < len(licences.BASE):
                    base.add(label)
                    places.append(i)
    return (doc_id, len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(every)), score)


def test_scan_equals_brute_force(docs_of):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3]), (None, "mit license")]
    docs = docs_of(rows).selectExpr("*", "1 as words", "2 as hits", "3 as t0", "4 as places")
    got = sorted((tuple(r) for r in licences.scan(docs).collect()), key=str)
    assert got == sorted((brute(*r) for r in rows), key=str)


def test_result_does_not_depend_on_the_indexed_words(docs_of):
    # where "license", "gnu" ... are in every document, other words are indexed
    rows = [(i, "license gnu apache mit by public general version " + (t or "")) for i, t in enumerate(TEXTS)]
    got = sorted(tuple(r) for r in licences.scan(docs_of(rows)).collect())
    assert got == sorted(brute(*r) for r in rows)


def test_index_words_are_the_rarest():
    df = {"gnu": 3, "general": 50, "public": 2, "license": 900}
    assert licences.index_words("gnu general public license", df, 1000) == [("public", 2), ("gnu", 0)]
    assert licences.index_words("license and and license", {"license": 5, "and": 9}, 9) == [("license", 0)]


def test_empty_table(docs_of):
    assert licences.scan(docs_of([]).where("false")).collect() == []
