"""Static guards over the library source: the execution rules the design relies on."""

import pathlib
import re

SRC = pathlib.Path(__file__).resolve().parent.parent / "ledgerline"


def _sources():
    """The library proper; the training-data subpackage has guards of its own."""
    return [p for p in SRC.rglob("*.py") if "llm" not in p.relative_to(SRC).parts]

# Driver-side actions allowed, each returning metadata-sized results only:
ALLOWED_ACTIONS = {
    ("streaming/ingest.py", "collect"),  # the paths of one micro-batch (bounded by max_files_per_trigger)
    ("sources/files.py", "collect"),  # file paths, and distinct header lines with theirs
}


def _code_lines(path):
    for i, line in enumerate(path.read_text().splitlines(), 1):
        code = line.split("#", 1)[0]
        if code.strip():
            yield i, code


def test_no_banned_constructs():
    banned = {
        "localCheckpoint": r"localCheckpoint",
        "cross join": r"crossJoin|how=\"cross\"|, \"cross\"\)",
        "Python UDF": r"\budf\(|pandas_udf|@F\.udf|\.udf\.register",
        "toPandas": r"toPandas\(",
        "broadcast hint": r"F\.broadcast\(|\bbroadcast\(|hint\(\"broadcast",
        "RDD API": r"\.rdd\.(?!getNumPartitions)",
    }
    hits = []
    for path in _sources():
        for i, code in _code_lines(path):
            for name, pat in banned.items():
                if re.search(pat, code):
                    hits.append(f"{path.relative_to(SRC)}:{i}: {name}")
    assert hits == []


def test_driver_actions_only_where_results_are_metadata_sized():
    found = set()
    for path in _sources():
        for _, code in _code_lines(path):
            for action in ("collect", "first", "take", "head", "toLocalIterator"):
                if re.search(rf"\.{action}\(", code):
                    found.add((str(path.relative_to(SRC)), action))
    assert found <= ALLOWED_ACTIONS, found - ALLOWED_ACTIONS


def test_nothing_outside_imports_the_training_data_subpackage():
    hits = [str(p) for p in _sources() if re.search(r"\bllm\b", p.read_text())]
    assert hits == []
