"""Small helpers shared by the operators."""

from __future__ import annotations

import sys
import types

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back.

    Cuts lineage with a table every executor can reach: a lost executor costs a
    re-read, not a recomputation, and later passes read only their columns.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def ascii_lower(col):
    """Lower-case A-Z only (Spark's ``lower`` also folds accented letters)."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def worker_cache(name: str) -> dict:
    """A dictionary that lives as long as the Python worker process.

    Functions pickled by value get fresh globals in every task; tokenizers and
    their word caches are worth keeping between tasks of one worker.
    """
    mod = sys.modules.setdefault("_ledgerline_worker", types.ModuleType("_ledgerline_worker"))
    return mod.__dict__.setdefault(name, {})
