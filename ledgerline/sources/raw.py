"""Inspection helpers over a raw input: schema preview, detected columns and a
per-file manifest.  All run as Spark jobs; nothing but the (small) result rows
reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.resolve import resolve
from ..spec import BATCH_SPEC, CanonicalSpec


def _rows_from_structs(df: DataFrame, structs) -> DataFrame:
    return df.select(F.inline(F.array(*structs)))


def schema_preview(df: DataFrame, fraction: float | None = None) -> DataFrame:
    """One row per column: position, name, type, number of NULLs and smallest value
    (as text).  One partial and one final aggregation over the whole input, or over
    a random ``fraction`` of it, taken inside each task."""
    aggs = []
    for i, f in enumerate(df.schema.fields):
        c = F.col(f"`{f.name}`")
        aggs.append((F.count(F.lit(1)) - F.count(c)).alias(f"n{i}"))
        aggs.append(F.min(c.cast("string")).alias(f"s{i}"))
    stats = (df if fraction is None else df.sample(fraction)).agg(*aggs)
    structs = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col(f"n{i}").alias("nulls"),
            F.col(f"s{i}").alias("smallest"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return _rows_from_structs(stats, structs)


def detected_columns(df: DataFrame, spec: CanonicalSpec = BATCH_SPEC) -> DataFrame:
    """Which raw column feeds each canonical field, and how many of its values
    are non-NULL over the whole input (one aggregation pass)."""
    res = resolve(df.columns, spec)
    pairs = res.as_rows()
    aggs = [F.count(F.col(f"`{m}`")).alias(f"c{i}") for i, (_, m) in enumerate(pairs) if m is not None]
    counts = df.agg(*aggs) if aggs else df.agg(F.count(F.lit(1)).alias("_n"))
    structs = [
        F.struct(
            F.lit(canon).alias("canonical"),
            F.lit(m).cast("string").alias("matched_column"),
            (F.col(f"c{i}") if m is not None else F.lit(None).cast("long")).alias("non_null_rows"),
        )
        for i, (canon, m) in enumerate(pairs)
    ]
    return _rows_from_structs(counts, structs)


def source_manifest(df: DataFrame) -> DataFrame:
    """Rows and bytes per input file, from the file-source ``_metadata`` column."""
    return (
        df.select("_metadata.file_name", "_metadata.file_path", "_metadata.file_size")
        .groupBy("file_path", "file_name")
        .agg(F.count(F.lit(1)).alias("rows"), F.max("file_size").alias("bytes"))
    )
