"""Compaction of a partitioned table, planned from the sizes of its files.

The plan packs the files of each date into bins of the target size, largest first;
a date is rewritten only if that saves a large enough share of its files, so a
table that is compact already is left alone.  The files of a bin become one file:
rows are dealt by (date, bin) into as many tasks as there are bins' bytes, which
the plan knows, so no session setting is touched and a date of any size is spread
over its bins.  Rewritten dates go to a new folder, and the catalog is pointed to
them date by date; readers of the old files go on, and dates that fail stay as
they were.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..spec import CLUSTER_COLUMNS
from .tables import TARGET_FILE_BYTES, partition_spec

MIN_SAVED = 0.3  # share of a partition's files that a rewrite must save


def file_sizes(rows: DataFrame, partition: str) -> DataFrame:
    """(partition value, file, bytes) of every file that ``rows`` scans: file
    metadata only, no column is read.  Where ``partition`` is no folder but a column,
    a file counts for each of its values."""
    meta = rows.select(F.col(f"`{partition}`").alias("part"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))
    return meta.groupBy("part", "file").agg(F.max("bytes").alias("bytes"))


def plan(sizes: DataFrame, target: int = TARGET_FILE_BYTES, min_saved: float | None = MIN_SAVED) -> DataFrame:
    """(part, file, bytes, bin, files, bins) of the partitions to rewrite (all, if
    ``min_saved`` is None).

    Files are laid end to end, largest first, and cut every ``target`` bytes; a file
    goes where its middle lies, so no bin holds more than the target and one file,
    and files of about the target stay alone."""
    by = Window.partitionBy("part")
    laid = by.orderBy(F.desc("bytes"), "file").rowsBetween(Window.unboundedPreceding, -1)
    middle = F.coalesce(F.sum("bytes").over(laid), F.lit(0)) + F.col("bytes") / 2
    binned = sizes.withColumn("cut", F.floor(middle / F.lit(target)).cast("int"))
    binned = binned.withColumn("bin", F.dense_rank().over(by.orderBy("cut")) - 1).drop("cut")
    counted = binned.withColumns({"files": F.count("*").over(by), "bins": F.max("bin").over(by) + 1})
    if min_saved is None:
        return counted
    return counted.where((F.col("files") > F.col("bins")) & (F.col("files") - F.col("bins") >= F.lit(min_saved) * F.col("files")))


def rewritten(rows: DataFrame, chosen: DataFrame, partition: str, by=CLUSTER_COLUMNS, target: int = TARGET_FILE_BYTES) -> DataFrame:
    """The rows of the files in ``chosen``, dealt so that each bin is one task's and
    sorted for selective file statistics."""
    total = chosen.agg(F.sum("bytes")).first()[0] or 0  # one number
    bins = chosen.select(F.col("part").alias("_part"), F.col("file").alias("_of"), F.col("bin").alias("_bin"))
    named = rows.withColumn("_file", F.col("_metadata.file_path"))
    met = named.join(bins, (F.col("_file") == F.col("_of")) & F.col(f"`{partition}`").eqNullSafe(F.col("_part")))
    tasks = max(1, -(-total // target))
    dealt = met.repartition(tasks, F.col(f"`{partition}`"), F.col("_bin"))
    keys = [partition, "_bin", *[c for c in by if c in rows.columns]]
    return dealt.sortWithinPartitions(*keys).drop("_file", "_part", "_of", "_bin")


@dataclass(frozen=True)
class Compaction:
    """What a run did: the folder written and the partition values rewritten."""

    path: str | None
    partitions: list


def compact_table(
    spark: SparkSession,
    name: str,
    out_root: str,
    *,
    partition: str = "sale_date",
    by=CLUSTER_COLUMNS,
    target_file_bytes: int = TARGET_FILE_BYTES,
    min_saved: float = MIN_SAVED,
) -> Compaction:
    """Rewrite the wasteful partitions of a registered table into a new folder below
    ``out_root`` and point the catalog to them.

    A table without such partitions is not written to.  The old files are not
    deleted.  Rows appended to a rewritten partition belong in its new folder: write
    them through the table (``insertInto``) or register them as a new location."""
    table = spark.table(name)
    chosen = plan(file_sizes(table, partition), target_file_bytes, min_saved)
    path = f"{out_root.rstrip('/')}/compacted-{uuid.uuid4().hex[:12]}"
    chosen.write.parquet(f"{path}/_plan")  # the choice is made once
    chosen = spark.read.schema(chosen.schema).parquet(f"{path}/_plan")
    values = [r.part for r in chosen.select("part").distinct().orderBy("part").collect()]  # one a rewritten partition
    if not values:
        return Compaction(None, [])
    known = [v for v in values if v is not None]
    hit = F.col(f"`{partition}`").isin(known) if known else F.lit(False)
    rows = table.where(hit | F.col(f"`{partition}`").isNull() if None in values else hit)
    data = rewritten(rows, chosen, partition, by, target_file_bytes)
    data.write.partitionBy(partition).parquet(f"{path}/data")
    for v in values:
        folder = "__HIVE_DEFAULT_PARTITION__" if v is None else v
        spark.sql(
            f"ALTER TABLE IDENTIFIER(:t) {partition_spec([partition], [v])} SET LOCATION '{path}/data/{partition}={folder}'",
            args={"t": name},
        )
    spark.catalog.refreshTable(name)
    return Compaction(path, values)
