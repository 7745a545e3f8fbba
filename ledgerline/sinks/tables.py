"""Publishing the canonical table and its marts; registration; physical layout.

Parquet is the default format (no table-format package is assumed); the format
stays a parameter.  Without a transaction log, two rules keep readers safe:
a rewrite (clustering, compaction) always goes to a *new* path, and a batch
append and a streaming sink never share a directory (the stream's
``_spark_metadata`` log would hide batch files).
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.resolve import first_existing
from ..spec import CANONICAL_SCHEMA, CLUSTER_COLUMNS, DEFAULT_PARTITION_COLUMN

TARGET_FILE_BYTES = 256 * 1024 * 1024
STATEMENT_PARTITIONS = 500  # partitions named in one statement
LEAST_SHARES = 1000  # hash shares that the dates of a clustered write are dealt to


class Published(list):
    """The partition columns of a write, with what it wrote: ``schema``, and
    ``partitions``, the distinct values of the partition columns (a tuple each),
    with the number of ``rows`` in them, all known from the write itself, without
    looking at the table."""

    def __init__(self, columns, schema: T.StructType, partitions: list[tuple], rows: int = 0):
        super().__init__(columns)
        self.schema, self.partitions, self.rows = schema, partitions, rows


KEY = "_key_"


class Late(NamedTuple):
    """Rows of which some columns follow from others: ``finish(rows)`` has them all.
    In a clustered write only ``rows`` pass the shuffle, with the partition columns
    under ``KEY`` and their name, which ``finish`` leaves out."""

    rows: DataFrame
    finish: Callable[[DataFrame], DataFrame]


def partition_columns(df: DataFrame, partition_by) -> list[str]:
    """Partition only by requested columns that exist (empty/None -> none)."""
    names = [partition_by] if isinstance(partition_by, str) else partition_by or []
    found = (first_existing((n,), df.columns) for n in names if n)
    return [c for c in found if c is not None]


def conform(df: DataFrame) -> DataFrame:
    """Cast canonical columns to the fixed canonical types so appends from inputs
    with differently inferred types (INT vs BIGINT quantities) stay mergeable."""
    types = {f.name: f.dataType for f in CANONICAL_SCHEMA.fields}
    return df.select(
        *[
            F.col(f"`{c}`").cast(types[c]).alias(c) if c in types and df.schema[c].dataType != types[c] else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def publish(
    df: DataFrame | Late | list[DataFrame | Late],
    path: str,
    *,
    overwrite: bool = False,
    partition_by=DEFAULT_PARTITION_COLUMN,
    fmt: str = "parquet",
    layout: str = "clustered",
    num_partitions: int | None = None,
    max_records_per_file: int | None = 5_000_000,
    codec: str | None = None,
) -> Published:
    """Write the canonical table: append (default) or full overwrite (schema
    replaced), partitioned by ``partition_by`` when that column exists.

    ``layout="clustered"`` (default) rebalances on the partition column and
    sorts by (partition column, seller, product) inside each task -- one
    shuffle that yields few files per date (hot dates split across tasks) and
    the seller/product clustering in the same pass, instead of a narrow write
    followed by a full rewrite.  ``layout="as_is"`` is the narrow write: no
    shuffle, but each task writes one file per date it holds, which explodes
    into small files when input files are not ordered by time.
    Returns the partition columns used and the partitions written, which are
    gathered while the rows pass by.

    Several frames of one schema are written one after the other (``in_turn``).
    ``codec``: compression of the files (None: the session's).
    """
    if isinstance(df, list):
        how = dict(partition_by=partition_by, fmt=fmt, layout=layout, num_partitions=num_partitions, max_records_per_file=max_records_per_file, codec=codec)
        return in_turn(df, path, overwrite, how)
    finish = (lambda rows: conform(df.finish(rows))) if isinstance(df, Late) else None
    data = conform(df) if finish is None else finish(df.rows)
    schema, cols = data.schema, partition_columns(data, partition_by)
    keys = cols
    if finish is not None and layout == "clustered" and cols and {KEY + c for c in cols} <= {*df.rows.columns}:
        data, keys = df.rows, [KEY + c for c in cols]
    met = Observation()
    if cols:
        found = F.collect_set(F.struct(*[F.col(f"`{c}`") for c in keys]))
        data = data.observe(met, found.alias("partitions"), F.count(F.lit(1)).alias("rows"))
    if layout == "clustered":
        data = clustered(data, cols, CLUSTER_COLUMNS, num_partitions, keys, finish if keys != cols else None)
    elif layout != "as_is":
        raise ValueError(f"unknown layout {layout!r}")
    w = data.write.mode("overwrite" if overwrite else "append").format(fmt)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if codec:
        w = w.option("compression", codec)
    if cols:
        w = w.partitionBy(*cols)
    w.save(path)
    partitions, rows = _observed(met) if cols else ([], 0)
    return Published(cols, schema, sorted(partitions, key=str), rows)


def in_turn(parts: list[DataFrame | Late], path: str, overwrite: bool, how: dict) -> Published:
    """Publish ``parts`` one after the other, so that the disk holds the shuffle of
    one of them at a time (in ``session.shuffles_dropped``).  An overwrite that fails
    leaves an empty folder, as it does in one piece; appended parts are appends of
    their own, of which those done stay."""
    done: list[Published] = []
    try:
        for part in parts:
            done.append(publish(part, path, overwrite=overwrite and not done, **how))
    except BaseException:
        if overwrite and done:
            empty_folder(SparkSession.active(), path)
        raise
    partitions = sorted({p for written in done for p in written.partitions}, key=str)
    return Published(done[0], done[0].schema, partitions, sum(written.rows for written in done))


def empty_folder(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.delete(folder, True)
    files.mkdirs(folder)


def _observed(met: Observation) -> tuple[list[tuple], int]:
    try:
        return [tuple(p) for p in met.get["partitions"]], met.get["rows"]
    except Py4JJavaError:  # adaptive execution leaves nothing to observe of a plan without rows
        return [], 0


def add_columns(spark: SparkSession, name: str, schema: T.StructType) -> None:
    """Add the columns of ``schema`` that the table does not have."""
    known = {c.name.lower() for c in spark.catalog.listColumns(name)}
    new = [f for f in schema.fields if f.name.lower() not in known]
    if new:
        listed = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE IDENTIFIER(:t) ADD COLUMNS ({listed})", args={"t": name})


def partition_spec(columns, values) -> str:
    def literal(v):
        return "null" if v is None else "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"

    return "PARTITION (" + ", ".join(f"`{c}` = {literal(v)}" for c, v in zip(columns, values)) + ")"


def add_partitions(spark: SparkSession, name: str, columns, values: list[tuple]) -> None:
    """Name these partitions to the catalog; the table's others are not looked at."""
    for at in range(0, len(values), STATEMENT_PARTITIONS):
        specs = " ".join(partition_spec(columns, v) for v in values[at : at + STATEMENT_PARTITIONS])
        spark.sql(f"ALTER TABLE IDENTIFIER(:t) ADD IF NOT EXISTS {specs}", args={"t": name})


def drop_partitions(spark: SparkSession, name: str, columns, values: list[tuple]) -> None:
    """Take these partitions out of the catalog; an external table's files stay."""
    for at in range(0, len(values), STATEMENT_PARTITIONS):
        specs = ", ".join(partition_spec(columns, v) for v in values[at : at + STATEMENT_PARTITIONS])
        spark.sql(f"ALTER TABLE IDENTIFIER(:t) DROP IF EXISTS {specs}", args={"t": name})


NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def named_partitions(spark: SparkSession, name: str, columns) -> list[tuple]:
    """Values, as text, of the partitions that the catalog has of a table."""
    rows = spark.sql("SHOW PARTITIONS IDENTIFIER(:t)", args={"t": name}).collect()
    specs = [dict(part.split("=", 1) for part in r["partition"].split("/")) for r in rows]
    return [tuple(None if s[c] == NO_VALUE else unquote(s[c]) for c in columns) for s in specs]


def _drop_others(spark: SparkSession, name: str, columns, values: list[tuple]) -> None:
    kept = {tuple(None if v is None else str(v) for v in p) for p in values}
    drop_partitions(spark, name, columns, [p for p in named_partitions(spark, name, columns) if p not in kept])


def register_table(
    spark: SparkSession,
    name: str,
    path: str,
    fmt: str = "parquet",
    partitioned: bool = True,
    written: Published | None = None,
    replaced: bool = False,
) -> None:
    """Idempotent external-table registration; adds partitions and columns written
    since.

    A partitioned file-source table only sees partitions in the catalog.  Given
    ``written``, what the last ``publish`` returned, its partitions and columns are
    added, at a cost that follows the write and not the table; without it all
    partitions are recovered and all footers read.  ``replaced``: the write was all
    of the table, so other partitions leave the catalog."""
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=path, source=fmt)  # external table over path
        written = None  # whatever the folder held before is part of the table
    columns = [c for c in spark.catalog.listColumns(name) if c.isPartition]
    if written is not None:
        add_columns(spark, name, written.schema)
        if columns and partitioned:
            if replaced:
                _drop_others(spark, name, list(written), written.partitions)
            add_partitions(spark, name, list(written), written.partitions)
    else:
        add_columns(spark, name, spark.read.option("mergeSchema", True).format(fmt).load(path).schema)
        if columns and partitioned:
            spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)


def write_mart(df: DataFrame, root: str, name: str, fmt: str = "parquet") -> str:
    """Overwrite one aggregate mart under ``root/name`` (``fmt``: parquet or csv
    with a header row).  Marts live under their own root, never inside the fact
    table's directory, so a raw read of the table cannot pick them up."""
    path = f"{root.rstrip('/')}/{name}"
    w = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    w.save(path)
    return path


def clustered(
    df: DataFrame, partition_cols: list[str], by=CLUSTER_COLUMNS, num_partitions: int | None = None, dealt_by: list[str] | None = None, finish=None
) -> DataFrame:
    """Lay rows out for a partitioned write: a REBALANCE on the partition
    columns, then a sort on (partition columns, *by) inside each task.

    REBALANCE is planned by AQE from runtime sizes: partitions of small dates
    are coalesced towards the advisory size and a hot date is split over
    several tasks -- no sampling pass over the input (a range repartition would
    read the input twice) and no task that has to hold a third of the rows.
    Each date lands in few files, and the sort makes Parquet min/max statistics
    on seller/product selective (the point-lookup goal of Z-ordering).

    A share that is split gives each of its tasks all of its dates, so a share must
    hold few dates: there are at least ``LEAST_SHARES``, whatever the number of
    shuffle partitions, and AQE puts small ones together again.

    ``dealt_by``: the columns of the REBALANCE where ``finish`` gives the rows their
    partition columns after it (see ``Late``)."""
    if num_partitions is None and partition_cols:
        conf = df.sparkSession.conf
        if conf.get("spark.sql.adaptive.enabled") == "true" and conf.get("spark.sql.adaptive.coalescePartitions.enabled") == "true":
            num_partitions = max(LEAST_SHARES, int(conf.get("spark.sql.shuffle.partitions")))
    args: list = ([int(num_partitions)] if num_partitions else []) + list(dealt_by or partition_cols)
    laid = df.hint("rebalance", *args) if args else df.hint("rebalance")
    if finish is not None:
        laid = finish(laid)
    keys = list(partition_cols) + [c for c in by if c in laid.columns]
    return laid.sortWithinPartitions(*keys) if keys else laid


def cluster(
    df: DataFrame,
    path: str,
    *,
    by=CLUSTER_COLUMNS,
    partition_by=DEFAULT_PARTITION_COLUMN,
    num_partitions: int | None = None,
    fmt: str = "parquet",
) -> str:
    """Rewrite ``df`` into ``path`` with the clustered layout (see ``clustered``)."""
    pcols = partition_columns(df, partition_by)
    w = clustered(df, pcols, by, num_partitions).write.mode("overwrite").format(fmt)
    if pcols:
        w = w.partitionBy(*pcols)
    w.save(path)
    return path


def compact(
    spark: SparkSession,
    path: str,
    out_path: str,
    *,
    partition_by=DEFAULT_PARTITION_COLUMN,
    by=CLUSTER_COLUMNS,
    target_file_bytes: int = TARGET_FILE_BYTES,
    dates: tuple[str, str] | None = None,
    fmt: str = "parquet",
) -> str:
    """Rewrite ``path`` into files of about ``target_file_bytes`` at ``out_path``
    (the input is never overwritten in place).

    Each date's files are packed into bins of that size (``compaction.plan``), and
    the number of tasks follows from their bytes; no session setting is touched, so
    runs do not disturb each other.  ``dates`` (first, last) restricts the rewrite to
    a range of the partition column.  A registered table is better compacted by
    ``compaction.compact_table``, which leaves compact dates alone."""
    from .compaction import file_sizes, plan, rewritten

    df = spark.read.option("mergeSchema", True).format(fmt).load(path)
    cols = partition_columns(df, partition_by)
    if dates is not None:
        df = df.where(F.col(cols[0]).between(*[F.lit(d).cast("date") for d in dates]))
    if not cols:
        return cluster(df, out_path, by=by, partition_by=partition_by, fmt=fmt)
    everything = plan(file_sizes(df, cols[0]), target_file_bytes, min_saved=None)
    rewritten(df, everything, cols[0], by, target_file_bytes).write.mode("overwrite").format(fmt).partitionBy(*cols).save(out_path)
    return out_path
