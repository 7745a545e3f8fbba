"""Incremental file ingest with Structured Streaming.

files arriving in a folder (csv / json / parquet)
  -> file source over *paths* (new files discovered per micro-batch, progress in
     the checkpoint; contents are not read here)
  -> per micro-batch, the batch readers: every file by its own header, footer or
     record names, then the same canonicaliser; other fields by name (``extras``)
  -> a version of the schema log (``schema_log.py``): names and types met so far
  -> the rows, in folders of their own below each date
  -> the commit: one row that names the batch's folders and schema version.

Nothing about columns is fixed at the start.  Readers take committed folders only:
a batch that failed, or runs again, is invisible until its own commit, which takes
the place of an earlier one of the same batch.  The file layout is

    <out>/[sale_date=.../]batch=<id>-<attempt>/part-*.parquet
    <out>/_schema/<id>-<attempt>/        names and types up to this batch
    <out>/_commits/                      (batch_id, attempt, version, at)
"""

from __future__ import annotations

import time
import uuid
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.canonical import canonicalise
from ..sinks.tables import add_columns, add_partitions, conform, drop_partitions, named_partitions
from ..sources.files import NoInput, RECORD_COLUMN, json_path, read_sales
from ..spec import CANONICAL_COLUMNS, CANONICAL_SCHEMA, STREAM_SPEC, CanonicalSpec
from . import schema_log
from .schema_log import EXTRAS

BATCH_COLUMN = "batch"
COMMITS = "_commits"
MAX_FILES_PER_BATCH = 1000  # paths a micro-batch takes; the rest follow in the next ones

_LISTING = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)
_COMMIT = T.StructType(
    [
        T.StructField("batch_id", T.LongType()),
        T.StructField("attempt", T.StringType()),
        T.StructField("partition", T.StringType()),
        T.StructField("at", T.LongType()),
    ]
)


def new_files(spark: SparkSession, path: str, max_files: int = MAX_FILES_PER_BATCH) -> DataFrame:
    """Stream of the paths of files landing under ``path``."""
    return (
        spark.readStream.format("binaryFile").schema(_LISTING).option("maxFilesPerTrigger", max_files).load(path).select("path")
    )


# -------------------------------------------------------------------- reading ---


def _as_text(name: str, kind: T.DataType) -> Column:
    value = F.col(f"`{name}`")
    if isinstance(kind, T.VariantType):
        return F.coalesce(value.try_cast("string"), F.to_json(value))
    return F.to_json(value) if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)) else value.cast("string")


def with_extras(rows: DataFrame) -> DataFrame:
    """Canonical columns, and all others as one map of text by name (no NULLs): as
    wide whatever the input, so layouts of different columns union as they are."""
    rows = conform(rows)
    others = [f for f in rows.schema.fields if f.name not in CANONICAL_COLUMNS]
    pairs = [x for f in others for x in (F.lit(f.name), _as_text(f.name, f.dataType))]
    extras = F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull()) if pairs else F.lit(None)
    return rows.select(*CANONICAL_COLUMNS, extras.cast("map<string,string>").alias(EXTRAS))


def _read_json(spark: SparkSession, paths: list[str], spec: CanonicalSpec, options: dict) -> DataFrame:
    """Records as one VARIANT each: only keys that can feed a canonical field are
    looked for, so a drop of any number of names has a plan of one width."""
    records = spark.read.options(**options).option("singleVariantColumn", RECORD_COLUMN).json(paths)
    fields = F.try_variant_get(RECORD_COLUMN, "$", "map<string,variant>")
    lists = (spec.date, spec.price, spec.quantity, spec.product, spec.category, spec.seller, spec.unit_price, spec.order_id, spec.customer_id)
    aliases = sorted({a for names in lists for a in names})
    keys = records.select(F.explode(F.map_keys(fields)).alias("key")).where(schema_log.normal(F.col("key")).isin(aliases))
    met = [r.key for r in keys.distinct().collect()]  # spellings of a fixed list of names
    spelt = {a: sorted(k for k in met if k.strip().lower() == a) for a in aliases}
    used = {a: [F.try_variant_get(RECORD_COLUMN, json_path(k), "string") for k in keys] for a, keys in spelt.items() if keys}
    raw = records.select(RECORD_COLUMN, *[F.coalesce(*values).alias(a) for a, values in used.items()])

    def has(name):
        return reduce(or_, [F.variant_get(RECORD_COLUMN, json_path(k), "variant").isNotNull() for k in spelt[name]])

    rows = conform(canonicalise(raw, spec, present=has))
    known = F.map_filter(fields, lambda k, v: ~F.is_variant_null(v))
    text = F.transform_values(known, lambda k, v: F.coalesce(F.try_variant_get(v, "$", "string"), F.to_json(v)))
    taken = F.array(*[F.lit(c) for c in CANONICAL_COLUMNS])
    others = F.map_filter(text, lambda k, v: v.isNotNull() & ~F.array_contains(taken, schema_log.normal(k)))
    return rows.select(*CANONICAL_COLUMNS, others.alias(EXTRAS))


def read_drop(
    spark: SparkSession, paths: list[str], fmt: str, spec: CanonicalSpec, schema: T.StructType | None = None, options: dict | None = None, root: str | None = None
) -> DataFrame | None:
    """Canonical rows of some files with all other fields in ``extras``; None if they hold none."""
    options = options or {}
    if schema is not None:
        r = spark.read.options(**options).schema(schema)
        if fmt == "csv":  # a header that does not match raises instead of shifting values
            r = r.option("header", True).option("enforceSchema", False)
        return with_extras(canonicalise(r.format(fmt).load(paths), spec))
    if fmt == "json":
        return _read_json(spark, paths, spec, options)
    try:
        extra = {"roots": [root]} if fmt == "csv" and root else {}
        return read_sales(spark, paths, fmt, spec, shape=with_extras, **options, **extra)
    except NoInput:  # only empty files
        return None


# -------------------------------------------------------------------- commits ---


def commits(spark: SparkSession, output_path: str) -> DataFrame | None:
    """(batch_id, attempt): the one attempt that counts of each batch, the last
    committed; None before the first commit."""
    try:
        log = spark.read.schema(_COMMIT).parquet(f"{output_path.rstrip('/')}/{COMMITS}")
    except AnalysisException:  # no such folder
        return None
    last = Window.partitionBy("batch_id").orderBy(F.desc("at"), F.desc("attempt"))
    return log.withColumn("place", F.row_number().over(last)).where("place = 1").drop("place")


def last_commit(spark: SparkSession, output_path: str, before: int | None = None):
    """The commit (batch_id, attempt, partition, at) of the last batch (below
    ``before``), or None.  Its attempt names the schema version, too."""
    done = commits(spark, output_path)
    if done is None:
        return None
    if before is not None:
        done = done.where(F.col("batch_id") < before)
    return done.orderBy(F.desc("batch_id")).first()


def columns_of(spark: SparkSession, output_path: str) -> list[schema_log.Promoted]:
    """The promoted columns of the sink, with their types as of the last commit."""
    last = last_commit(spark, output_path)
    return schema_log.promoted(schema_log.read_version(spark, output_path, last.attempt), CANONICAL_COLUMNS) if last else []


def _write_batch(output_path: str, fmt: str, spec: CanonicalSpec, schema, partition_by: str | None, options: dict, root: str | None = None):
    out = output_path.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        paths = [r["path"] for r in batch.collect()]  # at most max_files_per_trigger
        rows = read_drop(spark, paths, fmt, spec, schema, options, root) if paths else None
        if rows is None:
            return
        attempt = f"{batch_id:09d}-{uuid.uuid4().hex[:8]}"
        last = last_commit(spark, out, before=batch_id)
        previous = schema_log.read_version(spark, out, last.attempt) if last else schema_log.empty(spark)
        log = schema_log.write_version(previous, schema_log.measured(rows), out, attempt)
        ready = schema_log.split(rows, schema_log.promoted(log, CANONICAL_COLUMNS))
        by = [partition_by] if partition_by and partition_by in CANONICAL_COLUMNS else []
        stored = ready.withColumn(BATCH_COLUMN, F.lit(attempt))
        stored.write.mode("append").partitionBy(*by, BATCH_COLUMN).parquet(out)
        marker = [(batch_id, attempt, by[0] if by else None, time.time_ns())]
        spark.createDataFrame(marker, _COMMIT).coalesce(1).write.mode("append").parquet(f"{out}/{COMMITS}")

    return write


def start_ingest(
    spark: SparkSession,
    source_path: str,
    output_path: str,
    checkpoint_path: str,
    *,
    fmt: str = "csv",
    spec: CanonicalSpec = STREAM_SPEC,
    schema: T.StructType | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = None,
    partition_by: str | None = None,
    options: dict | None = None,
) -> StreamingQuery:
    """Start the ingest stream; the caller owns the returned query.

    A failure between writing a batch and committing it in the checkpoint makes
    the restart write the same files into the same folder again.  An output folder
    belongs to one checkpoint: a new checkpoint starts counting batches anew."""
    files = new_files(spark, source_path, max_files_per_trigger or MAX_FILES_PER_BATCH)
    w = (
        files.writeStream.foreachBatch(_write_batch(output_path, fmt, spec, schema, partition_by, dict(options or {}), source_path))
        .option("checkpointLocation", checkpoint_path)
        .outputMode("append")
    )
    if processing_time:
        w = w.trigger(processingTime=processing_time)
    elif available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def register_after_first_commit(
    spark: SparkSession, query: StreamingQuery, table_name: str, output_path: str, timeout_s: float = 600.0
) -> bool:
    """Register the sink as a table once a batch has been committed (a table over
    an empty folder would fix an empty schema)."""
    deadline = time.time() + timeout_s
    while time.time() < deadline:
        done = not query.isActive
        if last_commit(spark, output_path) is not None:
            return register_sink(spark, table_name, output_path)
        if done:
            return False
        time.sleep(0.5)
    return False


LAST_REGISTERED = "ledgerline.last_commit"


def register_sink(spark: SparkSession, table_name: str, output_path: str) -> bool:
    """Create the table over the sink if it is not there (False: nothing is committed
    yet), then add the folders of the commits made since the last call; uncommitted folders are no partitions of
    it, and those of a batch that was committed again give way to the new ones.

    Only new commits are looked at (their dates come from the folder names), so a
    call costs what they hold.  Promoted columns are text in the table, as stored;
    ``read_sink`` gives them their types."""
    last = last_commit(spark, output_path)
    if last is None:
        return False
    stored, by = _stored_schema(last, columns_of(spark, output_path))
    kept = T.StructType([f for f in stored.fields if f.name not in by] + [stored[c] for c in by])
    if not spark.catalog.tableExists(table_name):
        names = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in kept.fields)
        listed = ", ".join(f"`{c}`" for c in by)
        spark.sql(f"CREATE TABLE IDENTIFIER(:t) ({names}) USING parquet PARTITIONED BY ({listed}) LOCATION '{output_path}'", args={"t": table_name})
    else:
        add_columns(spark, table_name, kept)
    seen = int(_property(spark, table_name, LAST_REGISTERED) or -1)
    log = spark.read.schema(_COMMIT).parquet(f"{output_path.rstrip('/')}/{COMMITS}")
    fresh = log.where(F.col("at") > seen).select("batch_id").distinct()
    rows = log.join(fresh, "batch_id").orderBy("at", "attempt").collect()  # one a new commit, and those it replaces
    counts = {r.batch_id: r.attempt for r in rows}  # the last one of each batch
    stale = [r.attempt for r in rows if r["at"] <= seen and counts[r.batch_id] != r.attempt]
    if stale:
        known = named_partitions(spark, table_name, by)
        drop_partitions(spark, table_name, by, [p for p in known if p[-1] in stale])
    new = [a for a in counts.values() if a not in stale]
    if new:
        own = _stored(spark, output_path, stored).where(F.col(BATCH_COLUMN).isin(new)).select(*by).distinct()
        add_partitions(spark, table_name, by, [tuple(r) for r in own.collect()])  # one a new folder
        spark.sql(f"ALTER TABLE IDENTIFIER(:t) SET TBLPROPERTIES ('{LAST_REGISTERED}' = '{max(r['at'] for r in rows)}')", args={"t": table_name})
    spark.catalog.refreshTable(table_name)
    return True


def _property(spark: SparkSession, table_name: str, key: str) -> str | None:
    rows = spark.sql("SHOW TBLPROPERTIES IDENTIFIER(:t)", args={"t": table_name}).where(F.col("key") == key).collect()
    return rows[0]["value"] if rows else None


def run_available(spark: SparkSession, source_path: str, output_path: str, checkpoint_path: str, **kw) -> DataFrame:
    """Process every file present now (``availableNow``), then return the sink."""
    q = start_ingest(spark, source_path, output_path, checkpoint_path, available_now=True, **kw)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return read_sink(spark, output_path)


def _stored_schema(last, columns: list[schema_log.Promoted]) -> tuple[T.StructType, list[str]]:
    """The sink's columns as stored, from its logs alone (no footer is read), and its
    partition columns, dates first."""
    by = [*([last.partition] if last.partition else []), BATCH_COLUMN]
    fields = [*CANONICAL_SCHEMA.fields, *[T.StructField(p.name, T.StringType()) for p in columns]]
    return T.StructType([*fields, T.StructField(EXTRAS, T.VariantType()), T.StructField(BATCH_COLUMN, T.StringType())]), by


def _stored(spark: SparkSession, output_path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(output_path)


def read_sink(spark: SparkSession, output_path: str) -> DataFrame:
    """Rows of all committed batches: the canonical columns, the promoted ones in the
    type all their values have, and the remaining fields as a map of text.

    What is read is settled when this is called: a batch that runs again writes
    folders of its own, so its rows are seen once."""
    last = last_commit(spark, output_path)
    if last is None:
        return spark.createDataFrame([], T.StructType([*CANONICAL_SCHEMA.fields, T.StructField(EXTRAS, T.MapType(T.StringType(), T.StringType()))]))
    columns = columns_of(spark, output_path)
    schema, _ = _stored_schema(last, columns)
    attempts = [r.attempt for r in commits(spark, output_path).select("attempt").collect()]  # one a batch; prunes folders
    rows = _stored(spark, output_path, schema).where(F.col(BATCH_COLUMN).isin(attempts)).drop(BATCH_COLUMN)
    return schema_log.typed(rows, columns)
