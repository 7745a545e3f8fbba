"""Batch ingest job: raw files -> canonical table -> catalog -> aggregate marts.

    read (per-layout CSV, or JSON/Parquet)   one scan of the raw input
    -> canonicalise                          one projection, no UDF
    -> publish (partitioned, clustered)      one shuffle, the only pass over raw data;
                                             an overwrite takes large layouts in turn
    -> register + recover partitions
    -> states of the dates just written, computed from the *published* table
       (column-pruned Parquet; the raw files and the other dates are not read)
    -> marts finished from the states (``operators/mart_states.py``), written
       under their own root

Parameters replace the notebook widgets; nothing is printed -- the job returns
what it did (paths, partition columns, detected columns, schema preview).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.resolve import resolve
from ..operators import mart_states, marts
from ..operators.canonical import canonical_columns, canonicalise
from ..session import shuffles_dropped
from ..sinks.tables import KEY, Late, publish, register_table, write_mart
from ..sinks.versions import replace_table
from ..sources.files import conformed, csv_layouts, layout_passes, read_csv_layout, read_raw, read_raw_by_header, read_sales, read_sales_csv
from ..sources.raw import detected_columns, schema_preview
from ..spec import BATCH_SPEC, CANONICAL_COLUMNS, CANONICAL_SCHEMA, DEFAULT_PARTITION_COLUMN, CanonicalSpec

# What the marts read: their columns are never looked up in file footers.
MART_COLUMNS = [f for f in CANONICAL_SCHEMA.fields if f.name in ("order_id", "total_price", "quantity", "product_id_canon", "category_canon", "sale_date")]

STATE_ROWS, STATE_RUNS = 1_000_000, 6  # rows that a run of months has at least, and runs at most, when all states are made


@dataclass
class IngestResult:
    table_path: str
    table_name: str | None
    partition_columns: list[str]
    marts: dict[str, str] = field(default_factory=dict)
    preview: DataFrame | None = None
    detected: DataFrame | None = None
    table: DataFrame | None = None  # the published table as read back (listed once)


def refresh_states(spark: SparkSession, table: DataFrame | str, written, states: str, whole: bool = False) -> None:
    """Bring the states up to date with what ``publish`` wrote to ``table`` (or its path).

    States of a table that had rows before its first refresh are made for all dates."""
    rows = spark.read.schema(T.StructType([*MART_COLUMNS])).parquet(table) if isinstance(table, str) else table
    try:
        mart_states.read_state(spark, states, "categories").schema  # noqa: B018 - written last: all three are there
    except AnalysisException:
        whole = True
    dates = [p[0] for p in written.partitions]
    if whole:
        mart_states.refresh(rows, states, cuts=mart_states.month_cuts(dates, min(STATE_RUNS, 1 + written.rows // STATE_ROWS)))
    else:
        mart_states.refresh(rows, states, dates)


def run(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    marts_root: str,
    *,
    table_name: str | None = "default.sales_canonical",
    input_format: str = "csv",
    partition_by: str | None = DEFAULT_PARTITION_COLUMN,
    preview_fraction: float | None = None,
    overwrite: bool = False,
    layout: str = "clustered",
    spec: CanonicalSpec = BATCH_SPEC,
    required=("order_id",),
    mart_format: str = "parquet",
    atomic: bool = False,
    codec: str = "zstd",
) -> IngestResult:
    """Run the job; ``atomic`` (with ``overwrite`` and a ``table_name``) replaces the
    table as one step: the rows go to a new folder below ``output_path`` and the
    name, a view, is pointed to them at the end (``sinks/versions.py``).  ``codec``:
    compression of the table's files."""
    with shuffles_dropped(spark):
        return _run(
            spark, input_path, output_path, marts_root, table_name, input_format, partition_by, preview_fraction,
            overwrite, layout, spec, required, mart_format, atomic, codec,
        )


def _parts(spark: SparkSession, path: str, layouts, canonical: DataFrame, spec: CanonicalSpec, in_turn: bool):
    """The rows of ``canonical`` for ``publish``, large layouts by themselves."""
    # where only the dates of one write are replaced, all dates must be in it
    in_turn = in_turn and spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    groups = layout_passes(spark, path, layouts) if in_turn else [layouts]
    if len(groups) == 1 < len(layouts):
        return canonical
    parts = [
        _late(read_csv_layout(spark, *g[0], roots=[path] if isinstance(path, str) else path), spec, canonical.schema)
        if len(g) == 1
        else conformed(read_sales_csv(spark, path, spec, layouts=g), canonical.schema)
        for g in groups
    ]
    return parts if len(parts) > 1 else parts[0]


def _late(raw: DataFrame, spec: CanonicalSpec, schema: T.StructType) -> Late:
    """Canonical rows of one layout, of which the raw columns and the date pass the shuffle."""
    date = dict(zip(CANONICAL_COLUMNS, canonical_columns(raw, resolve(raw.columns, spec), spec)))[mart_states.DATE]
    key = KEY + mart_states.DATE
    return Late(raw.select("*", date.alias(key)), lambda rows: conformed(canonicalise(rows.drop(key), spec), schema))


def _run(
    spark, input_path, output_path, marts_root, table_name, input_format, partition_by, preview_fraction,
    overwrite, layout, spec, required, mart_format, atomic, codec,
) -> IngestResult:
    if input_format == "csv":
        layouts = csv_layouts(spark, input_path)  # one header probe serves both reads
        raw = read_raw_by_header(spark, input_path, layouts=layouts)
        canonical = read_sales_csv(spark, input_path, spec, required=required, layouts=layouts)
        # an append stays one job, so that one that fails leaves nothing
        canonical = _parts(spark, input_path, layouts, canonical, spec, in_turn=overwrite)
    else:
        raw = read_raw(spark, input_path, input_format)
        canonical = read_sales(spark, input_path, input_format, spec, required=required)
    path = output_path
    if atomic:
        if not (overwrite and table_name):
            raise ValueError("atomic is for overwriting a named table")
        version = replace_table(spark, table_name, output_path, canonical, partition_by=partition_by, layout=layout, codec=codec)
        path, cols = version.path, version.written
    else:
        cols = publish(canonical, output_path, overwrite=overwrite, partition_by=partition_by, layout=layout, codec=codec)
        if table_name:
            register_table(spark, table_name, output_path, partitioned=bool(cols), written=cols, replaced=overwrite)

    # through the catalog, neither folders nor footers of older dates are looked at
    if table_name:
        table = spark.table(table_name)
    elif overwrite:  # all there is was just written
        table = spark.read.schema(cols.schema).parquet(path)
    else:
        table = spark.read.option("mergeSchema", True).parquet(path)
    if cols == [mart_states.DATE]:
        states = f"{marts_root.rstrip('/')}/_states"
        refresh_states(spark, table, cols, states, whole=overwrite)
        outputs = mart_states.finished(spark, states)
    else:  # rows of a date are not found by a folder: one pass over the table
        outputs = {
            "daily": marts.daily_aggregates(table),
            "top_products": marts.top_products_mart(table),
            "top_categories": marts.top_categories(table),
        }
    written = {name: write_mart(df, marts_root, name, mart_format) for name, df in outputs.items()}
    return IngestResult(
        table_path=path,
        table_name=table_name,
        partition_columns=list(cols),
        marts=written,
        preview=schema_preview(raw, preview_fraction),
        detected=detected_columns(raw, spec),
        table=table,
    )
