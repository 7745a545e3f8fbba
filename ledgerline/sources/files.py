"""Raw sales files -> canonical rows, tolerant of per-file header drift.

Reading a folder of CSV files as one DataFrame takes the column names from
*one* file and maps every other file by position, so a file whose columns are
in another order silently puts quantities into prices.  ``read_sales`` instead

1. lists the input files with a metadata-only ``binaryFile`` scan,
2. reads the first line of each file in a distributed job (one small read per
   file, never the data),
3. groups files by header text, and reads each layout with its own header as
   all-STRING columns (ids such as ``00012`` keep their zeros; nothing is
   inferred, so one bad row cannot turn a column into text),
4. resolves aliases per layout, canonicalises, and ``unionByName``s the layouts.

Every layout is a plain CSV scan, so the union is one stage of ordinary file
splits; no data passes through the driver, only file paths and header lines.
Parquet files are grouped by footer schema in the same way; JSON records carry
their own names, so there presence is told per record.  One rule holds for all:
a field is read from its first alias that is present, its default applies only
where none is.
"""

from __future__ import annotations

import csv
import functools
import io
import re
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.canonical import canonicalise, validate_required
from ..spec import BATCH_SPEC, CURATED_RAW_SCHEMA, CanonicalSpec
from .header_probe import first_lines, read_first_line  # noqa: F401 - re-exported

class NoInput(ValueError):
    """The files hold no rows that could be read: none there, or all of them empty."""


CORRUPT_RECORD_COLUMN = "_corrupt_record"
PATH_BUCKETS = 64
PASS_BYTES = 64 * 1024 * 1024  # of the files of a pass at least, where its layouts have as many
PASSES = 4  # a pass holds this share of all bytes at least, as far


def file_paths(spark: SparkSession, path) -> DataFrame:
    """One row per input file (``path``), listed by Spark's file index exactly as
    the CSV source would list it; file contents are not read."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.format("binaryFile").load(paths).select("path")


# Codecs Spark's readers know by these endings and the header probe does not.
_CODED = r"\.(bz2|zst|zstd|lz4|snappy|deflate)$"


def file_headers(spark: SparkSession, path, options: dict | None = None) -> DataFrame:
    """(path, header) for each input file, computed on executors.

    The file scan makes one partition per ~128 MB of files; those are merged
    (narrowly, no shuffle) so each header task handles a few dozen files.  Files
    under a codec the probe cannot open are read by Spark's text reader."""
    options = options or {}
    comment = options.get("comment")
    files = file_paths(spark, path)
    coded = [r["path"] for r in files.where(F.col("path").rlike(_CODED)).collect()]
    n = files.rdd.getNumPartitions()
    probe = first_lines(options.get("encoding", "utf-8"), comment)
    plain = files.where(~F.col("path").rlike(_CODED)).coalesce(max(1, n // 32)).mapInPandas(probe, "path string, header string")
    if not coded:
        return plain
    lines = spark.read.text(coded).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("value"),
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("at"),
    )
    lines = lines.where(F.trim("value") != "")
    if comment:
        lines = lines.where(~F.startswith("value", F.lit(comment)))
    return plain.unionByName(lines.groupBy("path").agg(F.min_by("value", "at").alias("header")))


def parse_header(line: str, sep: str = ",", quote: str = '"') -> list[str]:
    names = next(csv.reader(io.StringIO(line), delimiter=sep, quotechar=quote))
    seen: dict[str, int] = {}
    out = []
    for i, n in enumerate(names):
        key = n.strip().lower()
        if key in seen or not n.strip():
            n = f"{n.strip() or '_c'}{i}"  # duplicate/blank names get their position
        seen[key] = i
        out.append(n)
    return out


def csv_layouts(spark: SparkSession, path, sep: str = ",", **options) -> list[tuple[list[str], list[str]]]:
    """[(column names, files)] per distinct header line.

    Only the distinct header lines and their file paths reach the driver --
    the same path list Spark's own file index keeps there for any file scan."""
    # Paths are gathered per (header, hash bucket): a header shared by millions of
    # files is spread over PATH_BUCKETS tasks instead of one; lists merge below.
    grouped = (
        file_headers(spark, path, options)
        .where(F.col("header").isNotNull())
        .groupBy("header", F.pmod(F.xxhash64("path"), F.lit(PATH_BUCKETS)).alias("_bucket"))
        .agg(F.collect_list("path").alias("paths"))
        .collect()
    )
    by_header: dict[str, list[str]] = {}
    for r in grouped:
        by_header.setdefault(r["header"], []).extend(r["paths"])
    quote = options.get("quote") or '"'
    return [(parse_header(h, sep, quote), sorted(by_header[h])) for h in sorted(by_header)]


_PARTITION_FOLDER = re.compile(r"/[^/=]+=[^/]*(?=/)")


def _without_scheme(path: str) -> str:
    return re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:/+", "/", path)


def by_base(files: list[str], roots: list[str]) -> list[tuple[str | None, list[str]]]:
    """Files grouped by the folder above their first ``name=value`` folder below one
    of the ``roots`` they were listed from (None: no such folder)."""
    plain = sorted((_without_scheme(r).rstrip("/") for r in roots), key=len, reverse=True)
    groups: dict[str | None, list[str]] = {}
    for f in files:
        own = _without_scheme(f)
        root = next((r for r in plain if own.startswith(r + "/")), None)
        skip = len(f) - len(own) + len(root) if root is not None else len(f)
        m = _PARTITION_FOLDER.search(f, skip)
        groups.setdefault(f[: m.start()] if m else None, []).append(f)
    return list(groups.items())


def read_csv_layout(spark: SparkSession, names: list[str], files: list[str], roots=(), **options) -> DataFrame:
    """All-STRING rows of files of one header; folders ``name=value`` below
    ``roots`` become columns, as in a read of the whole folder."""
    schema = T.StructType([T.StructField(n, T.StringType(), True) for n in names])
    parts = []
    for base, group in by_base(files, list(roots)):
        r = spark.read.schema(schema).option("header", True).options(**options)
        parts.append((r.option("basePath", base) if base else r).csv(group))
    return parts[0] if len(parts) == 1 else union_by_name(parts)


def _roots(path) -> list[str]:
    return [path] if isinstance(path, str) else list(path)


def read_sales_csv(
    spark: SparkSession, path, spec: CanonicalSpec = BATCH_SPEC, *, sep: str = ",", required=(), layouts=None, roots=None, shape=None, **options
) -> DataFrame:
    """Canonical rows from a folder of CSV files whose headers may differ.

    ``required`` names canonical fields (e.g. ``"order_id"``) every layout must
    provide; a layout without one fails here, before anything is written.
    ``layouts`` reuses a ``csv_layouts`` result instead of probing again; ``roots``
    are the folders the files were listed from (default: ``path``); ``shape`` is
    applied to the canonical rows of each layout before they are put together."""
    parts = []
    for names, files in layouts if layouts is not None else csv_layouts(spark, path, sep, **options):
        raw = read_csv_layout(spark, names, files, roots or _roots(path), sep=sep, **options)
        if required:
            validate_required(raw, required, spec)
        rows = canonicalise(raw, spec)
        parts.append(shape(rows) if shape else rows)
    if not parts:
        raise NoInput(f"no CSV files with a header under {path}")
    return union_by_name(parts)


def layout_passes(spark: SparkSession, path, layouts) -> list[list[tuple[list[str], list[str]]]]:
    """The layouts in groups whose files have about a share of all bytes each, the
    largest first; a layout is never split, so the files of a date multiply only where
    layouts share dates, and then by the number of groups (below 2 x ``PASSES``)."""
    sizes = {r["path"]: r["length"] for r in spark.read.format("binaryFile").load(_roots(path)).select("path", "length").collect()}
    own = [sum(sizes.get(f, 0) for f in files) for _, files in layouts]
    most = max(PASS_BYTES, sum(own) / PASSES)
    groups: list[list] = []
    room = 0.0
    for layout, size in zip(layouts, own):
        if not groups or size > room:
            groups.append([])
            room = most
        groups[-1].append((size, layout))
        room -= size
    groups.sort(key=lambda g: -sum(size for size, _ in g))
    return [[layout for _, layout in g] for g in groups]


def read_raw_by_header(spark: SparkSession, path, *, sep: str = ",", layouts=None, **options) -> DataFrame:
    """All-STRING raw rows of every layout, aligned by column *name*."""
    if layouts is None:
        layouts = csv_layouts(spark, path, sep, **options)
    parts = [read_csv_layout(spark, n, f, _roots(path), sep=sep, **options) for n, f in layouts]
    if not parts:
        raise NoInput(f"no CSV files with a header under {path}")
    return union_by_name(parts)


def read_raw(spark: SparkSession, path, fmt: str = "csv", how: str = "inferred", **options) -> DataFrame:
    """One raw DataFrame over ``path``.

    ``how`` for CSV: ``"inferred"`` (header + type inference over the whole
    input -- the simple approach, positional across files), ``"curated"`` (the
    fixed raw schema; a header that does not match raises instead of shifting
    values; malformed lines are kept in ``_corrupt_record``), ``"text"`` (header
    names, all columns STRING).
    """
    r = spark.read.options(**options)
    if fmt == "csv":
        r = r.option("header", True)
        if how == "inferred":
            r = r.option("inferSchema", True)
        elif how == "curated":
            # typed read of the fixed raw schema; a header that does not match
            # raises, and a line with an unparsable field keeps its text in
            # ``_corrupt_record`` (its typed fields are NULL) instead of vanishing
            schema = T.StructType([*CURATED_RAW_SCHEMA.fields, T.StructField(CORRUPT_RECORD_COLUMN, T.StringType(), True)])
            r = (
                r.schema(schema).option("enforceSchema", False)
                .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT_RECORD_COLUMN)
            )
        elif how != "text":
            raise ValueError(f"unknown CSV read mode {how!r}")
        return r.csv(path)
    paths = [path] if isinstance(path, str) else list(path)
    if fmt == "parquet":
        return r.option("mergeSchema", True).parquet(*paths)
    return r.format(fmt).load(paths)


def read_sales(
    spark: SparkSession, path, fmt: str = "csv", spec: CanonicalSpec = BATCH_SPEC, *, required=(), shape=None, **options
) -> DataFrame:
    """Canonical sales rows from raw files of any supported format (``shape``: see
    ``read_sales_csv``; JSON has one layout)."""
    if fmt == "csv":
        return read_sales_csv(spark, path, spec, required=required, shape=shape, **options)
    paths = [path] if isinstance(path, str) else list(path)
    if fmt == "json":
        rows = _sales_json(spark, paths, spec, required, options)
        return shape(rows) if shape else rows
    # Parquet: the files of one footer schema are one layout.  Canonical columns
    # have fixed types, so files that disagree on a type (INT vs BIGINT quantity,
    # which Parquet refuses to merge) still union cleanly.
    parts = []
    for files in parquet_layouts(spark, paths):
        raw = spark.read.options(**options).parquet(*files)
        if required:
            validate_required(raw, required, spec)
        rows = canonicalise(raw, spec)
        parts.append(shape(rows) if shape else rows)
    if not parts:
        raise NoInput(f"no files under {path}")
    return union_by_name(parts)


def parquet_layouts(spark: SparkSession, paths: list[str]) -> list[list[str]]:
    """Files grouped by footer schema (one metadata read per file, in parallel)."""
    files = [r["path"] for r in file_paths(spark, paths).where(~F.col("path").rlike(r"/[_.][^/]*$")).collect()]
    with ThreadPoolExecutor(16) as pool:
        schemas = list(pool.map(lambda f: spark.read.parquet(f).schema.json(), files))
    groups: dict[str, list[str]] = {}
    for f, schema in zip(files, schemas):
        groups.setdefault(schema, []).append(f)
    return [sorted(groups[k]) for k in sorted(groups)]


RECORD_COLUMN = "_record"


def json_path(name: str) -> str:
    """JSON path of a top-level key that may hold dots, blanks or one kind of quote."""
    return f'$["{name}"]' if '"' not in name else f"$['{name}']"


def _sales_json(spark: SparkSession, paths: list[str], spec: CanonicalSpec, required, options) -> DataFrame:
    """JSON records carry their own names: each is kept as one VARIANT beside the
    columns, which tells a key that is absent from one that holds null."""
    schema = spark.read.options(**options).json(paths).schema
    records = spark.read.options(**options).option("singleVariantColumn", RECORD_COLUMN).json(paths)
    raw = records.select(
        RECORD_COLUMN,
        *[F.try_variant_get(RECORD_COLUMN, json_path(f.name), f.dataType.simpleString()).alias(f.name) for f in schema.fields],
    )
    if required:
        validate_required(raw, required, spec)
    has = lambda name: F.variant_get(RECORD_COLUMN, json_path(name), "variant").isNotNull()
    return canonicalise(raw, spec, present=has).drop(RECORD_COLUMN)


def conformed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns of ``schema``, NULL where it has none of that name."""
    own = {c.lower(): c for c in df.columns}
    return df.select(
        *[(F.col(f"`{own[f.name.lower()]}`") if f.name.lower() in own else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def union_by_name(parts: list[DataFrame]) -> DataFrame:
    """Union by name; columns of one name but several types become STRING."""
    kinds: dict[str, set] = {}
    for df in parts:
        for f in df.schema.fields:
            kinds.setdefault(f.name.lower(), set()).add(f.dataType.simpleString())
    mixed = {n for n, k in kinds.items() if len(k) > 1}
    parts = [df.select(*[F.col(f"`{c}`").cast("string").alias(c) if c.lower() in mixed else F.col(f"`{c}`") for c in df.columns]) for df in parts]
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
