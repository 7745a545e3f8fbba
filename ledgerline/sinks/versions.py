"""Overwriting a table as one step.

Every version of the table is written to a folder of its own and registered under
a name of its own; the name that readers use is a view, and replacing the view is
the one change that publishes a version.  A writer that fails before it leaves
everything as it was, and a query that has started goes on reading the version it
started with.  Old versions stay until they are dropped by ``drop_versions``.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .tables import Published, publish, register_table

CURRENT, PATH = "ledgerline.current", "ledgerline.path"


@dataclass(frozen=True)
class Version:
    table: str  # its own name
    path: str
    written: Published


def _split(name: str) -> tuple[str, str]:
    prefix, dot, last = name.rpartition(".")
    return prefix + dot, last


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    if not spark.catalog.tableExists(name):
        return {}
    if spark.catalog.getTable(name).tableType != "VIEW":
        raise ValueError(f"{name} is a table; a name for versions must be free or a view")
    return {r["key"]: r["value"] for r in spark.sql("SHOW TBLPROPERTIES IDENTIFIER(:t)", args={"t": name}).collect()}


def current(spark: SparkSession, name: str) -> str | None:
    """The table that ``name`` stands for."""
    return _properties(spark, name).get(CURRENT)


def point(spark: SparkSession, name: str, table: str) -> None:
    """Let ``name`` stand for ``table``: one change of the catalog."""
    prefix, last = _split(name)
    own = ".".join(f"`{x}`" for x in [*prefix.strip(".").split("."), last] if x)
    target = ".".join(f"`{x}`" for x in table.split("."))
    spark.sql(f"CREATE OR REPLACE VIEW {own} TBLPROPERTIES ('{CURRENT}' = '{table}') AS SELECT * FROM {target}")


def replace_table(spark: SparkSession, name: str, root: str, df: DataFrame, **how) -> Version:
    """Publish ``df`` as the whole content of ``name``, in a new folder below ``root``
    (``how``: parameters of ``publish``).  Fails without a trace for readers."""
    _properties(spark, name)  # refuses a plain table before anything is written
    version = f"v{time.time_ns()}"
    path, (prefix, last) = f"{root.rstrip('/')}/{version}", _split(name)
    table = f"{prefix}{last}__{version}"
    written = publish(df, path, overwrite=False, **how)
    register_table(spark, table, path, partitioned=bool(written), written=written)
    point(spark, name, table)
    return Version(table, path, written)


def append_to(spark: SparkSession, name: str, df: DataFrame, **how) -> Published:
    """Append to the current version and show its new partitions and columns."""
    table = current(spark, name)
    if table is None:
        raise ValueError(f"{name} has no version yet")
    path = spark.sql("DESCRIBE FORMATTED IDENTIFIER(:t)", args={"t": table}).where("col_name = 'Location'").first()["data_type"]
    written = publish(df, path, overwrite=False, **how)
    register_table(spark, table, path, partitioned=bool(written), written=written)
    point(spark, name, table)  # the view takes in new columns
    return written


def versions(spark: SparkSession, name: str) -> list[str]:
    """Tables of all versions, oldest first."""
    prefix, last = _split(name)
    listed = spark.catalog.listTables(prefix.rstrip(".") or None, pattern=f"{last}__v*".lower())
    return sorted(f"{prefix}{t.name}" for t in listed)


def drop_versions(spark: SparkSession, name: str, keep: int = 1) -> list[str]:
    """Drop all but the newest ``keep`` versions and the current one, with their
    files; the tables dropped.  Not for versions that queries may still read."""
    now, every = current(spark, name), versions(spark, name)
    gone = [t for t in every[: len(every) - keep] if t != now]
    for t in gone:
        path = spark.sql("DESCRIBE FORMATTED IDENTIFIER(:t)", args={"t": t}).where("col_name = 'Location'").first()["data_type"]
        spark.sql("DROP TABLE IDENTIFIER(:t)", args={"t": t})
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    return gone
