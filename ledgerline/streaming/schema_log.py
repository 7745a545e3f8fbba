"""What a stream knows about columns it was never told of.

Fields beyond the canonical ones are kept as text, by name, so no value is lost
when a later drop disagrees about its type.  Per name the log counts how many
values there were and how many of them read as boolean, whole number, number,
date or timestamp.  Counts of two batches add up, and a type holds only while
*every* value reads as it, so types can only widen:

    boolean ----------------------\\
    whole number -> number ---------> text
    date -> timestamp -------------/

A name that a measured share of all rows carries is promoted to a column of its
own, for good; the others share one VARIANT column, so the width of the table
does not follow the number of names.

Each batch adds one version, the totals up to and including it, written before
the batch's data; the batch's commit names it.  A restart goes on from the version
of the last commit.  The counts stay a table whatever the number of names; the
driver sees the promoted ones only, at most (fields a row) / ``PROMOTE_SHARE``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EXTRAS = "extras"
PROMOTE_SHARE = 0.05  # of all rows so far that must carry a name
FOLDER = "_schema"

COUNTS = ("n", "booleans", "longs", "doubles", "dates", "timestamps")
_TABLE = T.StructType(
    [T.StructField("name", T.StringType()), *[T.StructField(c, T.LongType()) for c in COUNTS], T.StructField("promoted", T.BooleanType())]
)

_WHOLE = r"^-?(0|[1-9][0-9]{0,18})$"  # a number with leading zeros is an id
_NUMBER = r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]{1,3})?$"
_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_TIMESTAMP = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?)?$"


@dataclass(frozen=True)
class Promoted:
    """A column of its own, and the type all its values have so far."""

    name: str
    kind: str


def normal(name: Column) -> Column:
    return F.lower(F.trim(name))


def _reads_as(value: Column) -> dict[str, Column]:
    return {
        "n": F.lit(True),
        "booleans": F.lower(value).isin("true", "false"),
        "longs": value.rlike(_WHOLE) & value.try_cast("bigint").isNotNull(),
        "doubles": value.rlike(_NUMBER) & value.try_cast("double").isNotNull(),
        "dates": value.rlike(_DATE) & value.try_cast("date").isNotNull(),
        "timestamps": value.rlike(_TIMESTAMP) & value.try_cast("timestamp_ntz").isNotNull(),
    }


def measured(rows: DataFrame) -> DataFrame:
    """Counts by normal name over ``extras`` (map of text); the row of the empty name
    counts the rows.  One aggregate with map-side combine, a few numbers a name."""
    whole_row = F.array(F.struct(F.lit("").alias("key"), F.lit(None).cast("string").alias("value")))
    entries = F.coalesce(F.map_entries(EXTRAS), F.array().cast("array<struct<key:string,value:string>>"))
    each = rows.select(F.explode(F.concat(whole_row, entries)).alias("e")).select(normal(F.col("e.key")).alias("name"), F.col("e.value").alias("v"))
    return each.groupBy("name").agg(*[F.count_if(F.coalesce(test, F.lit(False))).alias(c) for c, test in _reads_as(F.col("v")).items()])


def _holds(share: float) -> Column:
    """Is a name promoted, given the number of rows beside it?"""
    return (F.col("name") != "") & (F.col("promoted") | (F.col("n") >= F.lit(share) * F.col("total")))


def kind() -> Column:
    """The narrowest type that all values of a name read as."""
    out = F.lit("string")
    for c, t in (("timestamps", "timestamp_ntz"), ("dates", "date"), ("doubles", "double"), ("longs", "bigint"), ("booleans", "boolean")):
        out = F.when(F.col(c) == F.col("n"), F.lit(t)).otherwise(out)
    return out


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], _TABLE)


def read_version(spark: SparkSession, root: str, version: str) -> DataFrame:
    return spark.read.schema(_TABLE).parquet(f"{root}/{FOLDER}/{version}")


def _with_total(log: DataFrame) -> DataFrame:
    """``log`` beside the number of rows it has counted (one number for the driver)."""
    total = log.where("name = ''").agg(F.sum("n")).first()[0] or 0
    return log.withColumn("total", F.lit(total).cast("long"))


def write_version(previous: DataFrame, counts: DataFrame, root: str, version: str, share: float = PROMOTE_SHARE) -> DataFrame:
    """Add the counts of one batch to those before it; the new version, as written."""
    spark = counts.sparkSession
    held = _with_total(previous).withColumn("promoted", _holds(share)).drop("total")
    both = held.unionByName(counts.withColumn("promoted", F.lit(False)))
    merged = both.groupBy("name").agg(*[F.sum(c).alias(c) for c in COUNTS], F.bool_or("promoted").alias("promoted"))
    merged.select(*_TABLE.names).write.mode("overwrite").parquet(f"{root}/{FOLDER}/{version}")
    return read_version(spark, root, version)


RESERVED = ("", "batch", EXTRAS)


def promoted(log: DataFrame, taken, share: float = PROMOTE_SHARE) -> list[Promoted]:
    """The promoted names and their types, sorted; ``taken`` names cannot be."""
    known = _with_total(log).where(_holds(share) & ~F.col("name").isin(*RESERVED, *[t.lower() for t in taken]))
    return [Promoted(r.name, r.kind) for r in known.select("name", kind().alias("kind")).orderBy("name").collect()]


# ------------------------------------------------------------ rows and columns ---


def _entries(name: str) -> Column:
    """Entries of the ``extras`` map that are spelt like ``name`` but for case and blanks."""
    return F.filter(F.map_entries(EXTRAS), lambda e: normal(e["key"]) == F.lit(name))


def split(rows: DataFrame, columns: list[Promoted]) -> DataFrame:
    """Rows with an ``extras`` map -> the promoted columns as text, and the rest of
    ``extras`` as VARIANT (NULL where nothing is left).  Of two spellings of one
    promoted name in a row the second stays in ``extras``."""
    base = [c for c in rows.columns if c != EXTRAS]
    hits = [F.try_element_at(_entries(c.name), F.lit(1)) for c in columns]
    moved = F.array(*[h["key"] for h in hits]) if hits else F.array().cast("array<string>")
    rest = F.map_filter(EXTRAS, lambda k, v: ~F.coalesce(F.array_contains(F.array_compact(moved), k), F.lit(False)))
    return rows.select(
        *[F.col(f"`{c}`") for c in base],
        *[h["value"].alias(c.name) for h, c in zip(hits, columns)],
        F.when(F.size(rest) > 0, F.to_variant_object(rest)).alias(EXTRAS),
    )


def typed(rows: DataFrame, columns: list[Promoted]) -> DataFrame:
    """Stored rows with every promoted column in its type; rows written before a
    name was promoted have its values in ``extras``."""
    base = [c for c in rows.columns if c not in {p.name for p in columns}]
    texts = rows.withColumn(EXTRAS, F.col(EXTRAS).try_cast("map<string,string>"))
    values = {p.name: F.coalesce(F.col(f"`{p.name}`"), F.try_element_at(_entries(p.name), F.lit(1))["value"]) for p in columns}
    out = [v.try_cast(p.kind).alias(p.name) if p.kind != "string" else v.alias(p.name) for p, v in ((p, values[p.name]) for p in columns)]
    used = [F.when(F.col(f"`{p.name}`").isNull(), F.try_element_at(_entries(p.name), F.lit(1))["key"]) for p in columns]
    left = F.map_filter(EXTRAS, lambda k, v: ~F.array_contains(F.array_compact(F.array(*used)), k)) if used else F.col(EXTRAS)
    return texts.select(*[F.when(F.size(left) > 0, left).alias(c) if c == EXTRAS else F.col(f"`{c}`") for c in base], *out)
