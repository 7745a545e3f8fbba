"""Failure-tolerant coercions built only from JVM-side expressions.

Spark 4 runs with ANSI mode on, where ``CAST('abc' AS DOUBLE)`` raises.  The
reference code assumed the lenient behaviour (bad text becomes NULL), so every
coercion here uses the ``try_*`` family, which is independent of the session's
ANSI setting and stays inside whole-stage codegen.  Each helper takes the
column's current data type so it can skip pointless string round trips.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_WHOLE = r"^[\x00-\x20\x7f]*[+-]?[0-9]+[\x00-\x20\x7f]*\z"  # the only texts a cast to BIGINT takes
_TIMELIKE = (T.DateType, T.TimestampType, T.TimestampNTZType)


def is_timelike(dtype: T.DataType) -> bool:
    return isinstance(dtype, _TIMELIKE)


def to_double(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.DoubleType):
        return c
    return c.try_cast("double")


def to_long(c: Column, dtype: T.DataType) -> Column:
    """Whole units.  Text such as ``'12.5'`` goes through DOUBLE and truncates to 12
    (the non-ANSI cast result); ``'1,234'`` or ``'oops'`` give NULL."""
    if isinstance(dtype, T.LongType):
        return c
    if isinstance(dtype, _INTEGRAL):
        return c.cast("long")
    if isinstance(dtype, T.StringType):
        # exact BIGINT text first (no precision loss), then the DOUBLE route; other
        # texts are not tried, as each failed cast builds an exception
        return F.coalesce(F.when(c.rlike(_WHOLE), c.try_cast("long")), c.try_cast("double").try_cast("long"))
    return c.try_cast("long")


def to_timestamp(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.TimestampType):
        return c
    if isinstance(dtype, _TIMELIKE):
        return c.cast("timestamp")
    if isinstance(dtype, T.StringType):
        return F.try_to_timestamp(c)
    return c.try_cast("timestamp")


def to_date(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.DateType):
        return c
    if isinstance(dtype, _TIMELIKE):
        return c.cast("date")
    if isinstance(dtype, T.StringType):
        return F.try_to_date(c)
    return c.try_cast("date")


def to_text(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return c
    return c.cast("string")
