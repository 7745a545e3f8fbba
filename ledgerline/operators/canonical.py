"""Canonicalisation: raw sales columns -> the fixed canonical columns.

Resolution happens once on the driver from column names; the result is a single
``select`` (one Project node), so Catalyst collapses it with neighbours, prunes
canonical columns a query does not use, and pushes filters on them through to
the scan.  No UDF is involved.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import coerce
from ..functions.resolve import Resolution, all_existing, resolve
from ..spec import BATCH_SPEC, CANONICAL_COLUMNS, CanonicalSpec


def _typed(df: DataFrame, name: str):
    return df.schema[name].dataType


def canonical_columns(
    df: DataFrame, res: Resolution, spec: CanonicalSpec, present: Callable[[str], Column] | None = None
) -> list[Column]:
    """The canonical column expressions for ``df`` given a resolution.

    A field is read from its first alias that is *present*, whatever the value
    there, and takes its default only if none is.  Without ``present`` the columns
    of ``df`` are what is present; with it (records that carry their own names)
    ``present(column)`` tells it per row."""

    def raw(name):
        return F.col(f"`{name}`")

    def pick(aliases, first, conv, default):
        if present is None:
            return conv(raw(first), _typed(df, first)) if first is not None else default
        chain = None
        for n in all_existing(aliases, df.columns):
            value = conv(raw(n), _typed(df, n))
            chain = F.when(present(n), value) if chain is None else chain.when(present(n), value)
        return default if chain is None else chain.otherwise(default)

    no_time = F.lit(None).cast("timestamp")
    order_ts = pick(spec.date, res.date, coerce.to_timestamp, no_time)
    if present is None and res.date is not None and coerce.is_timelike(_typed(df, res.date)):
        # DATE / TIMESTAMP_NTZ carry the wall-clock date already: no
        # per-row time-zone round trip through TIMESTAMP
        sale_date = raw(res.date).cast("date")
    else:
        sale_date = order_ts.cast("date")

    quantity = pick(spec.quantity, res.quantity, coerce.to_long, F.lit(spec.default_quantity).cast("long"))

    price = F.lit(spec.default_price).cast("double")
    if res.unit_price is not None and res.quantity is not None:
        unit = coerce.to_double(raw(res.unit_price), _typed(df, res.unit_price))
        counted = pick(spec.quantity, res.quantity, coerce.to_double, F.lit(None).cast("double"))
        derived = F.try_multiply(unit, counted)
        if present is None:
            price = derived
        else:
            some = reduce(or_, [present(n) for n in all_existing(spec.quantity, df.columns)])
            price = F.when(present(res.unit_price) & some, derived).otherwise(price)
    total_price = pick(spec.price, res.price, coerce.to_double, price)

    def text_or(aliases, name, default):
        return pick(aliases, name, coerce.to_text, F.lit(default).cast("string"))

    exprs = {
        "order_id": text_or(spec.order_id, res.order_id, None),
        "customer_id": text_or(spec.customer_id, res.customer_id, None),
        "order_ts": order_ts,
        "sale_date": sale_date,
        "total_price": total_price,
        "quantity": quantity,
        "product_id_canon": text_or(spec.product, res.product, None),
        "category_canon": text_or(spec.category, res.category, spec.default_category),
        "seller_canon": text_or(spec.seller, res.seller, None),
    }
    return [exprs[name].alias(name) for name in CANONICAL_COLUMNS]


def canonicalise(
    df: DataFrame,
    spec: CanonicalSpec = BATCH_SPEC,
    *,
    keep_raw: bool = True,
    drop_internal: bool = False,
    present: Callable[[str], Column] | None = None,
) -> DataFrame:
    """Add the canonical columns to ``df`` in one projection.

    Raw columns are kept (as the reference does) except those whose name equals
    a canonical name ignoring case -- those are replaced, never duplicated.
    ``drop_internal`` also drops raw columns starting with ``_``.  ``present``:
    see ``canonical_columns``.
    """
    res = resolve(df.columns, spec)
    canon = canonical_columns(df, res, spec, present)
    kept = []
    if keep_raw:
        taken = {c.lower() for c in CANONICAL_COLUMNS}
        for c in df.columns:
            if c.strip().lower() in taken:
                continue
            if drop_internal and c.startswith("_"):
                continue
            kept.append(F.col(f"`{c}`"))
    return df.select(*kept, *canon)


def validate_required(df: DataFrame, required=("order_id",), spec: CanonicalSpec = BATCH_SPEC) -> None:
    """Fail *before* writing when a column a downstream mart needs is absent."""
    res = resolve(df.columns, spec)
    missing = [r for r in required if getattr(res, r, None) is None]
    if missing:
        raise ValueError(f"required columns not found: {missing}; columns: {df.columns}")
