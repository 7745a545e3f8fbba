"""Alias resolution on a DataFrame's column names (driver-side, metadata only).

Only column *names* are inspected, never rows, so resolution costs nothing at
any data size.  Matching ignores case and surrounding blanks: a raw header
`` Total_Price `` resolves the ``total_price`` alias (a plain ``in df.columns``
test would miss it and a later ``withColumn`` would silently overwrite it).
"""

from __future__ import annotations

from dataclasses import dataclass

from ..spec import CanonicalSpec


def _norm(name: str) -> str:
    return name.strip().lower()


def first_existing(aliases, columns) -> str | None:
    """Return the actual column name of the first alias present, else ``None``."""
    by_norm: dict[str, str] = {}
    for c in columns:
        by_norm.setdefault(_norm(c), c)
    for alias in aliases:
        hit = by_norm.get(_norm(alias))
        if hit is not None:
            return hit
    return None


def all_existing(aliases, columns) -> list[str]:
    """Actual names of every alias present, in alias order (no duplicates)."""
    out: list[str] = []
    for alias in aliases:
        hit = first_existing((alias,), columns)
        if hit is not None and hit not in out:
            out.append(hit)
    return out


def require_column(name: str, columns) -> str:
    """Exact-name lookup (case-insensitive) that fails with a clear message."""
    hit = first_existing((name,), columns)
    if hit is None:
        raise ValueError(f"column {name!r} not found; available columns: {list(columns)}")
    return hit


@dataclass(frozen=True)
class Resolution:
    """Matched raw column per canonical field (``None`` = absent, default applies)."""

    date: str | None
    price: str | None
    quantity: str | None
    product: str | None
    category: str | None
    seller: str | None
    unit_price: str | None
    order_id: str | None
    customer_id: str | None

    def as_rows(self) -> list[tuple[str, str | None]]:
        return [
            ("order_ts", self.date),
            ("total_price", self.price),
            ("unit_price", self.unit_price),
            ("quantity", self.quantity),
            ("product_id_canon", self.product),
            ("category_canon", self.category),
            ("seller_canon", self.seller),
            ("order_id", self.order_id),
            ("customer_id", self.customer_id),
        ]


def resolve(columns, spec: CanonicalSpec) -> Resolution:
    columns = list(columns)
    price = first_existing(spec.price, columns)
    unit_price = None
    if price is None and spec.derive_price:
        unit_price = first_existing(spec.unit_price, columns)
    return Resolution(
        date=first_existing(spec.date, columns),
        price=price,
        quantity=first_existing(spec.quantity, columns),
        product=first_existing(spec.product, columns),
        category=first_existing(spec.category, columns),
        seller=first_existing(spec.seller, columns),
        unit_price=unit_price,
        order_id=first_existing(spec.order_id, columns),
        customer_id=first_existing(spec.customer_id, columns),
    )
