"""Order-independent money aggregates.

Summing DOUBLE prices gives results that depend on the order rows arrive in
(partitioning, AQE coalescing), so two runs -- or Spark and a second SQL
engine -- can differ in the last bits.  Each price is therefore taken as a wide
decimal with eight places, far below any price's own precision, and the decimals
are summed exactly; only the finished sum becomes a DOUBLE.  No line is rounded
to cents, so a thousand lines of 0.004 make 4.0.

A price that is no number (NaN, infinite, or 10^20 and more) counts as NULL: it
adds nothing, and a bad value never fails a report.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AMOUNT_TYPE = "decimal(28,8)"


def amount(price: Column | str) -> Column:
    """One price as an exact decimal; NULL and non-numbers are NULL."""
    p = F.col(price) if isinstance(price, str) else price
    return p.try_cast(AMOUNT_TYPE)


def amount_sum(price: Column | str) -> Column:
    """Exact decimal sum, for aggregates of aggregates."""
    return F.try_sum(amount(price))


def money_sum(price: Column | str) -> Column:
    """SUM(price), exact, returned as DOUBLE."""
    return amount_sum(price).cast("double")


def money_avg(price: Column | str) -> Column:
    """AVG(price) over the prices that count: exact sum / their number."""
    return money_sum(price) / F.count(amount(price))


def units_sum(qty: Column | str) -> Column:
    q = F.col(qty) if isinstance(qty, str) else qty
    return F.sum(q.cast("long"))
