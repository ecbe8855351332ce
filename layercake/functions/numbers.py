"""Numeric repair and casts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from layercake.functions._util import ColumnOrName, col


def round_to_long(c: ColumnOrName) -> Column:
    """DOUBLE -> BIGINT rounding half to even (2.5 -> 2, 1.5 -> 2).

    A plain Spark cast truncates; ids that arrive as floating point (a blank in an
    integer CSV column) must round the way a SQL ``CAST(x AS BIGINT)`` does.
    """
    return F.rint(col(c)).cast("bigint")


def repair_amount(
    sales: ColumnOrName, quantity: ColumnOrName, price: ColumnOrName
) -> tuple[Column, Column]:
    """Return (sales', price') for one sales line.

    * sales' = quantity * |price| when sales is NULL, <= 0 or differs from it,
      else sales.
    * price' = sales / quantity (NULL when quantity is 0) when price is NULL or
      <= 0, else price -- computed from the *original* sales.

    Both expressions read the input columns, so put them in the same ``select``.
    """
    s, q, p = col(sales), col(quantity), col(price)
    expected = q * F.abs(p)
    new_sales = F.when(s.isNull() | (s <= 0) | (s != expected), expected).otherwise(s)
    new_price = F.when(p.isNull() | (p <= 0), s / F.nullif(q, F.lit(0))).otherwise(p)
    return new_sales, new_price
