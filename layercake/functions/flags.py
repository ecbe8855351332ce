"""Data-quality flag columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column

from layercake.functions._util import ColumnOrName, col


def missing_flag(*cols: ColumnOrName) -> Column:
    """TRUE when any of ``cols`` is NULL; never NULL itself."""
    if not cols:
        raise ValueError("missing_flag needs at least one column")
    return reduce(lambda a, b: a | b, (col(c).isNull() for c in cols))
