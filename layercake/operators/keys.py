"""Gap-free surrogate keys 1..N in a global order without a single-partition sort."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layercake.operators.ordering import POS, SLICE, Sort, as_sorts, complete_tiebreak, range_slices, slice_count


def dense_key(
    df: DataFrame,
    order: Sequence[Sort | str],
    name: str = "key",
    *,
    complete_order: bool = True,
    slices: int | None = None,
) -> DataFrame:
    """Add ``name`` = 1..N (BIGINT, no gaps) following ``order``.

    Equivalent to ``row_number() OVER (ORDER BY order)`` but distributed, the same
    way for every size: the table is range-sliced on the sort order (``slices``
    ranges, by default as its volume needs; see ``slice_count``) and written once with
    each row's position inside its slice; the rows per slice are counted (one
    number per slice reaches the driver) and their running sums joined back as a
    broadcast table of one row per slice. The key is offset + position + 1: a
    map-only pass, no further shuffle.

    ``complete_order`` appends every other column as a tie-break so the numbering
    does not depend on the physical row order. Keys are renumbered on each run:
    they are stable only for identical input.
    """
    sorts = as_sorts(order)
    if complete_order:
        sorts = complete_tiebreak(df, sorts)
    table = range_slices(df, sorts, slice_count(df, slices), "dense-key")
    sizes = sorted(table.groupBy(SLICE).count().collect())
    starts = [0, *accumulate(n for _, n in sizes)][:-1]
    offsets = df.sparkSession.createDataFrame(
        [(b, start) for (b, _), start in zip(sizes, starts)], f"{SLICE} int, __lc_offset bigint"
    )
    keyed = table.join(F.broadcast(offsets), SLICE)
    key = (F.col("__lc_offset") + F.col(POS) + 1).cast("bigint")
    return keyed.select(*df.columns, key.alias(name))
