"""Per-key ordered operators: keep-latest, validity intervals, current versions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layercake.operators.ordering import POS, SLICE, Sort, as_sorts, range_slices, slice_count


def _sort_column(item: Sort | str | Column) -> Column:
    if isinstance(item, Column):
        return item
    return as_sorts([item])[0].column()


def keep_latest(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Sort | str | Column],
    tiebreak: Sequence[Sort | str | Column] = (),
) -> DataFrame:
    """Keep the first row per ``keys`` under ``order`` (then ``tiebreak``).

    ``row_number() = 1`` is planned by Spark as a WindowGroupLimit that runs
    *before* the shuffle as well as after it, so every map task forwards at most
    one row per key: a key holding a third of the table costs one row per input
    split in the exchange.
    """
    rank = F.row_number().over(
        Window.partitionBy(*keys).orderBy(*[_sort_column(o) for o in (*order, *tiebreak)])
    )
    return df.withColumn("__lc_rn", rank).where(F.col("__lc_rn") == 1).drop("__lc_rn")


def current_only(df: DataFrame, end: str) -> DataFrame:
    """Rows whose validity has not ended (``end IS NULL``)."""
    return df.where(F.col(end).isNull())


def validity_end(
    df: DataFrame,
    key: str | Sequence[str],
    start: str,
    out: str = "valid_to",
    tiebreak: Sequence[str] = (),
    *,
    slices: int | None = None,
) -> DataFrame:
    """``out = lead(start) OVER (PARTITION BY key ORDER BY start NULLS LAST,
    tiebreak) - 1 day`` -- close each version the day before the next one starts.

    Skew-safe and the same for every size: the table is range-sliced on (key, start,
    tiebreak) and written to the shared checkpoint folder (``slices`` ranges, by
    default as its volume needs; see ``slice_count`` and ``range_slices``). The window
    then runs per (slice, key), so one key's history is spread over as many tasks as
    its size needs. Only the last row of a slice can have its successor in another
    one: the first row of the next slice that has rows (one row per slice reaches the
    driver). Pass a unique ``tiebreak`` when starts can tie inside a key; ties are
    otherwise ordered arbitrarily.
    """
    keys = [key] if isinstance(key, str) else list(key)
    composite = [Sort(k, nulls_first=True) for k in keys] + [Sort(start), *as_sorts(tiebreak)]
    staged = range_slices(df, composite, slice_count(df, slices), "validity-end")

    first_rows = sorted(staged.where(F.col(POS) == 0).select(SLICE, *keys, start).collect(), key=lambda r: r[SLICE])
    edge_fields = [
        T.StructField(SLICE, T.IntegerType()),
        *[T.StructField(f"__lc_k{i}", df.schema[k].dataType) for i, k in enumerate(keys)],
        T.StructField("__lc_first", df.schema[start].dataType),
    ]
    edges = df.sparkSession.createDataFrame(
        [(here[0], *following[1:]) for here, following in zip(first_rows, first_rows[1:])], T.StructType(edge_fields)
    )
    w = Window.partitionBy(SLICE, *keys).orderBy(POS)
    local = staged.withColumn("__lc_next", F.lead(start).over(w)).withColumn("__lc_last", F.lead(POS).over(w).isNull())
    joined = local.join(F.broadcast(edges), SLICE, "left")
    same_key = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__lc_k{i}")) for i, k in enumerate(keys)])
    following = F.when(~F.col("__lc_last"), F.col("__lc_next")).when(same_key, F.col("__lc_first"))
    end = F.date_sub(following, 1).alias(out)
    cols = [end if c == out else F.col(c) for c in df.columns]
    return joined.select(*cols, *([] if out in df.columns else [end]))
