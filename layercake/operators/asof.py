"""As-of join: for every left row the latest right row at or before its time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layercake.operators.ordering import POS, SLICE, Sort, range_slices, slice_count


def _columns(items: str | Sequence[str]) -> list[str]:
    return [items] if isinstance(items, str) else list(items)


def asof_left(
    left: DataFrame,
    right: DataFrame,
    *,
    left_on: str | Sequence[str],
    right_on: str | Sequence[str],
    left_time: str,
    right_time: str,
    columns: Mapping[str, str],
    tiebreak: Sequence[str] = (),
    slices: int | None = None,
) -> DataFrame:
    """Every left row once, with ``columns`` (new name -> right column) of the right row with
    equal keys and the greatest ``right_time`` not after ``left_time``; of equal times the
    last by ``tiebreak``, which must tell them apart. NULL without such a row; NULL keys and
    times never match.

    No inequality join: both sides are sorted together by (key, time), right rows before left
    ones, in range slices (see ``range_slices``), so that a hot key is spread over as many
    slices as it needs. A window per (slice, key) carries the last right row forward. Where a
    key goes on in the next slice, its last right row is carried over: one row per slice
    reaches the driver.
    """
    l_keys, r_keys = _columns(left_on), _columns(right_on)
    if len(l_keys) != len(r_keys):
        raise ValueError("as many left as right keys are needed")
    for lk, rk in [*zip(l_keys, r_keys, strict=True), (left_time, right_time)]:
        one, other = left.schema[lk].dataType, right.schema[rk].dataType
        if one != other and not (isinstance(one, T.NumericType) and isinstance(other, T.NumericType)):
            raise ValueError(f"{lk} {one.simpleString()} and {rk} {other.simpleString()} do not compare")
    names = [f"k{i}" for i in range(len(l_keys))]
    found_type = T.StructType([T.StructField(f"c{i}", right.schema[c].dataType) for i, c in enumerate(columns.values())])
    row_type = T.StructType([T.StructField(f"f{i}", f.dataType) for i, f in enumerate(left.schema.fields)])

    def known(df: DataFrame, needed: Sequence[str]) -> Column:
        every = F.lit(True)
        for c in needed:
            every = every & F.col(f"`{c}`").isNotNull()
        return every

    tied = [f"t{i}" for i in range(len(tiebreak))]
    lefts = left.where(known(left, [*l_keys, left_time])).select(
        *[F.col(f"`{k}`").alias(n) for k, n in zip(l_keys, names, strict=True)],
        F.col(f"`{left_time}`").alias("at"),
        F.lit(1).alias("side"),
        *[F.lit(None).cast(right.schema[c].dataType).alias(t) for c, t in zip(tiebreak, tied, strict=True)],
        F.struct(*[F.col(f"`{c}`").alias(f"f{i}") for i, c in enumerate(left.columns)]).alias("row"),
        F.lit(None).cast(found_type).alias("found"),
    )
    rights = right.where(known(right, [*r_keys, right_time])).select(
        *[F.col(f"`{k}`").alias(n) for k, n in zip(r_keys, names, strict=True)],
        F.col(f"`{right_time}`").alias("at"),
        F.lit(0).alias("side"),
        *[F.col(f"`{c}`").alias(t) for c, t in zip(tiebreak, tied, strict=True)],
        F.lit(None).cast(row_type).alias("row"),
        F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns.values())]).alias("found"),
    )
    events = lefts.unionByName(rights)
    order = [Sort(n) for n in [*names, "at", "side", *tied]]
    staged = range_slices(events, order, slice_count(events, slices), "as-of")

    so_far = Window.partitionBy(SLICE, *names).orderBy(POS).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = staged.withColumn("found", F.last("found", ignorenulls=True).over(so_far))
    edges = _edges(staged, names, found_type)
    same = F.col(SLICE) == F.col("e_slice")
    for n in names:
        same = same & (F.col(n) == F.col(f"e_{n}"))
    joined = filled.where("row IS NOT NULL").join(F.broadcast(edges), same, "left").withColumn("found", F.coalesce("found", "e_found"))
    out = [F.col(f"row.f{i}").alias(c) for i, c in enumerate(left.columns)]
    got = joined.select(*out, *[F.col(f"found.c{i}").alias(c) for i, c in enumerate(columns)])
    without = left.where(~known(left, [*l_keys, left_time]))
    nothing = [F.lit(None).cast(right.schema[c].dataType).alias(n) for n, c in columns.items()]
    return got.unionAll(without.select(*[F.col(f"`{c}`") for c in left.columns], *nothing))


def _edges(staged: DataFrame, names: Sequence[str], found_type: T.StructType) -> DataFrame:
    """For each slice the key that the slices before it end with, and its last right row:
    one row per slice."""
    keys = F.struct(*names)
    # the last key of a slice, and the last right row with its key
    per_slice = staged.groupBy(SLICE).agg(
        F.max_by(keys, POS).alias("last"),
        F.max_by(F.struct(keys.alias("key"), F.col("found")), F.when(F.col("found").isNotNull(), F.col(POS))).alias("right"),
    )
    rows, carried = [], None
    for r in sorted(per_slice.collect(), key=lambda r: r[SLICE]):
        if carried:
            rows.append((r[SLICE], *carried[0], carried[1]))
        if r["right"] is not None and r["right"]["key"] == r["last"]:
            carried = (r["last"], r["right"]["found"])
        elif carried and carried[0] != r["last"]:
            carried = None
    kinds = [T.StructField(f"e_{n}", staged.schema[n].dataType) for n in names]
    return staged.sparkSession.createDataFrame(rows, T.StructType([T.StructField("e_slice", T.IntegerType()), *kinds, T.StructField("e_found", found_type)]))
