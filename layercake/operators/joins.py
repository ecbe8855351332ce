"""Left enrichment joins that stay balanced under NULL and hot keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _hinted(right: DataFrame, broadcast: bool | str) -> DataFrame:
    if broadcast is True:
        return F.broadcast(right)
    return right.hint("merge") if broadcast is False else right


def _key_text(parts: Sequence[Column]) -> Column:
    """'=' and the key as text, NULL if a part is; lengths keep the parts apart."""
    one = [c.cast("string") for c in parts]
    return F.concat(F.lit("="), *[F.concat(F.length(c).cast("string"), F.lit(":"), c) for c in one[:-1]], one[-1])


def _spread_null_keys(
    left: DataFrame, right: DataFrame, left_on: Sequence[Column], right_on: Sequence[Column], broadcast: bool | str
) -> DataFrame:
    """Left join in which left rows with a NULL key, which can never match, get a key of
    their own instead of all hashing to one partition.

    Join keys are texts: '=' + key on both sides; a left row with a NULL in its key has
    '!' + a hash of the row. No right row has such a text, and a NULL right key stays
    NULL, so matching is unchanged. The left text depends on the whole row, so that two
    chained joins never share one shuffle, which would keep AQE from splitting the
    partitions of a hot key.
    """
    if any(_holds_map(f.dataType) for f in left.schema.fields):
        hashed = [F.col(f"`{f.name}`") for f in left.schema.fields if not _holds_map(f.dataType) and left.columns.count(f.name) == 1]
        row = F.xxhash64(F.lit(0), *hashed)
    else:
        row = F.xxhash64(F.col("*"))  # star: safe with duplicate column names
    own = F.concat(F.lit("!"), row.cast("string"))
    keyed = left.withColumn("__lc_own", own).withColumn("__lc_left", F.coalesce(_key_text(left_on), F.col("__lc_own")))
    others = right.withColumn("__lc_right", _key_text(right_on))
    joined = keyed.join(_hinted(others, broadcast), on=F.col("__lc_left") == F.col("__lc_right"), how="left")
    return joined.drop("__lc_own", "__lc_left", "__lc_right")


def _holds_map(kind: T.DataType) -> bool:
    """Whether a type has no hash: maps and variants, at any depth."""
    if isinstance(kind, T.StructType):
        return any(_holds_map(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _holds_map(kind.elementType)
    return isinstance(kind, (T.MapType, T.VariantType))


def _compares_as_text(left: DataFrame, left_key: Column, right: DataFrame, right_key: Column) -> bool:
    """Whether two keys are equal exactly if their texts are: whole numbers of any width, or
    plain strings (a collation may equate different texts). Not a number and a string: a
    join compares them as numbers."""
    one, other = left.select(left_key).schema[0].dataType, right.select(right_key).schema[0].dataType
    if isinstance(one, T.IntegralType):
        return isinstance(other, T.IntegralType)
    return one == other == T.StringType()


def enrich_left(
    left: DataFrame,
    right: DataFrame,
    on: Column | Sequence[str] | None = None,
    *,
    left_on: Sequence[Column] | None = None,
    right_on: Sequence[Column] | None = None,
    broadcast: bool | str = "auto",
) -> DataFrame:
    """LEFT OUTER equi-join that keeps every left row.

    NULL keys never match, unmatched rows get NULL attributes, duplicate right
    keys fan out (nothing is deduplicated here). Give the keys either as ``on``
    (a condition or column names) or as ``left_on`` / ``right_on`` column lists;
    with the latter, keys of one kind on both sides, text or whole numbers, are spread (see
    ``_spread_null_keys``): NULL-key rows go to many tasks, and AQE can split a hot
    key's partition in every join of a chain.

    ``broadcast``:
      * True  -- caller vouches for the right side's size (a fixed lookup);
      * False -- always a sort-merge join;
      * "auto" -- Spark decides, by the size of the files that the right side reads
        or, at run time, by its real shuffle size. Nothing is computed for it.
    """
    if (on is None) == (left_on is None or right_on is None):
        raise ValueError("give either `on` or both `left_on` and `right_on`")
    if on is not None:
        return left.join(_hinted(right, broadcast), on=on, how="left")
    pairs = list(zip(left_on, right_on, strict=True))
    if broadcast is not True and all(_compares_as_text(left, lc, right, rc) for lc, rc in pairs):
        return _spread_null_keys(left, right, left_on, right_on, broadcast)
    return left.join(_hinted(right, broadcast), on=reduce(and_, [lc == rc for lc, rc in pairs]), how="left")
