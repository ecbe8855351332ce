"""Types that the values of a CSV source need, compared with the catalog.

Every value needs one of the types NONE < LONG < DOUBLE < TEXT; a column needs the greatest
that one of its values needs. The greatest of parts is the greatest of the whole, so that
all columns are judged by one aggregation with partial results per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layercake.sources.catalog import DatasetSpec
from layercake.sources.csv import FILE, LINE, read_csv_text

#: The types in their order.
LATTICE = ("NONE", "LONG", "DOUBLE", "TEXT")


class TypeDriftError(ValueError):
    """Values of a source do not fit the declared types."""


def needed(c: Column) -> Column:
    """The place in ``LATTICE`` of the type that a text value needs."""
    # a type letter at the end is a number to the JVM alone
    number = c.try_cast("double").isNotNull() & ~c.rlike("[dDfF][\\x00-\\x20]*$")
    return F.when(c.isNull(), 0).when(c.try_cast("bigint").isNotNull(), 1).when(number, 2).otherwise(3)


def _declared(kind: T.DataType) -> int:
    if isinstance(kind, T.IntegralType):
        return 1
    return 2 if isinstance(kind, T.NumericType) else 3


def type_drift(spark: SparkSession, path: str, spec: DatasetSpec, *, multi_line: bool | None = None) -> DataFrame:
    """One row per column of ``spec``: ``column``, ``declared`` and ``needed`` type,
    ``values`` (that are not missing), ``misfits`` (values that need a greater type than the
    declared one), and the first of them with its ``file`` and ``line``."""
    text = read_csv_text(spark, path, spec, multi_line=multi_line)
    names = [c for c in text.columns if c not in (FILE, LINE)]
    fields = list(zip(names, [_declared(f.dataType) for f in spec.schema.fields], strict=True))
    ranked = text.select(FILE, LINE, *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)]).withColumns({f"n{i}": needed(F.col(f"c{i}")) for i in range(len(names))})
    aggregates = []
    for i, (_, declared) in enumerate(fields):
        misfit = F.col(f"n{i}") > declared
        place = F.struct(F.col(FILE).alias("file"), F.col(LINE).alias("line"), F.col(f"c{i}").alias("value"))
        aggregates += [F.max(f"n{i}").alias(f"n{i}"), F.count(f"c{i}").alias(f"v{i}"), F.count_if(misfit).alias(f"m{i}"), F.min(F.when(misfit, place)).alias(f"f{i}")]
    lattice = F.array(*[F.lit(t) for t in LATTICE])
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("column"),
                F.lit(LATTICE[declared]).alias("declared"),
                F.element_at(lattice, F.coalesce(f"n{i}", F.lit(0)) + 1).alias("needed"),
                F.col(f"v{i}").alias("values"),
                F.col(f"m{i}").alias("misfits"),
                F.col(f"f{i}.value").alias("first_value"),
                F.col(f"f{i}.file").alias("file"),
                F.col(f"f{i}.line").alias("line"),
            )
            for i, (name, declared) in enumerate(fields)
        ]
    )
    return ranked.agg(*aggregates).select(F.inline(rows))


def check_types(spark: SparkSession, path: str, spec: DatasetSpec, *, multi_line: bool | None = None) -> None:
    """Raise ``TypeDriftError`` naming the columns whose values do not fit, if there are any."""
    found = type_drift(spark, path, spec, multi_line=multi_line).where("misfits > 0").collect()  # one row per column
    if found:
        told = [f"{r['column']} is {r['declared']} but {r['misfits']} of {r['values']} values need {r['needed']}, first {r['first_value']!r} in {r['file']} line {r['line']}" for r in found]
        raise TypeDriftError(f"{spec.qualified}: " + "; ".join(told))
