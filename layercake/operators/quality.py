"""Data-quality rules evaluated in one distributed pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def check_rules(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One row per rule: ``rule``, ``violations`` (predicate FALSE), ``unknown``
    (predicate NULL) and ``checked`` (rows seen), all BIGINT.

    All rules are counted in a single aggregation (partial counts per task, one
    tiny final merge), so the cost is one scan whatever the number of rules.
    """
    if not rules:
        raise ValueError("check_rules needs at least one rule")
    aggs = [F.count(F.lit(1)).alias("checked")]
    for i, pred in enumerate(rules.values()):
        aggs.append(F.count_if(~pred).alias(f"v{i}"))
        aggs.append(F.count_if(pred.isNull()).alias(f"u{i}"))
    totals = df.agg(*aggs)
    per_rule = F.array(
        *[
            F.struct(
                F.lit(name).alias("rule"),
                F.col(f"v{i}").alias("violations"),
                F.col(f"u{i}").alias("unknown"),
            )
            for i, name in enumerate(rules)
        ]
    )
    return totals.select(F.inline(per_rule), F.col("checked"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys present more than once: ``keys..., copies`` (a shuffle on ``keys``
    after map-side partial counts, so a hot key costs one row per task)."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("copies"))
        .where(F.col("copies") > 1)
    )
