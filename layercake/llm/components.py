"""Connected components of an edge table, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layercake.session import write_scratch


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) for every node in ``edges``
    (columns ``a`` and ``b`` of one orderable type; repeated and reversed rows are fine;
    no edges give no rows).

    Each round every node takes the smallest label among its own and its neighbours',
    then the label of that label, until nothing changes. Labels are written to the
    shared scratch folder between rounds, so that a lost executor costs one round.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = write_scratch(both.where("a != b").distinct(), "edges")
    labels = write_scratch(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("root")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        near = write_scratch(near, "near")
        hooked = labels.join(near, "node").select("node", F.col("root").alias("before"), F.least("root", "near").alias("hook"))
        jump = labels.select(F.col("node").alias("hook"), F.col("root").alias("beyond"))
        after = write_scratch(hooked.join(jump, "hook", "left").select("node", "before", F.least("hook", F.coalesce("beyond", "hook")).alias("root")), "labels")
        if after.where("root != before").isEmpty():
            return after.select("node", "root")
        labels = after.select("node", "root")
