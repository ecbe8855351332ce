"""Sharding by Karmarkar-Karp differencing.

Texts that are equal form a group that no shard may split. Differencing keeps partial
partitions (one sum per shard) and repeatedly combines the two with the largest spread,
the largest sums of one with the smallest of the other. Every task differences its own
groups to one partial partition; the few partial partitions, one per task, are combined
the same way, so that the result is one partition of all groups.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layercake.llm.arrow_rows import give_back
from layercake.llm.shipping import ship
from layercake.session import write_scratch


def differencing(parts: np.ndarray) -> np.ndarray:
    """Combine partial partitions (rows of sums over k slots) to one. Returns, for each
    row and slot, the slot of the result that it goes to. Deterministic."""
    n, k = parts.shape
    if n == 0:
        return np.zeros((0, k), np.int32)
    sums: list = [p.astype(np.int64) for p in parts]
    children: list = [None] * n
    heap = [(-int(s.max() - s.min()), i) for i, s in enumerate(sums)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        down, up = np.argsort(-sums[a], kind="stable"), np.argsort(sums[b], kind="stable")
        joined = sums[a][down] + sums[b][up]
        children.append((a, down.astype(np.int32), b, up.astype(np.int32)))
        sums[a] = sums[b] = None
        sums.append(joined)
        heapq.heappush(heap, (-int(joined.max() - joined.min()), len(sums) - 1))
    slots: list = [None] * len(sums)
    slots[-1] = np.arange(k, dtype=np.int32)
    for node in range(len(sums) - 1, n - 1, -1):
        a, down, b, up = children[node]
        for child, order in ((a, down), (b, up)):
            slots[child] = np.empty(k, np.int32)
            slots[child][order] = slots[node]
        slots[node] = None
    return np.array(slots[:n])


def assign_items(sizes: np.ndarray, k: int) -> np.ndarray:
    """Slot of each item under differencing."""
    parts = np.zeros((len(sizes), k), np.int64)
    parts[:, 0] = sizes
    return differencing(parts)[:, 0]


def shard_by_bytes(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", overhead: int = 16) -> DataFrame:
    """``id_col``, ``size`` (UTF-8 bytes of the text plus ``overhead``), ``text_crc32``,
    ``shard`` (0 .. shards - 1, byte sums near equal) and ``slot`` (from 0 without gaps
    within the shard) for every row; equal texts share a shard.

    A null text has no bytes and is one group with the empty text. Null and repeated ids
    and repeated rows are rows like others. An empty table gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    thin = docs.select(
        F.col(id_col).cast("long").alias("id"),
        (F.octet_length(text) + F.lit(overhead)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.unhex(F.md5(text)).alias("group"),
    )
    # rows are numbered within parts of a group, as many as tasks: a hot group is spread
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    thin = thin.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(tasks)).cast("int"))
    counts = thin.groupBy("group", "part").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"))
    groups = counts.groupBy("group").agg(F.sum("n").alias("n"), F.sum("size").alias("size"), F.array_sort(F.collect_list(F.struct("part", "n"))).alias("parts"))

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if table is None or not table.num_rows:
            return
        table = table.sort_by("group")
        n, sizes = table["n"].to_numpy(), table["size"].to_numpy()
        slot = assign_items(sizes, shards)
        order = np.argsort(slot, kind="stable")
        before = np.cumsum(n[order]) - n[order]
        opening = np.searchsorted(slot[order], np.arange(shards))
        first = np.empty(len(n), np.int64)
        first[order] = before - np.append(before, 0)[opening][slot[order]]
        # each part's rows begin where the earlier parts of its group end
        parts = table["parts"].combine_chunks()
        own = parts.flatten().field("n").to_numpy()
        begin = np.cumsum(n) - n  # of each group among all rows, as the parts lie
        part_first = np.cumsum(own) - own + np.repeat(first - begin, np.diff(parts.offsets.to_numpy()))
        starts = pa.ListArray.from_arrays(parts.offsets, pa.StructArray.from_arrays([parts.flatten().field("part"), pa.array(part_first)], ["part", "first"]))
        task = pa.array(np.full(len(n), TaskContext.get().partitionId(), np.int32))
        out = pa.table({"task": task, "bin": pa.array(slot.astype(np.int32)), "group": table["group"], "n": table["n"], "size": table["size"], "parts": starts})
        yield from out.combine_chunks().to_batches()
        give_back()

    placed = write_scratch(groups.mapInArrow(place, "task int, bin int, group binary, n long, size long, parts array<struct<part:int,first:long>>"), "placed")
    # one row per task and bin: the partial partitions
    bins = placed.groupBy("task", "bin").agg(F.sum("size").alias("size"), F.sum("n").alias("n")).toPandas()
    tasks = sorted(set(bins["task"]))
    row = bins["task"].map({t: i for i, t in enumerate(tasks)}).to_numpy(int)
    sums, rows = np.zeros((2, len(tasks), shards), np.int64)
    sums[row, bins["bin"]], rows[row, bins["bin"]] = bins["size"], bins["n"]
    to = differencing(sums)
    final, used = [], np.zeros(shards, np.int64)
    for i, task in enumerate(tasks):
        for b in range(shards):
            final.append((int(task), b, int(to[i, b]), int(used[to[i, b]])))
            used[to[i, b]] += rows[i, b]
    merged = F.broadcast(spark.createDataFrame(final, "task int, bin int, shard int, base long"))  # tasks x shards rows
    offsets = placed.join(merged, ["task", "bin"]).withColumn("one", F.explode("parts"))
    offsets = offsets.select("group", F.col("one.part").alias("part"), "shard", (F.col("base") + F.col("one.first")).alias("from"))
    number = F.expr("row_number() OVER (PARTITION BY group, part ORDER BY id, size)")
    return thin.join(offsets, ["group", "part"]).select(F.col("id").alias(id_col), "size", "text_crc32", "shard", (F.col("from") + number - 1).cast("long").alias("slot"))
