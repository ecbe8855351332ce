"""Exact top-k search by distributed histogram selection.

Queries are taken in blocks of bounded size. For a block, every round scores all vectors
and counts the scores of each query in equal bins of the interval that holds its kth
highest score; the bin with the kth becomes the next interval, until it is one score
wide. A last pass keeps what is above that score, and of the equal ones the smallest ids
that still fit. Rows are never sorted or collected whole.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layercake.llm.shipping import ship
from layercake.session import write_scratch

#: Queries of one block; bins of a round; vectors scored at a time.
QUERY_BLOCK = 2048
BINS = 256
_ROWS = 1024
#: Bounds of the products below which doubles and 64-bit integers are exact.
_EXACT, _WHOLE = 2.0**53, 2.0**63
_SIGN = np.uint64(1 << 63)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), dim)


def whole_components(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """``id`` and ``v``: floor(scale * x) of every component as double; rows with a null
    id, a null vector, or a null or non-finite component are left out, empty vectors too.
    Repeated ids are rows of their own."""
    def scaled(c: Column) -> Column:
        y = c.cast("double") * F.lit(float(scale))
        y = F.greatest(F.least(y, F.lit(1.7e308)), F.lit(-1.7e308))
        return F.when(F.abs(y) < _EXACT, F.floor(y).cast("double")).otherwise(y)  # larger doubles are whole

    x = F.transform(F.col(vec_col), scaled)
    finite = F.forall(F.col(vec_col), lambda c: F.coalesce(F.abs(c.cast("double")) < F.lit(float("inf")), F.lit(False)))
    valid = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias(vec_col)).where(F.col("id").isNotNull() & F.col(vec_col).isNotNull() & (F.size(vec_col) > 0) & finite)
    return valid.select("id", x.alias("v")).withColumn("dim", F.size("v"))


def _norm(matrix: np.ndarray) -> float:
    return float(np.sqrt((matrix * matrix).sum(1).max())) if len(matrix) else 0.0


def _scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Integer inner products, exact; beyond 64 bits the nearest that fits."""
    bound = _norm(queries) * _norm(rows) * 1.001
    if bound < _EXACT:
        return (queries @ rows.T).astype(np.int64)
    if bound < _WHOLE:
        return queries.astype(np.int64) @ rows.astype(np.int64).T
    whole = [np.array([[int(x) for x in line] for line in m], object).reshape(m.shape) for m in (queries, rows)]
    return np.clip(whole[0] @ whole[1].T, -(2**63), 2**63 - 1).astype(np.int64)


def _keys(scores: np.ndarray) -> np.ndarray:
    """Unsigned numbers in the order of the scores, so that differences fit 64 bits."""
    return scores.view(np.uint64) ^ _SIGN


def _blocks(batches: Iterable[pa.RecordBatch], dim: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            part = batch.slice(at, _ROWS)
            yield part.column(0).to_numpy(zero_copy_only=False), part.column(1).to_numpy(zero_copy_only=False), _matrix(part.column(2), dim)


def top_k(vectors: DataFrame, is_query: Callable, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 1024) -> DataFrame:
    """The ``k`` highest integer inner products of every query with all other vectors:
    ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``; ties to the smaller id; all
    candidates if there are fewer than ``k``.

    Queries are the rows for which ``is_query(id column)`` holds. See
    ``whole_components`` for rows that take no part; vectors are compared with those of
    the same number of components. Rows with equal ids are each a query, and candidates of
    each other. Scores beyond 64 bits are the nearest that fit. Queries without candidates,
    and an empty table, give no rows.
    """
    spark = vectors.sparkSession
    ship(spark)
    whole = whole_components(vectors, id_col, vec_col, scale).withColumn("row", F.monotonically_increasing_id())
    table = write_scratch(whole.withColumn("is_query", is_query(F.col("id"))), "whole")
    largest = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, c: s + c * c))
    sizes = table.groupBy("dim").agg(F.max(largest).alias("norm"), F.count_if("is_query").alias("queries")).where("queries > 0").orderBy("dim").collect()
    out = spark.createDataFrame([], "query long, query_id long, vec_id long, score long")
    for size in sizes:  # one row per number of components
        blocks = math.ceil(size["queries"] / QUERY_BLOCK)
        same = table.where(F.col("dim") == size["dim"])
        for block in range(blocks):
            asked = same.where(F.col("is_query") & (F.pmod(F.xxhash64("row"), F.lit(blocks)) == block)).select("id", "row", "v").orderBy("row").toArrow()
            out = out.unionByName(_search(same.select("id", "row", "v"), asked, k, size["dim"], size["norm"]))
    rank = F.expr("row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id)").cast("int")
    return out.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _search(rows: DataFrame, asked: pa.Table, k: int, dim: int, norm: float) -> DataFrame:
    """Rows that can be among the k best of the queries of one block."""
    spark = rows.sparkSession
    ids, numbers = asked["id"].to_numpy(), asked["row"].to_numpy()
    queries = _matrix(asked["v"].combine_chunks(), dim)
    shared = spark.sparkContext.broadcast((ids, numbers, queries))  # about QUERY_BLOCK vectors
    # the interval of the kth, ends included: no product is larger than the norms'
    bound = _norm(queries) * norm * 1.001 + 1
    ends = np.array([-bound, bound] if bound < _WHOLE / 2 else [-(2**63), 2**63 - 1], np.int64)
    low, high = (np.full(len(ids), key) for key in _keys(ends))
    above = np.zeros(len(ids), np.int64)  # scores known to be over high
    all_fit = np.zeros(len(ids), bool)  # fewer than k candidates
    first = True

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        _, own, matrix = shared.value
        for names, row, block in _blocks(batches, dim):
            scores = _keys(_scores(matrix, block))
            at = np.minimum(np.searchsorted(own, row), max(0, len(own) - 1))
            itself = np.zeros(scores.shape, bool)
            mine = np.flatnonzero(own[at] == row)
            itself[at[mine], mine] = True
            yield names, scores, ~itself

    while len(ids) and ((high > low) & ~all_fit).any():
        width = (high - low) // np.uint64(BINS) + np.uint64(1)

        def histogram(batches: Iterable[pa.RecordBatch], low=low, high=high, width=width) -> Iterator[pa.RecordBatch]:
            counts = np.zeros((len(low), BINS), np.int64)
            for _, scores, others in scored(batches):
                inside = others & (scores >= low[:, None]) & (scores <= high[:, None])
                query, column = np.nonzero(inside)
                bins = ((scores[query, column] - low[query]) // width[query]).astype(np.int64)
                counts += np.bincount(query * BINS + bins, minlength=counts.size).reshape(counts.shape)
            # bins below a task's own kth highest cannot hold the kth of all
            over = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1] - counts
            query, bins = np.nonzero((counts > 0) & (over < k))
            yield pa.RecordBatch.from_arrays([pa.array(query, pa.int32()), pa.array(bins, pa.int32()), pa.array(counts[query, bins])], ["query", "bin", "n"])

        found = rows.mapInArrow(histogram, "query int, bin int, n long").groupBy("query", "bin").agg(F.sum("n").alias("n"))
        # per query only the bins down to its kth: at most k rows each
        over = F.expr("sum(n) OVER (PARTITION BY query ORDER BY bin DESC) - n")
        top = found.withColumn("over", over).where(F.col("over") < k).toPandas()
        counts = np.zeros((len(ids), BINS), np.int64)
        counts[top["query"], top["bin"]] = top["n"]
        total = above + np.cumsum(counts[:, ::-1], axis=1)[:, ::-1].T  # at or over each bin
        total = total.T
        enough = total >= k
        all_fit |= ~enough[:, 0] & first  # later rounds know that the interval has the kth
        first = False
        best = np.where(enough.any(1), BINS - 1 - np.argmax(enough[:, ::-1], axis=1), 0)
        at = np.arange(len(ids))
        go = enough.any(1)
        above = np.where(go, total[at, best] - counts[at, best], above)
        step = best.astype(np.uint64) * width
        high = np.where(go, low + np.minimum(step + (width - np.uint64(1)), high - low), high)
        low = np.where(go, low + step, low)
    kth = np.where(all_fit, np.uint64(0), low)
    need = k - above

    def last(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, own, _ = shared.value

        def found(query: np.ndarray, names: np.ndarray, keys: np.ndarray) -> pa.RecordBatch:
            scores = (keys ^ _SIGN).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(own[query]), pa.array(ids[query]), pa.array(names), pa.array(scores)], ["query", "query_id", "vec_id", "score"])

        ties: list[tuple[np.ndarray, np.ndarray]] = []
        for names, scores, others in scored(batches):
            query, column = np.nonzero(others & (scores > kth[:, None]))
            yield found(query, names[column], scores[query, column])
            query, column = np.nonzero(others & (scores == kth[:, None]))
            ties.append((query, names[column]))
            if sum(len(q) for q, _ in ties) > 1_000_000:
                ties = [_smallest(ties, need)]
        query, names = _smallest(ties, need)
        yield found(query, names, kth[query])

    return rows.mapInArrow(last, "query long, query_id long, vec_id long, score long")


def _smallest(ties: list[tuple[np.ndarray, np.ndarray]], need: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the equal scores of each query, the smallest ids that can still fit."""
    query = np.concatenate([np.zeros(0, np.int64), *[q for q, _ in ties]])
    names = np.concatenate([np.zeros(0, np.int64), *[x for _, x in ties]])
    order = np.lexsort((names, query))
    query, names = query[order], names[order]
    nth = np.arange(len(query)) - np.searchsorted(query, query)
    return query[nth < need[query]], names[nth < need[query]]
