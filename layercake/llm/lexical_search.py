"""Ranked lexical search by NRA (no random access) over impact-sorted lists.

``build_index`` cuts a table of texts into shards of bounded size and stores for every
shard and term one list of (row, gain), the greatest gain first; a gain is a whole number
and depends on nothing that a query brings. The index is a table, which any number of
searches read.

``search`` reads the lists of the queries' terms and lets every shard resolve every query:
all lists of a query are read in step, a block at a time, in order and never by row. Each
row of the shard has an interval: the lower end sums the gains read so far, the upper end
adds, for each list that has not shown the row, the gain where that list's reading stands.
Rows whose upper end is below the kth best lower end drop out; a list is read on while
some remaining row may still be in it. The shard ends when the interval of every remaining
row has closed, so that membership, ties and scores are final; then its k best leave the
shard, and the k best of all shards are the answer.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from layercake.llm.arrow_rows import give_back, text_slices
from layercake.llm.shipping import ship
from layercake.llm.words import find_words, text_buffer
from layercake.session import write_scratch

#: Characters of text of a shard; occurrences of terms in a block of queries.
SHARD_CHARS = 8 << 20
QUERY_TERMS = 250_000
#: Entries of each list read in the first step of a search; doubled in every step.
FIRST_READ = 32

#: Bytes between terms: ASCII but letters and digits.
TERM_SEPARATORS = np.zeros(256, bool)
TERM_SEPARATORS[:128] = True
for _low, _high in (("0", "9"), ("A", "Z"), ("a", "z")):
    TERM_SEPARATORS[ord(_low) : ord(_high) + 1] = False

_INDEX = "shard long, term long, rows array<int>, gains array<long>, ids array<long>"


def _terms(texts: list[str]):
    return find_words(*text_buffer(pa.array(texts, pa.large_string())), fold_case=True, separators=TERM_SEPARATORS)


def term_counts(texts: list[str]) -> np.ndarray:
    """The number of terms of each text."""
    buffer, offsets = text_buffer(pa.array(texts, pa.large_string()))
    solid = ~TERM_SEPARATORS[buffer]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    opening = offsets[:-1][offsets[:-1] < len(buffer)]
    first[opening] = solid[opening]
    before = np.concatenate([[0], np.cumsum(first)])
    return before[offsets[1:]] - before[offsets[:-1]]


def text_lengths(docs: DataFrame, text_col: str = "text") -> tuple[int, int]:
    """The number of texts with a term, and of all their terms."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = terms = 0
        for batch in batches:
            for _, own in text_slices(batch, 0, 1 << 20):
                n = term_counts(own)
                texts, terms = texts + int((n > 0).sum()), terms + int(n.sum())
        yield pa.RecordBatch.from_pydict({"texts": pa.array([texts], pa.int64()), "terms": pa.array([terms], pa.int64())})

    source = docs.select(F.col(text_col).cast("string").alias("text")).where("text <> ''")
    row = source.mapInArrow(run, "texts long, terms long").agg(F.sum("texts").alias("texts"), F.sum("terms").alias("terms")).first()
    return int(row["texts"] or 0), int(row["terms"] or 0)


def gains(tf: np.ndarray, n: np.ndarray, texts: int, terms: int) -> np.ndarray:
    """What ``tf`` occurrences add to a text with ``n`` terms, in whole numbers."""
    length = 100 - 50 + (50 * n * texts) // terms
    return (1_000_000_000 * tf) // (1000 * tf + 20 * length)


def weight(df: int, texts: int) -> int:
    """Weight of a term that ``df`` of the ``texts`` hold."""
    return math.floor(1000 * math.log((2 * texts + 2) / (2 * df + 1)))


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, int]:
    """The index as a written table, and the number of texts with a term.

    Terms are runs of letters, digits and non-ASCII characters of the whole text, A-Z
    lower-cased, known by their 64-bit hash. A row of the table: ``shard``, ``term``, and
    the ``rows`` of the shard that hold it with their ``gains``, the greatest first, then by
    row; one more row per shard has the ``ids`` of its rows. Null and empty texts are in no
    list; repeated rows are texts of their own. An empty table gives an empty index.
    """
    ship(docs.sparkSession)
    texts, terms = text_lengths(docs, text_col)
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("text <> ''")

    def shard_rows(number: int, ids: list, tables: list) -> pa.RecordBatch:
        keys, rows, gained = (np.concatenate([t[i] for t in tables]) for i in range(3))
        order = np.lexsort((rows, -gained, keys))
        keys, rows, gained = keys[order], rows[order], gained[order]
        starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
        offsets = pa.array(np.append(np.append(starts, len(keys)), len(keys)).astype(np.int32))
        none = pa.array([None] * len(starts) + [ids], pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(starts) + 1, number, np.int64)),
                pa.array([*keys[starts].view(np.int64).tolist(), None], pa.int64()),
                pa.ListArray.from_arrays(offsets, pa.array(rows.astype(np.int32))),
                pa.ListArray.from_arrays(offsets, pa.array(gained)),
                none,
            ],
            ["shard", "term", "rows", "gains", "ids"],
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, tables, size = [], [], 0
        for batch in batches:
            for part, slice_texts in text_slices(batch, 1, 1 << 20):
                words = _terms(slice_texts)
                n = words.counts
                kinds, kind = np.unique(words.hashes, return_inverse=True)
                pairs, tf = np.unique(words.text_of * max(1, len(kinds)) + kind, return_counts=True)
                row, kind = pairs // max(1, len(kinds)), pairs % max(1, len(kinds))
                tables.append((kinds[kind], row + len(ids), gains(tf.astype(np.int64), n[row], texts, max(1, terms))))
                ids += part.column(0).to_pylist()
                size += sum(map(len, slice_texts))
                if size >= SHARD_CHARS:
                    yield shard_rows(number, ids, tables)
                    number, ids, tables, size = number + 1, [], [], 0
                    give_back()
        if ids:
            yield shard_rows(number, ids, tables)
        give_back()

    return write_scratch(source.mapInArrow(run, _INDEX), "impacts"), texts


def query_terms(queries: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int, int | None, list[int]]]]:
    """(number, id, distinct terms) of the queries that have any, in blocks of bounded size."""
    block, size, number = [], 0, 0
    for row in queries.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("text <> ''").toLocalIterator():
        own = np.unique(_terms([row["text"]]).hashes).view(np.int64).tolist()
        if not own:
            continue
        block.append((number, row["id"], own))
        number += 1
        size += len(own)
        if size >= QUERY_TERMS:
            yield block
            block, size = [], 0
    if block:
        yield block


def resolve(lists: list[tuple[np.ndarray, np.ndarray]], n_rows: int, k: int, first_read: int = FIRST_READ) -> tuple[np.ndarray, np.ndarray]:
    """Rows and scores of the ``k`` best of ``n_rows`` rows, and of all others with the kth
    best score; scores above 0 only. ``lists``: (rows, gains) of each term, by falling gain,
    no row twice. NRA: see the module."""
    lists = [(rows, gained) for rows, gained in lists if len(rows) and gained[0] > 0]
    alive = np.arange(n_rows)
    place = np.arange(n_rows)  # of each row among those alive, -1 without
    lower = np.zeros(n_rows, np.int64)
    unseen = np.ones((len(lists), n_rows), bool)
    at = np.zeros(len(lists), np.int64)
    frontier = np.array([gained[0] for _, gained in lists], np.int64)
    read = first_read
    while True:
        for t in np.flatnonzero((frontier > 0) & unseen.any(1)):
            rows, gained = lists[t]
            end = min(at[t] + read, len(rows))
            here = place[rows[at[t] : end]]
            known = here >= 0
            lower[here[known]] += gained[at[t] : end][known]
            unseen[t, here[known]] = False
            at[t] = end
            frontier[t] = gained[end] if end < len(rows) else 0
        read *= 2
        upper = lower + frontier @ unseen
        kth = np.partition(lower, len(lower) - k)[len(lower) - k] if len(lower) > k else 0
        stay = upper >= max(int(kth), 1)
        if not stay.all():
            alive, lower, upper, unseen = alive[stay], lower[stay], upper[stay], unseen[:, stay]
            place = np.full(n_rows, -1)
            place[alive] = np.arange(len(alive))
        if (lower == upper).all():
            return alive, lower


def search(index: DataFrame, texts: int, queries: DataFrame, k: int = 50, query_id: str = "item_id", query_text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The ``k`` highest-scoring texts of every query: ``query_id``, ``rank`` (from 1, no
    rank twice), ``id_col``, ``score``; equal scores by id, scores above 0 only, all if there
    are fewer. ``index``, ``texts``: from ``build_index``.

    A text's score is the sum over the query's terms, once each, of the term's weight times
    its gain. Queries without text or terms, or without hits, have no rows; queries with
    equal ids are answered each. Queries are taken in blocks of ``QUERY_TERMS`` terms: every
    block reads the lists of its terms, and no text.
    """
    spark = index.sparkSession
    ship(spark)
    out = None
    for block in query_terms(queries, query_id, query_text):
        found = _search_block(index, texts, block, k)
        out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], f"`{query_id}` long, rank int, `{id_col}` long, score long")
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    ranked = out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select(F.col("query_id").alias(query_id), "rank", F.col("id").alias(id_col), "score")


def _search_block(index: DataFrame, texts: int, block: list[tuple[int, int | None, list[int]]], k: int) -> DataFrame:
    spark = index.sparkSession
    wanted = sorted({t for _, _, own in block for t in own})
    # at most QUERY_TERMS terms and those of one query
    terms = spark.createDataFrame(pa.table({"wanted": pa.array(wanted, pa.int64())}))
    lists = index.where("term IS NOT NULL").join(F.broadcast(terms), F.col("term") == F.col("wanted"), "left_semi")
    held = lists.groupBy("term").agg(F.sum(F.size("rows")).alias("df")).collect()  # one row per wanted term
    weights = {r["term"]: w for r in held if (w := weight(r["df"], texts)) > 0}
    asked = [(number, query, [t for t in own if t in weights]) for number, query, own in block]
    shared = spark.sparkContext.broadcast((asked, weights))

    def run(shard: pa.Table) -> pa.Table:
        asked, weights = shared.value
        terms, rows, gained, ids = (shard[c].combine_chunks() for c in ("term", "rows", "gains", "ids"))
        names = pa.array(next(x for x in ids.to_pylist() if x is not None), pa.int64())
        offsets, flat_rows, flat_gains = rows.offsets.to_numpy(), rows.values.to_numpy(), gained.values.to_numpy()
        lists = {}
        for i, t in enumerate(terms.to_pylist()):
            if t in weights:
                span = slice(offsets[i], offsets[i + 1])
                lists[t] = flat_rows[span], flat_gains[span] * weights[t]
        found = [_NOTHING]
        for number, query, own in asked:
            best, scores = resolve([lists[t] for t in own if t in lists], len(names), k)
            hits = pa.table({"id": names.take(pa.array(best)), "score": pa.array(scores)})
            hits = hits.take(pc.sort_indices(hits, [("score", "descending"), ("id", "ascending")])[:k])
            n = hits.num_rows
            found.append(pa.table({"query": pa.array([number] * n, pa.int64()), "query_id": pa.array([query] * n, pa.int64()), "id": hits["id"], "score": hits["score"]}))
        give_back()
        return pa.concat_tables(found)

    both = lists.unionByName(index.where("ids IS NOT NULL"))
    return both.groupBy("shard").applyInArrow(run, "query long, query_id long, id long, score long")


_NOTHING = pa.table({c: pa.array([], pa.int64()) for c in ("query", "query_id", "id", "score")})
