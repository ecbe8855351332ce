"""Suffix-array dedup with a sparse suffix array.

Of all suffixes only those that start at content-selected positions are kept: the
minimisers, the smallest hash of ``GRAM`` words among ``CHOICE`` neighbouring ones. Two
equal stretches of CHOICE + GRAM - 1 words select the same position, so that any repeat
of ``min_words`` words has a selected suffix in its first CHOICE words at both places.

The suffixes are sorted by their first BLOCKS blocks of GRAM words and compared with
their neighbours; around those that agree with one, the match is extended to the left
and right: windows of ``min_words`` words are compared, and overlapping repeated windows
join to maximal repeats. Sorting is dealt over hash ranges of the first block; equal
suffixes of a chunk are sent once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layercake.llm import exchange as X
from layercake.llm.shipping import ship
from layercake.llm.words import find_words, text_buffer, window_hashes

GRAM = 8
CHOICE = 18
BLOCKS = 3
_NO_ID = np.iinfo(np.int64).max
_LEAST = np.iinfo(np.int64).min


def select_minimisers(hashes: np.ndarray, text_of: np.ndarray) -> np.ndarray:
    """Places whose hash is the first smallest of some CHOICE neighbours of one text."""
    n = len(hashes) - CHOICE + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    view = np.lib.stride_tricks.sliding_window_view(hashes, CHOICE)
    inside = np.flatnonzero(text_of[:n] == text_of[CHOICE - 1 :])
    best = [part + view[part].argmin(axis=1) for part in np.array_split(inside, max(1, len(inside) // 50_000))]
    return np.unique(np.concatenate(best)) if best else np.zeros(0, np.int64)


class _Chunk:
    def __init__(self, docs: pa.Table, min_words: int):
        self.min_words = min_words
        self.words = find_words(*text_buffer(docs["__text"]))
        self.ids = docs["__id"].fill_null(_NO_ID).to_numpy().astype(np.int64)
        keys, at = window_hashes(self.words, GRAM)
        text_of = self.words.text_of
        chosen = select_minimisers(keys, text_of[at])
        # the suffix needs BLOCKS whole blocks within its text
        where = at[chosen]
        enough = where + GRAM * BLOCKS <= self.words.bounds[text_of[where] + 1]
        chosen, self.at = chosen[enough], where[enough]
        blocks = [keys[chosen + GRAM * b] for b in range(BLOCKS)]
        suffixes = np.stack([blocks[0], *[X.short(b, 32) for b in blocks[1:]]], 1) if len(chosen) else np.zeros((0, BLOCKS), np.uint64)
        order = np.lexsort(suffixes.T[::-1])
        ordered = suffixes[order]
        new = np.ones(len(order), bool)
        new[1:] = (ordered[1:] != ordered[:-1]).any(1)
        self.rows = ordered[new]
        self.place = np.empty(len(order), np.int64)
        self.place[order] = np.cumsum(new) - 1
        self.repeated = np.bincount(self.place, minlength=len(self.rows)) > 1

    def candidates(self, hits: np.ndarray) -> None:
        """Windows that may hold a repeat around the suffixes that agree with a neighbour."""
        keys, at = window_hashes(self.words, self.min_words)
        text_of = self.words.text_of
        edges = np.zeros(len(text_of) + 1, np.int64)
        near = self.at[hits[self.place] > 0]
        np.add.at(edges, np.maximum(near - CHOICE + 1, self.words.bounds[text_of[near]]), 1)
        np.add.at(edges, near + 1, -1)
        use = (np.cumsum(edges) > 0)[at]
        self.full_at = at[use]
        self.full_keys, self.full_place = np.unique(keys[use], return_inverse=True)
        ids = self.ids[text_of[self.full_at]]
        self.low, self.high = np.full(len(self.full_keys), _NO_ID), np.full(len(self.full_keys), _LEAST)
        np.minimum.at(self.low, self.full_place, ids)
        np.maximum.at(self.high, self.full_place, ids)
        self.full_ids = ids

    def covered(self, windows: np.ndarray) -> np.ndarray:
        edges = np.zeros(len(self.words.hashes) + 1, np.int64)
        np.add.at(edges, self.full_at[windows], 1)
        np.add.at(edges, self.full_at[windows] + self.min_words, -1)
        return np.cumsum(edges)[:-1] > 0


def find_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 50) -> DataFrame:
    """``id_col``, ``n_words``, ``n_repeated`` (words in passages of at least
    ``min_words`` words that a text with another id has too), ``n_removable`` (words in
    those that a text with a smaller id has) and ``spans`` (the maximal repeated passages
    as words ``[first, end)``) of every text.

    Words are compared as they are. Null, empty and shorter texts repeat nothing; null
    ids count as one id after all others; repeats within one id do not count; an empty
    table gives no rows; other columns are ignored.
    """
    if min_words < CHOICE - 1 + GRAM * BLOCKS:
        raise ValueError(f"min_words must be at least {CHOICE - 1 + GRAM * BLOCKS}")
    ship(docs.sparkSession)
    layout = X.layout_of(docs, text_col)
    buckets = layout.buckets
    rows = X.dealt(docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).cast("string").alias("__text")), layout, ["__id", "__text"])
    by_chunk = rows.groupBy("chunk")

    def send_suffixes(docs: pa.Table) -> pa.Table:
        chunk = _Chunk(docs, min_words)
        values = [chunk.rows[:, b].astype("u4") for b in range(1, BLOCKS)] + [chunk.repeated.astype("u1")]
        return X.blocks_table(docs["chunk"][0].as_py(), chunk.rows[:, 0].copy(), values, 64, buckets)

    def compare_neighbours(blocks: pa.Table) -> pa.Table:
        found = X.gather(blocks, ["u4"] * (BLOCKS - 1) + ["u1"])
        order = np.lexsort((*found.values[: BLOCKS - 1][::-1], found.keys))
        suffix = np.stack([found.keys, *[v.astype(np.uint64) for v in found.values[: BLOCKS - 1]]], 1)[order]
        same = (suffix[1:] == suffix[:-1]).all(1)
        agrees = found.values[-1][order] > 0
        agrees[1:] |= same
        agrees[:-1] |= same
        hit = np.empty(len(order), np.uint8)
        hit[order] = agrees
        return X.answers_table(found, blocks["bucket"][0].as_py(), (X.pack([h]) for h in np.split(hit, np.cumsum(found.sizes)[:-1])))

    def send_windows(docs: pa.Table, answers: pa.Table) -> pa.Table:
        chunk = _Chunk(docs, min_words)
        chunk.candidates(X.answered(answers, ["u1"])[0])
        return X.blocks_table(docs["chunk"][0].as_py(), chunk.full_keys, [chunk.low, chunk.high], 64, buckets)

    def compare_windows(blocks: pa.Table) -> pa.Table:
        found = X.gather(blocks, ["i8", "i8"])
        low, high = found.values[0][found.order], found.values[1][found.order]
        if len(low):
            low, high = np.minimum.reduceat(low, found.firsts), np.maximum.reduceat(high, found.firsts)
        shared = (low < high).astype(np.uint8)
        answers = []
        at = 0
        for flags, least in zip(found.back(shared), found.back(low), strict=True):
            own = found.values[0][at : at + len(flags)]
            at += len(flags)
            answers.append(X.pack([flags | ((least < own).astype(np.uint8) << 1)]))
        return X.answers_table(found, blocks["bucket"][0].as_py(), answers)

    def finish(docs: pa.Table, answers: pa.Table) -> pa.Table:
        chunk = _Chunk(docs, min_words)
        first = pa.compute.equal(answers["step"], 1)
        chunk.candidates(X.answered(answers.filter(first), ["u1"])[0])
        flags = X.answered(answers.filter(pa.compute.invert(first)), ["u1"])[0][chunk.full_place]
        repeated = chunk.covered((flags & 1) > 0)
        later = chunk.covered(((flags & 2) > 0) | (chunk.low[chunk.full_place] < chunk.full_ids))
        bounds = chunk.words.bounds
        spans = []
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            edges = np.flatnonzero(np.diff(repeated[a:b].astype(np.int8), prepend=0, append=0))
            spans.append([{"first": int(x), "end": int(y)} for x, y in edges.reshape(-1, 2)])

        def per_text(x: np.ndarray) -> pa.Array:
            sums = np.concatenate([[0], np.cumsum(x)])
            return pa.array(sums[bounds[1:]] - sums[bounds[:-1]])

        return pa.table({"__id": docs["__id"], "n_words": pa.array(np.diff(bounds)), "n_repeated": per_text(repeated), "n_removable": per_text(later), "spans": pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())])))})

    hits = by_chunk.applyInArrow(send_suffixes, X.BLOCKS).groupBy("bucket").applyInArrow(compare_neighbours, X.ANSWERS)
    windows = by_chunk.cogroup(hits.groupBy("chunk")).applyInArrow(send_windows, X.BLOCKS).groupBy("bucket").applyInArrow(compare_windows, X.ANSWERS)
    answers = hits.withColumn("step", F.lit(1)).unionByName(windows.withColumn("step", F.lit(2)))
    done = by_chunk.cogroup(answers.groupBy("chunk")).applyInArrow(finish, "`__id` long, n_words long, n_repeated long, n_removable long, spans array<struct<first:int,end:int>>")
    return done.withColumnRenamed("__id", id_col)
