"""Substring dedup by fixed-block anchors.

Every text is cut into non-overlapping reference blocks of ``block`` words; the blocks
are the index. Every rolling window of ``block`` words of every text probes it. A repeat
of ``window >= 2 * block - 1`` words always holds one whole reference block, so that each
of its occurrences has a hit. Around the hits only, the windows of ``window`` words are
compared, and overlapping repeated windows join to maximal repeats.

Both lookups go through the packed exchange: a passage that a third of all texts share
is sent once per chunk, never as pairs of texts.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layercake.llm import exchange as X
from layercake.llm.shipping import ship
from layercake.llm.words import find_words, text_buffer, window_hashes

#: Null ids come after every id.
_NO_ID = np.iinfo(np.int64).max


def _ids(column: pa.ChunkedArray) -> np.ndarray:
    return column.fill_null(_NO_ID).to_numpy().astype(np.int64)


def _spread(flags: np.ndarray, width: int) -> np.ndarray:
    """True at p if any flag is set at p .. p + width - 1."""
    sums = np.concatenate([[0], np.cumsum(flags), np.full(width, flags.sum())])
    return sums[width : width + len(flags)] > sums[: len(flags)]


class _Chunk:
    """Words and window keys of one chunk, rebuilt by each pass from the same rows."""

    def __init__(self, docs: pa.Table, window: int, block: int, bits: int):
        # nothing may depend on the order in which a shuffle delivers the rows
        self.docs = docs
        self.window, self.block, self.bits = window, block, bits
        self.buffer, self.offsets = text_buffer(docs["__text"])
        self.words = find_words(self.buffer, self.offsets)
        self.ids = _ids(docs["__id"])
        keys, self.at = window_hashes(self.words, block)
        self.keys, self.place = np.unique(X.short(keys, bits), return_inverse=True)

    def anchors(self) -> list[np.ndarray]:
        """Per key: 1 if a reference block has it, plus 2 if texts of two ids have it."""
        text = self.words.text_of[self.at]
        low, high = np.full(len(self.keys), _NO_ID), np.full(len(self.keys), np.iinfo(np.int64).min)
        np.minimum.at(low, self.place, self.ids[text])
        np.maximum.at(high, self.place, self.ids[text])
        flags = np.where(low < high, 2, 0).astype(np.uint8)
        is_block = (self.at - self.words.bounds[text]) % self.block == 0
        flags[self.place[is_block]] |= 1
        return [flags]

    def candidates(self, hits: np.ndarray) -> None:
        """Full keys of the windows that hold a hit, with the smallest id of each."""
        hit = np.zeros(len(self.words.hashes), bool)
        hit[self.at] = hits[self.place].astype(bool)
        keys, at = window_hashes(self.words, self.window)
        near = _spread(hit, self.window - self.block + 1)[at]
        self.full_at = at[near]
        self.full_keys, self.full_place = np.unique(keys[near], return_inverse=True)
        self.full_ids = self.ids[self.words.text_of[self.full_at]]
        self.least = np.full(len(self.full_keys), _NO_ID)
        np.minimum.at(self.least, self.full_place, self.full_ids)

    def removed(self, smaller: np.ndarray) -> np.ndarray:
        """Words covered by a window that starts in a text with a smaller id."""
        repeated = (smaller[self.full_place] > 0) | (self.least[self.full_place] < self.full_ids)
        edges = np.zeros(len(self.words.hashes) + 1, np.int64)
        np.add.at(edges, self.full_at[repeated], 1)
        np.add.at(edges, self.full_at[repeated] + self.window, -1)
        return np.cumsum(edges)[:-1] > 0


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13, block: int | None = None, carry: list[str] | None = None) -> DataFrame:
    """Remove each word covered by a window of ``window`` words whose word sequence also
    starts in a text with a smaller id; windows are judged on the input.

    Returns ``id_col``, ``n_words``, ``n_removed``, ``kept_text`` (kept words joined by
    one space), ``removed_spans`` (maximal removed runs as words ``[first, end)``) and
    ``row``, a struct of the columns of ``carry``, unchanged.

    Null and empty texts have no words; a null id counts as larger than every id; rows
    with equal ids do not remove each other's words; an empty table gives no rows.
    Other columns of ``docs`` are ignored unless carried, whatever their names.
    """
    block = block or (window + 1) // 2
    if window < 2 * block - 1:
        raise ValueError("window must be at least 2 * block - 1")
    ship(docs.sparkSession)
    layout = X.layout_of(docs, text_col)
    row = F.struct(*[F.col(f"`{c}`") for c in carry or []]).alias("row") if carry else F.lit(True).alias("row")
    rows = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).cast("string").alias("__text"), row)
    rows = X.dealt(rows, layout, ["__id", "__text"])
    bits, buckets = layout.short_bits, layout.buckets

    def send_anchors(docs: pa.Table) -> pa.Table:
        chunk = _Chunk(docs, window, block, bits)
        return X.blocks_table(docs["chunk"][0].as_py(), chunk.keys, chunk.anchors(), bits, buckets)

    def probe(blocks: pa.Table) -> pa.Table:
        found = X.gather(blocks, ["u1"])
        flags = found.values[0][found.order]
        chunks = np.diff(np.append(found.firsts, len(flags)))
        any_flag = np.bitwise_or.reduceat(flags, found.firsts) if len(flags) else flags
        hit = ((any_flag & 1) > 0) & ((chunks > 1) | ((any_flag & 2) > 0))
        return X.answers_table(found, blocks["bucket"][0].as_py(), (X.pack([a]) for a in found.back(hit.astype(np.uint8))))

    def send_windows(docs: pa.Table, answers: pa.Table) -> pa.Table:
        chunk = _Chunk(docs, window, block, bits)
        chunk.candidates(X.answered(answers, ["u1"])[0])
        return X.blocks_table(docs["chunk"][0].as_py(), chunk.full_keys, [chunk.least], 64, buckets)

    def compare(blocks: pa.Table) -> pa.Table:
        found = X.gather(blocks, ["i8"])
        least = found.values[0][found.order]
        lowest = np.minimum.reduceat(least, found.firsts) if len(least) else least
        smaller = np.empty(len(least), np.uint8)
        smaller[found.order] = lowest[found.group] < least
        parts = np.split(smaller, np.cumsum(found.sizes)[:-1])
        return X.answers_table(found, blocks["bucket"][0].as_py(), (X.pack([a]) for a in parts))

    def finish(docs: pa.Table, answers: pa.Table) -> pa.Table:
        chunk = _Chunk(docs, window, block, bits)
        first = pa.compute.equal(answers["step"], 1)
        chunk.candidates(X.answered(answers.filter(first), ["u1"])[0])
        gone = chunk.removed(X.answered(answers.filter(pa.compute.invert(first)), ["u1"])[0])
        bounds = chunk.words.bounds
        kept, spans = [], []
        raw = chunk.buffer.tobytes()
        for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
            own = gone[a:b]
            text = raw[chunk.offsets[i] : chunk.offsets[i + 1]].split()
            kept.append(b" ".join(compress(text, (~own).tolist()) if own.any() else text))
            edges = np.flatnonzero(np.diff(own.astype(np.int8), prepend=0, append=0))
            spans.append([{"first": int(x), "end": int(y)} for x, y in edges.reshape(-1, 2)])
        total = np.concatenate([[0], np.cumsum(gone)])
        out = {
            "__id": docs["__id"],
            "row": docs["row"],
            "n_words": pa.array(np.diff(bounds)),
            "n_removed": pa.array(total[bounds[1:]] - total[bounds[:-1]]),
            "kept_text": pa.array(kept, pa.binary()).cast(pa.string()),
            "removed_spans": pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))),
        }
        return pa.table(out)

    by_chunk = rows.groupBy("chunk")
    hits = by_chunk.applyInArrow(send_anchors, X.BLOCKS).groupBy("bucket").applyInArrow(probe, X.ANSWERS)
    repeats = by_chunk.cogroup(hits.groupBy("chunk")).applyInArrow(send_windows, X.BLOCKS).groupBy("bucket").applyInArrow(compare, X.ANSWERS)
    answers = hits.withColumn("step", F.lit(1)).unionByName(repeats.withColumn("step", F.lit(2)))
    carried = dict(rows.dtypes)["row"]
    done = by_chunk.cogroup(answers.groupBy("chunk")).applyInArrow(
        finish, f"`__id` long, row {carried}, n_words long, n_removed long, kept_text string, removed_spans array<struct<first:int,end:int>>"
    )
    return done.select(F.col("__id").alias(id_col), "n_words", "n_removed", "kept_text", "removed_spans", *(["row"] if carry else []))
