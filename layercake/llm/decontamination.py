"""Benchmark decontamination by spaced-seed hashing.

A mask marks some of a few consecutive words; the hash of the marked ones ignores the
others, so that a passage with substituted words still shares hashes with its source.
The masks of an item are such that every overlap that meets the operator's rule holds the
marked words of at least one of them. Benchmark hashes meet the hashes of every position
of every text; a hit with enough equal words around it has its whole diagonal searched for
the stretch with the most equal words that meets the rule.

The benchmark goes to the tasks in blocks of bounded size, one pass over the texts per
block; the texts are never shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layercake.llm.arrow_rows import give_back, text_input, text_slices
from layercake.llm.shipping import ship
from layercake.llm.words import find_words, mix, place_factor, text_buffer

# The masks by words of an item, the last for all longer ones too; 1 marks a
# word that the hash holds. They find every overlap of 13 equal words (80 % of a shorter
# item's) of which 80 % are equal (enumerated in the tests).
MASKS = {
    5: ("1111", "11101", "11011", "10111"),
    6: ("1111", "11011"),
    7: ("11111", "111011", "110111"),
    8: ("11111", "111011"),
    9: ("1111011", "1101111"),
    10: ("11111", "111011", "11010011"),
    11: ("1101011", "1110011"),
    12: ("1111011", "11010001011", "1100011011", "1111101"),
}
#: Equal words and identity that MASKS are made for.
MIN_EQUAL, IDENTITY = 13, 0.8
#: Items with fewer words are not sought.
SHORTEST = 5
#: Words of benchmark text in one block.
BLOCK_WORDS = 1_000_000
_BATCH = 2 << 20
_FILTER_BITS = 22
#: Hits that are looked at together; bounds the memory of a task.
_HITS = 1 << 18
_ROUNDING = 1e-9

OVERLAPS = "array<struct<item:long,text_first:int,text_end:int,item_first:int,n_equal:int>>"
_OVERLAP = pa.struct([("item", pa.int64()), ("text_first", pa.int32()), ("text_end", pa.int32()), ("item_first", pa.int32()), ("n_equal", pa.int32())])


def needed(size: int, min_equal: int, identity: float) -> int:
    """Equal words that an overlap with an item of ``size`` words needs."""
    return max(1, min(min_equal, math.ceil(identity * size - _ROUNDING)))


def masks_of(size: int, min_equal: int, identity: float) -> tuple[str, ...]:
    """Masks of which every overlap with an item of ``size`` words that meets the rule
    holds at least one. For a laxer rule than that of MASKS: as many words in a row as
    the replaced words must leave somewhere."""
    need = needed(size, min_equal, identity)
    if identity >= IDENTITY and need >= needed(size, MIN_EQUAL, IDENTITY):
        return MASKS[min(size, max(MASKS))]
    # an overlap with twice the equal words holds a smaller one
    equal = range(need, min(2 * need - 1, size) + 1)
    return ("1" * min(math.ceil(n / (1 + min(size - n, int(n / identity - n + _ROUNDING)))) for n in equal),)


def masked_hashes(hashes: np.ndarray, text_of: np.ndarray, mask: str, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the marked words from each start of ``mask`` within a text, and the starts."""
    n = len(hashes) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.full(n, salt, np.uint64)
    for j, mark in enumerate(mask):
        if mark == "1":
            total += hashes[j : j + n] * place_factor(j)
    at = np.flatnonzero(text_of[:n] == text_of[len(mask) - 1 :])
    return mix(total[at]), at


@dataclass
class BenchmarkIndex:
    """Words of the items of one block (joined, item i from ``bounds[i]`` on), the equal
    words that each needs, and their seeds sorted by hash."""

    items: list[list[int]]
    words: np.ndarray
    bounds: np.ndarray
    need: np.ndarray
    masks: list[str]
    hashes: list[np.ndarray]
    item: list[np.ndarray]
    place: list[np.ndarray]

    @classmethod
    def build(cls, ids: list[int], texts: list[str], min_equal: int = MIN_EQUAL, identity: float = IDENTITY) -> BenchmarkIndex:
        found = find_words(*text_buffer(pa.array(texts, pa.large_string())), fold_case=True)
        by_words: dict[bytes, int] = {}
        items, words = [], []
        for i, a, b in zip(ids, found.bounds[:-1], found.bounds[1:], strict=True):
            if b - a < SHORTEST:
                continue
            own = found.hashes[a:b]
            if own.tobytes() in by_words:
                items[by_words[own.tobytes()]].append(i)  # equal items are one
            else:
                by_words[own.tobytes()] = len(items)
                items.append([i])
                words.append(own)
        sizes = np.array([len(w) for w in words], np.int64)
        joined = np.concatenate([np.zeros(0, np.uint64), *words])
        of = np.repeat(np.arange(len(words)), sizes)
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        masks_by_size = {int(n): masks_of(int(n), min_equal, identity) for n in np.unique(sizes)}
        need = np.array([needed(int(n), min_equal, identity) for n in sizes], np.int64)
        masks = sorted({m for ms in masks_by_size.values() for m in ms})
        hashes, item, place = [], [], []
        for salt, mask in enumerate(masks):
            keys, at = masked_hashes(joined, of, mask, salt)
            use = np.isin(sizes[of[at]], [n for n, ms in masks_by_size.items() if mask in ms])
            keys, at = keys[use], at[use]
            order = np.argsort(keys, kind="stable")
            hashes.append(keys[order])
            item.append(of[at][order])
            place.append((at - bounds[of[at]])[order])
        return cls(items, joined, bounds, need, masks, hashes, item, place)


def _best(equal: np.ndarray, identity: float) -> tuple[int, int, int]:
    """The stretch [a, b) with the most equal words among those of which ``identity`` are
    equal, and that number; of several the first. It begins and ends with an equal word."""
    places = np.flatnonzero(equal)
    if not len(places):
        return 0, 0, 0
    # words i to j of these will do if opens[i] <= closes[j]
    opens = np.arange(len(places)) - identity * places
    closes = opens + 1 - identity + _ROUNDING
    first = np.searchsorted(-np.minimum.accumulate(opens), -closes)
    n_equal = np.arange(len(places)) - first + 1
    j = int(n_equal.argmax())
    return int(places[first[j]]), int(places[j]) + 1, int(n_equal[j])


def _near(words: np.ndarray, low: np.ndarray, high: np.ndarray, at: np.ndarray, index: BenchmarkIndex, item: np.ndarray, place: np.ndarray, span: int, identity: float) -> np.ndarray:
    """Hits with the equal words that an overlap around them needs. An overlap that meets
    the rule holds one with fewer than twice the equal words that it needs, and that has
    a hit; so farther words need not be seen."""
    if not len(item):
        return np.zeros(0, bool)
    need = index.need[item]
    reach = ((2 * need - 1) / identity + _ROUNDING).astype(np.int64)
    back = np.minimum(np.minimum(reach - span, at - low), place)
    ahead = np.minimum(np.minimum(reach, high - at), index.bounds[item + 1] - index.bounds[item] - place)
    source = index.bounds[item] + place
    n_equal = np.zeros(len(item), np.int64)
    for j in range(-int(back.max()), int(ahead.max())):
        inside = (j >= -back) & (j < ahead)
        n_equal += inside & (words[np.where(inside, at + j, 0)] == index.words[np.where(inside, source + j, 0)])
    return n_equal >= need


def overlaps_of(texts: list[str], index: BenchmarkIndex, identity: float) -> list[list[dict]]:
    """Overlaps of each text with the items: the best one per text and item."""
    found = find_words(*text_buffer(pa.array(texts, pa.large_string())), fold_case=True)
    text_of = found.text_of
    hits = []
    for salt, mask in enumerate(index.masks):
        own = index.hashes[salt]
        if not len(own):
            continue
        near = np.zeros(1 << _FILTER_BITS, bool)
        near[own >> np.uint64(64 - _FILTER_BITS)] = True
        keys, at = masked_hashes(found.hashes, text_of, mask, salt)
        use = near[keys >> np.uint64(64 - _FILTER_BITS)]
        keys, at = keys[use], at[use]
        low, high = np.searchsorted(own, keys, "left"), np.searchsorted(own, keys, "right")
        ends = np.cumsum(high - low)
        total = int(ends[-1]) if len(ends) else 0
        for begin in range(0, total, _HITS):
            number = np.arange(begin, min(begin + _HITS, total))
            k = np.searchsorted(ends, number, "right")
            which = high[k] - (ends[k] - number)
            item, place, here = index.item[salt][which], index.place[salt][which], at[k]
            text = text_of[here]
            use = _near(found.hashes, found.bounds[text], found.bounds[text + 1], here, index, item, place, len(mask), identity)
            text, item = text[use], item[use]
            # one row per diagonal
            hits.append(np.unique(np.stack([text, item, here[use] - found.bounds[text] - place[use]], 1), axis=0))
    best: dict[tuple[int, int], tuple] = {}
    joined = np.unique(np.concatenate(hits), axis=0) if hits else np.zeros((0, 3), np.int64)
    for text, item, shift in joined.tolist():
        a, b = int(found.bounds[text]), int(found.bounds[text + 1])
        words = index.words[index.bounds[item] : index.bounds[item + 1]]
        first = max(0, -shift)
        end = min(len(words), b - a - shift)
        equal = found.hashes[a + shift + first : a + shift + end] == words[first:end]
        x, y, n_equal = _best(equal, identity)
        if n_equal >= index.need[item]:
            row = (n_equal, -(shift + first + x), y - x, first + x)
            best[text, item] = max(best.get((text, item), row), row)
    out: list[list[dict]] = [[] for _ in texts]
    for (text, item), (n_equal, begin, size, item_first) in sorted(best.items()):
        for one in index.items[item]:
            out[text].append({"item": one, "text_first": -begin, "text_end": -begin + size, "item_first": item_first, "n_equal": n_equal})
    return out


def find_overlaps(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", min_equal: int = MIN_EQUAL, identity: float = IDENTITY, keep: list[str] | None = None) -> DataFrame:
    """The columns of ``docs`` (or those in ``keep``) and ``overlaps``: per benchmark item the best stretch of
    the text, aligned word by word, of which at least ``identity`` of the words and at
    least ``min_equal`` words (or ``identity`` of the item's, if that is less) are equal, as
    item, words ``[text_first, text_end)``, first word of the item, and equal words. The
    best has the most equal words and begins and ends with one; every item with such a
    stretch is found.

    A-Z are lower-cased. Null and empty texts have no overlaps; items with a null id or
    text or fewer than SHORTEST words are not sought; equal items are all reported. An
    empty benchmark gives empty arrays, an empty table no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    items = benchmark.select(F.col(item_col).cast("long").alias("id"), F.col(item_text_col).cast("string").alias("text")).where("id IS NOT NULL AND text IS NOT NULL").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / (4 * BLOCK_WORDS)))
    out, carried, at, schema = text_input(docs, text_col, ["overlaps"], keep)
    inner = out.columns
    schema = ", ".join([schema, *(["__text string"] if at == len(carried) else []), f"overlaps {OVERLAPS}"])
    out = out.withColumn("overlaps", F.lit(None).cast(OVERLAPS))
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block).orderBy("id").collect()  # at most about BLOCK_WORDS words
        shared = spark.sparkContext.broadcast(BenchmarkIndex.build([r["id"] for r in rows], [r["text"] for r in rows], min_equal, identity))

        def run(batches: Iterable[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                for part, texts in text_slices(batch, at, _BATCH):
                    before = part.column(len(inner)).to_pylist()
                    found = overlaps_of(texts, index, identity)
                    joined = pa.array([(x or []) + y for x, y in zip(before, found, strict=True)], pa.list_(_OVERLAP))
                    yield pa.RecordBatch.from_arrays([*part.columns[: len(inner)], joined], names=[*inner, "overlaps"])
            give_back()

        out = out.mapInArrow(run, schema)
    return out.select(*[F.col(f"`{c}`") for c in carried], "overlaps")
