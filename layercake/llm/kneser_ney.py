"""Language-model scoring with an interpolated modified Kneser-Ney n-gram model.

The model is counted and stored by hash bucket: a bucket's task merges the n-grams of all
chunks to sorted hash arrays with their counts, in a memory-mapped file, and answers the
n-grams of every chunk from it. So a worker maps the shard it needs and never the whole
model, which grows with the corpus: no n-gram is pruned.

One exchange per order, from the longest n-grams down. Its answers give a chunk the
counts of its n-grams, and make one chunk the owner of each: owners count the distinct
left extensions (continuation counts) and the follower statistics of contexts for the
next order. Sums over the corpus travel with the blocks: every chunk sends to every
bucket, every bucket answers every chunk.

The answers of an order are written, and the shuffles that led to them are freed: keys are
hashes, which do not compress, so that the blocks of two orders and the texts together take
more disk than all the rest. The texts are dealt anew for every order.
"""

from __future__ import annotations

import os
import re
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layercake.llm import exchange as X
from layercake.llm.shipping import ship
from layercake.llm.words import find_words, mix, place_factor, text_buffer
from layercake.session import scratch_dir, shuffles_freed, write_scratch

#: Least discount of a count.
LEAST_DISCOUNT = 0.05
_BEGIN, _END = np.uint64(0x62656769), np.uint64(0x656E64)
_BLOCKS = X.BLOCKS + ", stats array<long>"
_ANSWERS = X.ANSWERS + ", stats array<long>"


def _sent(m: int, order: int) -> list[str]:
    """Types of an n-gram's values in a block: its count (in the texts for the longest,
    else of its left extensions), and, below the longest, as a context: how many followers
    have count 1, 2, 3 or more, and the followers' total beyond 1, 2 and 3 for each of
    these; of single tokens the text count too, last."""
    return ["u4"] + (["u4", "u4", "u4", "i8"] if m < order else []) + (["u4"] if m == 1 < order else [])


def _back(m: int, order: int) -> list[str]:
    """Types of an answer's values: the same totals, and whether this chunk owns the n-gram."""
    return ["i8"] * len(_sent(m, order)) + ["u1"]


class _Chunk:
    """Token sequences of one chunk: per text a begin mark, its words and an end."""

    def __init__(self, docs: pa.Table, order: int):
        self.order = order
        words = find_words(*text_buffer(docs["__text"]), fold_case=True)
        self.n_tokens = words.counts + 1
        sizes = self.n_tokens + 1
        self.bounds = np.concatenate([[0], np.cumsum(sizes)])
        self.tokens = np.empty(self.bounds[-1], np.uint64)
        self.starts = np.repeat(self.bounds[:-1], sizes)
        inner = np.ones(len(self.tokens), bool)
        inner[self.bounds[:-1]] = inner[self.bounds[1:] - 1] = False
        self.tokens[inner] = words.hashes
        self.tokens[self.bounds[:-1]] = _BEGIN
        self.tokens[self.bounds[1:] - 1] = _END
        self.real = np.ones(len(self.tokens), bool)
        self.real[self.bounds[:-1]] = False
        self.trained = self.real & np.repeat(docs["__train"].to_numpy(zero_copy_only=False).astype(bool), sizes)
        self._grams: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def grams(self, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted keys of the n-grams of m tokens that end at each place; a trained place of
        each (else any of its places); the key of each place."""
        if m not in self._grams:
            at = np.arange(len(self.tokens))
            total = self.tokens * place_factor(0) + np.uint64(m)
            for j in range(1, m):
                total += self.tokens[np.maximum(at - j, self.starts)] * place_factor(j)
            hashes = mix(total)
            by_key = np.argsort(hashes)
            ordered = hashes[by_key]
            new = np.ones(len(ordered), bool)
            new[1:] = ordered[1:] != ordered[:-1]
            place = np.empty(len(at), np.int64)
            place[by_key] = np.cumsum(new) - 1
            keys, example = ordered[new], by_key[new]
            trained = np.flatnonzero(self.trained)
            example[place[trained]] = trained
            self._grams[m] = keys, example, place
        return self._grams[m]

    def values(self, m: int, above: list[np.ndarray] | None) -> list[np.ndarray]:
        """What this chunk adds to each n-gram of m tokens (see ``_sent``); ``above``: the
        answers for m + 1 tokens."""
        keys, _, place = self.grams(m)
        n = len(keys)
        text_count = np.bincount(place[self.trained], minlength=n).astype("u4") if above is None or m == 1 else None
        if above is None:
            return [text_count]
        owned = above[-1] > 0
        last = self.grams(m + 1)[1][owned]  # a place of each n-gram that this chunk owns
        count = above[0][owned]
        ends, context = place[last], place[last - 1]
        followers = [np.bincount(context[which], minlength=n).astype("u4") for which in (count == 1, count == 2, count > 2)]
        more = count > 3
        beyond = np.bincount(context[more], count[more] - 3, n).astype("i8")
        return [np.bincount(ends, minlength=n).astype("u4"), *followers, beyond, *([text_count] if m == 1 else [])]

    def block(self, chunk: int, m: int, above: list[np.ndarray] | None, buckets: int) -> pa.Table:
        blocks = X.blocks_table(chunk, self.grams(m)[0], self.values(m, above), 64, buckets, to_all=True)
        stats = [[int(self.trained.sum())]] * buckets
        return blocks.append_column("stats", pa.array(stats, pa.list_(pa.int64())))


def _mapped(array: np.ndarray, folder: str | None) -> np.ndarray:
    """The array in a memory-mapped file of ``folder``, which goes with the last reference;
    without a folder the array itself."""
    if not len(array) or folder is None:
        return array
    with tempfile.TemporaryFile(dir=folder) as file:
        file.write(memoryview(np.ascontiguousarray(array)).cast("B"))
        file.flush()
        return np.memmap(file, array.dtype, "r", shape=array.shape)


class _Shard:
    """The model's n-grams of one bucket: sorted hashes and their values, mapped."""

    def __init__(self, found: X.Gathered, folder: str | None):
        sums = []
        for v in found.values:
            ordered = v[found.order].astype(np.int64)
            sums.append(np.add.reduceat(ordered, found.firsts) if len(ordered) else ordered)
        self.keys = _mapped(found.keys[found.order][found.firsts], folder)
        self.values = [_mapped(s, folder) for s in sums]
        # the first chunk that adds to an n-gram owns it
        adds = found.values[0][found.order] > 0
        number = np.where(adds, np.arange(len(adds)), len(adds))
        self.owner = np.minimum.reduceat(number, found.firsts) if len(adds) else number

    def stats(self, tokens: int) -> list[int]:
        """Training tokens; n-grams that training texts have (for single tokens, whose last
        value is the text count); n-grams of count 1, 2, 3, 4 and over 2; all counts."""
        count = self.values[0]
        n = np.bincount(np.minimum(count, 5), minlength=6)
        return [tokens, int((self.values[-1] > 0).sum()), *[int(x) for x in n[1:5]], int(n[3:].sum()), int(count.sum())]

    def look_up(self, keys: np.ndarray) -> list[np.ndarray]:
        at = np.searchsorted(self.keys, keys)
        return [np.asarray(v[at]) for v in self.values]


def _answer(blocks: pa.Table, sent: list[str], folder: str | None) -> pa.Table:
    blocks = blocks.sort_by("chunk")
    found = X.gather(blocks, sent)
    shard = _Shard(found, folder)
    owner = np.zeros(len(found.keys), np.uint8)
    owner[found.order[shard.owner[shard.owner < len(found.keys)]]] = 1
    stats = shard.stats(sum(s[0] for s in blocks["stats"].to_pylist()))
    cuts = np.concatenate([[0], np.cumsum(found.sizes)]).astype(np.int64)
    answers = [X.pack([*shard.look_up(found.keys[a:b]), owner[a:b]]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    table = X.answers_table(found, blocks["bucket"][0].as_py(), answers)
    return table.append_column("stats", pa.array([stats] * len(answers), pa.list_(pa.int64())))


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Discounts of counts 1, 2 and 3 or more; half of the count where a number of
    n-grams is missing for the estimate. At least ``LEAST_DISCOUNT``: without any discount
    a context would leave nothing to tokens that it has not seen."""
    if not (n1 and n2 and n3):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(float(min(max(d, LEAST_DISCOUNT), i + 1)) for i, d in enumerate(raw))


def _scores(chunk: _Chunk, answers: dict[int, tuple[list[np.ndarray], np.ndarray]]) -> dict[str, np.ndarray | int]:
    """Log10 probabilities of the texts, and of the unigram base."""
    values, stats = answers[1]
    tokens, distinct = int(stats[0, 0]), int(stats[:, 1].sum())
    keys, _, place = chunk.grams(1)
    text_count = values[-1][place]
    base = np.log10((text_count + 0.5) / (tokens + 0.5 * (distinct + 1)))
    chance = np.full(len(place), 1.0 / (distinct + 1))
    for m in range(1, chunk.order + 1):
        values, stats = answers[m]
        totals = stats.sum(0)
        d1, d2, d3 = discounts(*[int(x) for x in totals[2:6]])
        # by key, then for each place
        count = values[0]
        left = (count - np.array([0.0, d1, d2, d3])[np.minimum(count, 3)])[chunk.grams(m)[2]]
        if m == 1:
            ones, twos, more = totals[2], totals[3], totals[6]
            total = np.asarray(totals[7], float)
        else:
            ones, twos, more, beyond = answers[m - 1][0][1:5]
            total = (ones + 2 * twos + 3 * more + beyond).astype(float)
        with np.errstate(divide="ignore", invalid="ignore"):
            rest = (d1 * ones + d2 * twos + d3 * more) / total
            if m > 1:
                context = chunk.grams(m - 1)[2][np.maximum(np.arange(len(place)) - 1, 0)]
                total, rest = total[context], rest[context]
            here = left / total + rest * chance
        chance = np.where(np.broadcast_to(total > 0, chance.shape), here, chance)

    def by_text(x: np.ndarray) -> np.ndarray:
        # one sum per text, each with a begin mark at least
        return np.add.reduceat(np.where(chunk.real, x, 0), chunk.bounds[:-1])

    return {"n_known": by_text(text_count > 0).astype(np.int64), "train_tokens": tokens, "base_score": by_text(base), "score": by_text(np.log10(chance))}


def _local_folder(spark) -> str | None:
    """A folder of the shared checkpoint folder that workers can open as files; None where it
    is on a file system that they cannot."""
    path = scratch_dir(spark, "kneser-ney")
    if not re.match(r"file:|/", path):
        return None
    folder = re.sub(r"^file:/*", "/", path)
    os.makedirs(folder, exist_ok=True)
    return folder


def score_texts(docs: DataFrame, train, id_col: str = "doc_id", text_col: str = "text", order: int = 3) -> DataFrame:
    """Fit a model of ``order`` on the rows for which the boolean column ``train`` holds
    and score every row: ``id_col``, ``trained``, ``n_tokens``, ``n_known`` (tokens that
    training has), ``train_tokens``, ``base_score`` (log10 probability by the smoothed
    unigram), ``score`` (by the model) and ``perplexity``.

    Tokens are words (A-Z lower-cased), then one end. A null text is empty: one token.
    A null ``train`` counts as false. Without training rows every token is unknown and
    scores by the uniform distribution. Repeated rows count and score each. An empty table
    gives no rows; other columns are ignored. ``docs`` is read once per order and once to
    score, and has to give the same rows each time.
    """
    ship(docs.sparkSession)
    layout = X.layout_of(docs, text_col)
    buckets = layout.buckets
    rows = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).cast("string").alias("__text"), F.coalesce(train, F.lit(False)).alias("__train"))
    by_chunk = X.dealt(rows, layout, ["__id", "__text"]).groupBy("chunk")

    def heard(answers: pa.Table) -> Iterator[tuple[int, tuple[list[np.ndarray], np.ndarray]]]:
        for m in sorted(set(answers["level"].to_pylist()), reverse=True):
            own = answers.filter(pa.compute.equal(answers["level"], m))
            unused = len(_back(m, order)) - 1  # whose n-gram it is
            yield m, (X.answered(own, _back(m, order), without={unused}), np.array(own["stats"].to_pylist(), np.int64))

    def send(m: int):
        def first(docs: pa.Table) -> pa.Table:
            return _Chunk(docs, order).block(docs["chunk"][0].as_py(), m, None, buckets)

        def next_order(docs: pa.Table, answers: pa.Table) -> pa.Table:
            kinds = _back(m + 1, order)
            above = X.answered(answers, kinds, without=range(1, len(kinds) - 1))  # counts and owners
            return _Chunk(docs, order).block(docs["chunk"][0].as_py(), m, above, buckets)

        return first if m == order else next_order

    def answer(m: int):
        return lambda blocks: _answer(blocks, _sent(m, order), folder)

    folder = _local_folder(docs.sparkSession)
    answers: dict[int, DataFrame] = {}
    for m in range(order, 0, -1):
        if m == order:
            blocks = by_chunk.applyInArrow(send(m), _BLOCKS)
        else:
            blocks = by_chunk.cogroup(answers[m + 1].groupBy("chunk")).applyInArrow(send(m), _BLOCKS)
        own = blocks.groupBy("bucket").applyInArrow(answer(m), _ANSWERS)
        with shuffles_freed(docs.sparkSession):
            answers[m] = write_scratch(own, f"kneser-ney-{m}").withColumn("level", F.lit(m))
    together = answers[order]
    for m in range(order - 1, 0, -1):
        together = together.unionByName(answers[m])

    def finish(docs: pa.Table, answers: pa.Table) -> pa.Table:
        chunk = _Chunk(docs, order)
        out = _scores(chunk, dict(heard(answers)))
        n = docs.num_rows
        return pa.table(
            {
                "__id": docs["__id"],
                "trained": docs["__train"],
                "n_tokens": pa.array(chunk.n_tokens.astype(np.int64)),
                "n_known": pa.array(out["n_known"]),
                "train_tokens": pa.array(np.full(n, out["train_tokens"], np.int64)),
                "base_score": pa.array(out["base_score"]),
                "score": pa.array(out["score"]),
                "perplexity": pa.array(10 ** (-out["score"] / chunk.n_tokens)),
            }
        )

    done = by_chunk.cogroup(together.groupBy("chunk")).applyInArrow(finish, "`__id` long, trained boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double")
    return done.withColumnRenamed("__id", id_col)
