"""Toxicity classifier with counterfactual regularisation.

A logistic regression over the distinct words of a text and their beginnings. For every
labelled text with identity terms a second one is made in which each term is swapped for
another of its group; the fit penalises the squared change of the score between the two,
so that a neutral mention of a group does not count as toxic, whatever the labels of the
few texts that mention it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layercake.llm.arrow_rows import give_back, text_input, text_slices
from layercake.llm.shipping import ship
from layercake.llm.words import NOT_LETTERS, find_words, text_buffer

# Groups of identity terms; a swap stays within a group.
IDENTITY_TERMS = (
    ("woman", "man"),
    ("women", "men"),
    ("female", "male"),
    ("girl", "boy"),
    ("gay", "straight", "lesbian", "bisexual"),
    ("transgender", "cisgender"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino"),
    ("african", "european", "american", "arab", "mexican", "chinese"),
    ("immigrant", "native", "refugee"),
    ("immigrants", "natives", "refugees"),
    ("old", "young"),
    ("disabled", "deaf", "blind"),
)
SWAP = {term.encode(): group[(i + 1) % len(group)].encode() for group in IDENTITY_TERMS for i, term in enumerate(group)}

#: Lengths in bytes of the beginnings of words that are features.
BEGINNINGS = (4, 5, 6)
#: Least log-likelihood ratio of a feature and the label: of a million features without
#: any relation to the label, about twenty reach it.
MIN_RATIO = 18.0
_BATCH = 2 << 20


def features(word: bytes) -> list[bytes]:
    """The whole word (marked by a blank) and its beginnings."""
    return [word + b" ", *[word[:n] for n in BEGINNINGS if len(word) >= n]]


@dataclass
class ToxicityModel:
    """``weights`` of ``features``; log odds of a text = bias + their sum."""

    features: list[bytes]
    weights: np.ndarray
    bias: float


def _distinct_words(texts: list[str]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words of a batch (lower case runs of letters), and the distinct
    (text, word) pairs."""
    buffer, offsets = text_buffer(pa.array([t.lower() for t in texts], pa.large_string()))
    words = find_words(buffer, offsets, separators=NOT_LETTERS)
    _, first, place = np.unique(words.hashes, return_index=True, return_inverse=True)
    raw = buffer.tobytes()
    own = [raw[a:b] for a, b in zip(words.starts[first].tolist(), words.ends[first].tolist(), strict=True)]
    pairs = np.unique(words.text_of * max(1, len(own)) + place)
    return own, pairs // max(1, len(own)), pairs % max(1, len(own))


def _active(own: list[bytes], known: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Known features of each distinct word: starts and feature numbers."""
    found = [[known[f] for f in features(w) if f in known] for w in own]
    starts = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int64)
    return starts, np.array([f for x in found for f in x], np.int64)


def _text_features(own: list[bytes], text: np.ndarray, word: np.ndarray, known: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, feature) pairs of a batch."""
    starts, numbers = _active(own, known)
    n = np.diff(starts)
    use = n[word] > 0
    text, word = text[use], word[use]
    begin = np.concatenate([[0], np.cumsum(n[word])[:-1]]).astype(np.int64)
    where = np.repeat(starts[word] - begin, n[word]) + np.arange(n[word].sum())
    pairs = np.unique(np.repeat(text, n[word]) * max(1, len(known)) + numbers[where])
    return pairs // max(1, len(known)), pairs % max(1, len(known))


def _likelihood_ratio(n0: Column, n1: Column, all0: int, all1: int) -> Column:
    """Log-likelihood ratio of a feature and the label, from texts with it by label."""

    def x_log_x(x: Column) -> Column:
        return F.when(x > 0, x * F.log(x.cast("double"))).otherwise(F.lit(0.0))

    both, total = n0 + n1, F.lit(all0 + all1)
    cells = x_log_x(n0) + x_log_x(n1) + x_log_x(F.lit(all0) - n0) + x_log_x(F.lit(all1) - n1)
    return 2 * (cells + x_log_x(total) - x_log_x(F.lit(all0)) - x_log_x(F.lit(all1)) - x_log_x(both) - x_log_x(total - both))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", fit_texts: int = 4000, n_features: int = 3000, swap_penalty: float = 1.0) -> ToxicityModel | None:
    """Fit on the texts of ``docs`` that ``labels`` (id, 0 or 1) marks; rows with null
    ids, labels or texts are left out, and a repeated label counts as often as it stands.

    Of each label about ``fit_texts`` rows are used (all, if it has fewer), chosen by the
    id's hash and weighted by the label's share. Returns None if nothing is labelled.
    """
    spark = docs.sparkSession
    ship(spark)
    known = labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("label")).where("__id IS NOT NULL AND label IN (0, 1)")
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return None
    share = F.when(F.col("label") == 1, F.lit(min(1.0, fit_texts / sizes.get(1, 1)))).otherwise(F.lit(min(1.0, fit_texts / sizes.get(0, 1))))
    chosen = known.where(F.pmod(F.xxhash64("__id"), F.lit(1 << 20)) < share * (1 << 20))
    # about 2 * fit_texts rows whatever the input
    sample = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL").join(F.broadcast(chosen), "__id").select("text", "label").persist()

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for part, texts in text_slices(batch, 0, _BATCH):
                own, text, word = _distinct_words(texts)
                named = [features(w) for w in own]
                marks = part.column(1).to_pylist()
                for t in range(len(texts)):
                    a, b = np.searchsorted(text, [t, t + 1])
                    counts[marks[t]].update({f for w in word[a:b] for f in named[w]})
        keys = sorted(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array([counts[0][k] for k in keys], pa.int64()), pa.array([counts[1][k] for k in keys], pa.int64())], ["feature", "n0", "n1"])
        give_back()

    counted = sample.mapInArrow(count, "feature binary, n0 long, n1 long").groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    drawn = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    ratio = _likelihood_ratio(F.col("n0"), F.col("n1"), drawn.get(0, 0), drawn.get(1, 0))
    best = counted.withColumn("ratio", ratio).where(F.col("ratio") >= MIN_RATIO).orderBy(F.desc("ratio"), "feature").limit(n_features).collect()
    terms = {f for t in SWAP for f in features(t)}
    selected = sorted({bytes(r["feature"]) for r in best} | terms)
    place = {f: i for i, f in enumerate(selected)}

    def vectors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_slices(batch, 0, _BATCH):
                own, text, word = _distinct_words(texts)
                rows, numbers = _text_features(own, text, word, place)
                cuts = np.searchsorted(rows, np.arange(1, len(texts)))
                plain = np.split(numbers, cuts)
                swapped: list[np.ndarray | None] = [None] * len(texts)
                named = np.array([w in SWAP for w in own], bool)
                for t in np.unique(text[named[word]]) if len(own) else []:
                    a, b = np.searchsorted(text, [t, t + 1])
                    changed = {SWAP.get(own[w], own[w]) for w in word[a:b]}
                    swapped[t] = np.array(sorted({place[f] for w in changed for f in features(w) if f in place}), np.int64)
                yield pa.RecordBatch.from_arrays([part.column(1), pa.array([x.tolist() for x in plain], pa.list_(pa.int64())), pa.array([None if x is None else x.tolist() for x in swapped], pa.list_(pa.int64()))], ["label", "on", "swapped"])

    rows = sample.mapInArrow(vectors, "label int, on array<long>, swapped array<long>").collect()
    sample.unpersist()
    label = np.array([r["label"] for r in rows], float)
    if not len(label):
        return None
    weight = np.where(label == 1, sizes.get(1, 0) / max(1, label.sum()), sizes.get(0, 0) / max(1, (1 - label).sum()))
    weights, bias = _regress([r["on"] for r in rows], [r["swapped"] for r in rows], label, weight / weight.sum(), len(selected), swap_penalty)
    used = np.flatnonzero(np.abs(weights) > 1e-6)
    return ToxicityModel([selected[i] for i in used], weights[used], bias)


def _regress(on: list, swapped: list, label: np.ndarray, weight: np.ndarray, n: int, swap_penalty: float, l2: float = 1e-5, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weighted logistic loss + swap_penalty * mean squared change of the score under the
    swap + l2 * |w|^2, minimised by Adam from zero."""
    row = np.repeat(np.arange(len(on)), [len(x) for x in on])
    col = np.array([f for x in on for f in x], np.int64)
    pairs = [i for i, x in enumerate(swapped) if x is not None]
    d_row = np.array([k for k, i in enumerate(pairs) for _ in range(len(on[i]) + len(swapped[i]))], np.int64)
    d_col = np.array([f for i in pairs for f in [*on[i], *swapped[i]]], np.int64)
    d_sign = np.array([s for i in pairs for s in [1.0] * len(on[i]) + [-1.0] * len(swapped[i])])
    base = np.clip((weight * label).sum(), 1e-4, 1 - 1e-4)
    params = np.zeros(n + 1)
    params[n] = np.log(base / (1 - base))
    first, second = np.zeros(n + 1), np.zeros(n + 1)
    for step in range(1, steps + 1):
        w, bias = params[:n], params[n]
        z = bias + np.bincount(row, w[col], len(on))
        error = weight * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - label)
        grad = np.append(np.bincount(col, error[row], n) + 2 * l2 * w, error.sum())
        if pairs:
            change = np.bincount(d_row, d_sign * w[d_col], len(pairs))
            grad[:n] += 2 * swap_penalty / len(pairs) * np.bincount(d_col, d_sign * change[d_row], n)
        first = 0.9 * first + 0.1 * grad
        second = 0.99 * second + 0.01 * grad**2
        params = params - 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-10)
    return params[:n], float(params[n])


def score(docs: DataFrame, model: ToxicityModel | None, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns of ``docs`` (or those in ``keep``), ``score`` (0 to 1, higher: more likely toxic) and
    ``predicted`` (1 if score >= 0.5). Every whole text is scored; null, empty and
    wordless texts get the share that the fit saw without any evidence. Without a model
    every score is 0."""
    spark = docs.sparkSession
    ship(spark)
    rows, carried, at, schema = text_input(docs, text_col, ["score", "predicted"], keep)
    if model is None:
        return rows.select(*[F.col(f"`{c}`") for c in carried], F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    shared = spark.sparkContext.broadcast(model)  # at most n_features weights

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        place = {f: i for i, f in enumerate(model.features)}
        for batch in batches:
            for part, texts in text_slices(batch, at, _BATCH):
                row, number = _text_features(*_distinct_words(texts), place)
                z = model.bias + np.bincount(row, model.weights[number], len(texts))
                scores = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
                kept = part.columns[: len(carried)]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))], names=[*carried, "score", "predicted"])
        give_back()

    return rows.mapInArrow(run, f"{schema}, score double, predicted int")
