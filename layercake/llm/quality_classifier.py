"""Quality classifier with supervised subword embeddings.

Every word, every character n-gram of a word (with its borders) and every pair of
neighbouring words has a learned vector, found by hash in a table of ``buckets`` rows. The
mean of all the vectors of a text goes through a linear layer and a softmax over the two
labels. Vectors and layer are trained together by stochastic gradient descent in numpy, on
a bounded sample of the labelled texts. A pair is hashed by the difference of its words'
hashes, so that all immediate repetitions share one vector, whatever the word.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layercake.llm.arrow_rows import give_back, text_input, text_slices
from layercake.llm.shipping import ship
from layercake.llm.words import Words, find_words, mix, text_buffer

#: Lengths in characters of the n-grams of a word between its borders.
NGRAMS = (3, 4, 5)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PAIR = np.uint64(0x2545F4914F6CDD1D)
#: Characters of the words whose n-grams are hashed at a time.
_PART = 1 << 20
_BATCH = 2 << 20


@dataclass
class QualityModel:
    """``vectors``: (buckets, dim); ``layer``: (2, dim); ``bias``: (2,)."""

    vectors: np.ndarray
    layer: np.ndarray
    bias: np.ndarray

    def collapsed(self) -> tuple[np.ndarray, float]:
        """Each bucket's share in the log odds of label 1, and the bias: the layer is
        linear, so that a mean of vectors needs only the mean of these."""
        return self.vectors @ (self.layer[1] - self.layer[0]), float(self.bias[1] - self.bias[0])


def _word_features(words: list[str], hashes: np.ndarray, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word numbers, buckets of each one's features) for words of one length at a time."""
    lengths = np.array([len(w) for w in words], np.int64)
    for n in np.unique(lengths):
        same = np.flatnonzero(lengths == n)
        for part in np.array_split(same, -(-len(same) * int(n) // _PART)):
            codes = np.array([f"<{words[i]}>" for i in part.tolist()], f"U{n + 2}").view(np.uint32).reshape(len(part), n + 2).astype(np.uint64)
            found = [hashes[part][:, None]]
            for size in NGRAMS:
                if size <= n + 2:
                    h = np.full((len(part), n + 3 - size), size, np.uint64)
                    for j in range(size):
                        h = h * _BASE + codes[:, j : n + 3 - size + j]
                    found.append(mix(h))
            yield part, (np.concatenate(found, axis=1) % np.uint64(buckets)).astype(np.int64)


def _split(texts: list[str]) -> tuple[Words, np.ndarray, np.ndarray, list[str], np.ndarray]:
    """Words of a batch, the distinct ones' hashes and text, and which each word is."""
    buffer, offsets = text_buffer(pa.array(texts, pa.large_string()))
    words = find_words(buffer, offsets)
    keys, first, place = np.unique(words.hashes, return_index=True, return_inverse=True)
    raw = buffer.tobytes()
    own = [raw[a:b].decode() for a, b in zip(words.starts[first].tolist(), words.ends[first].tolist(), strict=True)]
    return words, keys, place, own, first


def _pairs(words: Words, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Text and bucket of every pair of neighbouring words."""
    text_of = words.text_of
    inside = text_of[1:] == text_of[:-1]
    h = mix((words.hashes[1:] - words.hashes[:-1])[inside] + _PAIR)
    return text_of[1:][inside], (h % np.uint64(buckets)).astype(np.int64)


def text_features(texts: list[str], buckets: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct buckets of each text's features and the share of each."""
    words, keys, place, own, _ = _split(texts)
    by_word: list[np.ndarray] = [np.zeros(0, np.int64)] * len(own)
    for part, found in _word_features(own, keys, buckets):
        for i, row in zip(part.tolist(), found, strict=True):
            by_word[i] = row
    pair_text, pair = _pairs(words, buckets)
    cuts = np.searchsorted(pair_text, np.arange(len(texts) + 1))
    out = []
    for t in range(len(texts)):
        used, n = np.unique(place[words.bounds[t] : words.bounds[t + 1]], return_counts=True)
        rows = [by_word[i] for i in used.tolist()]
        times = [np.repeat(n, [len(r) for r in rows]), np.ones(cuts[t + 1] - cuts[t], np.int64)]
        every, inverse = np.unique(np.concatenate([*rows, pair[cuts[t] : cuts[t + 1]]]), return_inverse=True)
        share = np.bincount(inverse, np.concatenate(times), len(every))
        out.append((every, share / max(1.0, share.sum())))
    return out


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", fit_texts: int = 1500, buckets: int = 1 << 16, dim: int = 16, epochs: int = 12, rate: float = 20.0) -> QualityModel | None:
    """Fit on the texts of ``docs`` that ``labels`` (id, 0 or 1) marks; rows with null ids,
    labels or texts are left out. Of rows with equal ids one text is used, with each of the
    labels that the id has.

    Of each label about ``fit_texts`` ids are used (all, if it has fewer), chosen by the
    id's hash and weighted by the label's share. Only the distinct buckets of these texts
    reach the driver: at most ``buckets`` of each. Returns None if nothing is labelled.
    """
    spark = docs.sparkSession
    ship(spark)
    known = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label")).where("id IS NOT NULL AND label IN (0, 1)").distinct()
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return None
    share = F.when(F.col("label") == 1, F.lit(min(1.0, fit_texts / sizes.get(1, 1)))).otherwise(F.lit(min(1.0, fit_texts / sizes.get(0, 1))))
    # distinct ids, about fit_texts of each label whatever the input
    drawn = known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < share * (1 << 20))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL").join(F.broadcast(drawn), "id")
    # repeated ids meet map-side: one text of each leaves a task
    sample = texts.groupBy("id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, own in text_slices(batch, 2, _BATCH):
                found = text_features(own, buckets)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([f.astype(np.int32) for f, _ in found], pa.list_(pa.int32())), pa.array([s.astype(np.float32) for _, s in found], pa.list_(pa.float32()))], ["id", "label", "features", "shares"])
        give_back()

    rows = sample.mapInArrow(run, "id long, label int, features array<int>, shares array<float>").toArrow().combine_chunks()
    if not rows.num_rows:
        return None
    rows = rows.sort_by([("id", "ascending"), ("label", "ascending")])
    label = rows["label"].to_numpy()
    weight = np.array([sizes.get(c, 0) / max(1, (label == c).sum()) for c in (0, 1)])
    features, shares = (rows[c].combine_chunks() for c in ("features", "shares"))
    return _train(features.offsets.to_numpy(), features.values.to_numpy(), shares.values.to_numpy(), label, weight[label] / weight[label].mean(), buckets, dim, epochs, rate)


def _train(offsets: np.ndarray, features: np.ndarray, shares: np.ndarray, label: np.ndarray, weight: np.ndarray, buckets: int, dim: int, epochs: int, rate: float) -> QualityModel:
    """Stochastic gradient descent on the weighted log loss, one text at a time, with a
    rate that falls to zero. Vectors begin at zero: one that no text has trained says
    nothing."""
    random = np.random.default_rng(12)
    vectors = np.zeros((buckets, dim), np.float32)
    layer, bias = random.uniform(-1 / dim, 1 / dim, (2, dim)).astype(np.float32), np.zeros(2, np.float32)
    steps, step = epochs * len(label), 0
    for _ in range(epochs):
        for i in random.permutation(len(label)):
            own = slice(offsets[i], offsets[i + 1])
            at, share = features[own], shares[own]
            hidden = share @ vectors[at]
            z = layer @ hidden + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label[i]] -= 1
            p *= weight[i] * (1 - step / steps)
            back = layer.T @ p
            layer -= 0.1 * np.outer(p, hidden)
            bias -= 0.1 * p
            vectors[at] -= rate * share[:, None] * back
            step += 1
    return QualityModel(vectors, layer, bias)


def score(docs: DataFrame, model: QualityModel | None, text_col: str = "text", keep: list[str] | None = None, threshold: float = 0.3) -> DataFrame:
    """The columns of ``docs`` (or those in ``keep``), ``score`` (0 to 1, higher: label 1
    likelier) and ``predicted`` (1 if score >= ``threshold``). Every whole text is scored;
    null, empty and wordless texts get what the bias alone gives. Without a model every
    score is 1: nothing speaks against a text. Repeated rows are scored each."""
    spark = docs.sparkSession
    ship(spark)
    rows, carried, at, schema = text_input(docs, text_col, ["score", "predicted"], keep)
    if model is None:
        return rows.select(*[F.col(f"`{c}`") for c in carried], F.lit(1.0).alias("score"), F.lit(1).alias("predicted"))
    shared = spark.sparkContext.broadcast(model)  # a fixed size

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bias = shared.value.collapsed()
        for batch in batches:
            for part, texts in text_slices(batch, at, _BATCH):
                words, keys, place, own, _ = _split(texts)
                sums, sizes = np.zeros(len(own)), np.zeros(len(own), np.int64)
                for which, found in _word_features(own, keys, len(table)):
                    sums[which], sizes[which] = table[found].sum(1), found.shape[1]
                pair_text, pair = _pairs(words, len(table))
                n = len(texts)
                total = np.bincount(words.text_of, sums[place], n) + np.bincount(pair_text, table[pair], n)
                used = np.bincount(words.text_of, sizes[place], n) + np.bincount(pair_text, minlength=n)
                scores = 1 / (1 + np.exp(-np.clip(bias + total / np.maximum(used, 1), -40, 40)))
                yield pa.RecordBatch.from_arrays([*part.columns[: len(carried)], pa.array(scores), pa.array((scores >= threshold).astype(np.int32))], names=[*carried, "score", "predicted"])
        give_back()

    return rows.mapInArrow(run, f"{schema}, score double, predicted int")
