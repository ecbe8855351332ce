"""Language ID with segmentation-marginalised unigrams.

A fixed public vocabulary of byte pieces; per language a probability for each piece. The
probability of a word is the sum over all its segmentations into pieces, computed with
the forward algorithm; a text's is the product over its words. The piece probabilities
are fitted by EM (forward-backward over word counts). A word is a run of letters (and
their marks) of any length, lower case, with a leading blank; every piece of the vocabulary
that can stand in a word counts, whatever its length, and every single byte is a piece, so
that every word has a segmentation. Sums over segmentations are rescaled as they get small,
so that a long word has a finite score.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layercake.llm.arrow_rows import give_back, text_input, text_slices
from layercake.llm.byte_bpe import read_ranks
from layercake.llm.shipping import ship
from layercake.llm.words import NOT_LETTERS, Words, find_words, text_buffer

#: Distinct words whose scores a worker keeps.
KEPT_WORDS = 400_000
#: Text bytes scored at a time.
_BATCH = 2 << 20
#: Bytes of words of one length whose segmentations are summed at a time.
_PART = 400_000
#: A sum below 2 ** -_SCALE is multiplied by 2 ** _SCALE. One byte makes a sum smaller by
#: far less than the rest of a double's range.
_SCALE = 600
_LETTER = regex.compile(r"\p{L}")
_BASE = np.uint64(0x9E3779B97F4A7C15)


class Pieces:
    """The pieces of a vocabulary that can occur in a word, found by the hashes of their
    beginnings."""

    def __init__(self, tokens: Iterable[bytes]):
        letters = {t for t in tokens if t == t.lower() and not NOT_LETTERS[np.frombuffer(t.removeprefix(b" "), np.uint8)].any()}
        letters |= {bytes([b]) for b in range(256)}
        self.pieces = sorted(letters - {b""})
        number = {p: i for i, p in enumerate(self.pieces)}
        longer = {p[:n] for p in self.pieces for n in range(1, len(p))}
        known = sorted((self._hash(p), number.get(p, -1), p in longer) for p in longer | number.keys())
        self.hashes = np.array([h for h, _, _ in known], np.uint64)
        self.number = np.array([i for _, i, _ in known], np.int64)
        self.begins = np.array([b for _, _, b in known], bool)
        self.longest = max(map(len, self.pieces))

    @staticmethod
    def _hash(piece: bytes) -> int:
        h = 0
        for b in piece:
            h = (h * int(_BASE) + b + 1) % 2**64
        return h

    def __len__(self) -> int:
        return len(self.pieces)

    def spans(self, words: np.ndarray) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
        """(start, end, rows, pieces) for all spans of a (words, bytes) matrix of words
        of one length at which some words have a piece."""
        out = []
        for start in range(words.shape[1]):
            rows, h = np.arange(len(words)), np.zeros(len(words), np.uint64)
            for end in range(start + 1, words.shape[1] + 1):
                h = h * _BASE + words[rows, end - 1] + np.uint64(1)
                at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
                known = self.hashes[at] == h
                whole = known & (self.number[at] >= 0)
                if whole.any():
                    out.append((start, end, rows[whole], self.number[at[whole]]))
                on = known & self.begins[at]  # only these begin a longer piece
                if not on.any():
                    break
                rows, h = rows[on], h[on]
        return out


def _sums(spans: Iterable, shape: tuple[int, int], chance: np.ndarray, longest: int, backward: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(bytes + 1, words, languages): sums over the segmentations of each beginning of the
    words (of each end, if ``backward``), and how often each was multiplied by 2 ** _SCALE."""
    n = shape[1]
    sums = np.zeros((n + 1, shape[0], chance.shape[1]))
    scales = np.zeros(sums.shape, np.int32)
    sums[n if backward else 0] = 1
    done = n + 1 if backward else -1
    for start, end, rows, found in spans:  # in the order of the sums that they extend
        source, target = (end, start) if backward else (start, end)
        if source != done:  # complete: no more spans end there
            done = source
            small = sums[source] < 2.0**-_SCALE
            if small.any():
                # whatever is begun lies within one piece's length, on one scale
                begun = slice(max(0, source - longest), source + 1) if backward else slice(source, source + longest + 1)
                sums[begun] = np.where(small, sums[begun] * 2.0**_SCALE, sums[begun])
                (scales[: source + 1] if backward else scales[source:])[:, small] += 1
        sums[target, rows] += sums[source, rows] * chance[found]
    return sums, scales


def forward(spans: list, shape: tuple[int, int], chance: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Probability of each beginning of the words, summed over its segmentations, and its
    scale (see ``_sums``). ``chance``: (pieces, languages)."""
    return _sums(spans, shape, chance, longest)


def log_chance(spans: list, shape: tuple[int, int], chance: np.ndarray, longest: int) -> np.ndarray:
    """(words, languages): log probability of each word."""
    alpha, scale = forward(spans, shape, chance, longest)
    return np.log(alpha[-1]) - scale[-1] * (_SCALE * np.log(2.0))


def expected(spans: list, shape: tuple[int, int], chance: np.ndarray, counts: np.ndarray, longest: int) -> np.ndarray:
    """Expected uses of each piece by language; ``counts``: (words, languages)."""
    alpha, a_scale = forward(spans, shape, chance, longest)
    beta, b_scale = _sums(sorted(spans, key=lambda s: -s[1]), shape, chance, longest, backward=True)
    weight = counts / alpha[-1]
    uses = np.zeros_like(chance)
    for start, end, rows, found in spans:
        share = alpha[start, rows] * chance[found] * weight[rows]
        power = a_scale[-1][rows] - a_scale[start, rows] - b_scale[end, rows]
        np.add.at(uses, found, np.ldexp(share * beta[end, rows], power * _SCALE) if power.any() else share * beta[end, rows])
    return uses


def by_length(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(indices, byte matrix) of the words of each length, in parts of bounded size."""
    lengths = np.array([len(w) for w in words], np.int64)
    for n in np.unique(lengths):
        same = np.flatnonzero(lengths == n)
        for part in np.array_split(same, -(-len(same) * int(n) // _PART)):
            yield part, np.frombuffer(b"".join([words[i] for i in part]), np.uint8).reshape(len(part), n)


@dataclass
class LanguageModel:
    """``chance``: (pieces, languages); ``prior``: log share of each language."""

    languages: list[str]
    pieces: Pieces
    chance: np.ndarray
    prior: np.ndarray

    def word_scores(self, words: list[bytes]) -> np.ndarray:
        """Log probability of each word by language."""
        scores = np.zeros((len(words), len(self.languages)))
        for rows, matrix in by_length(words):
            scores[rows] = log_chance(self.pieces.spans(matrix), matrix.shape, self.chance, self.pieces.longest)
        return scores


def _only_letters(text: str) -> str:
    """The text in lower case; beyond ASCII, characters that are no letters or marks are
    blanks."""
    text = text.lower()
    if text.isascii():
        return text
    others = {ord(c): " " for c in set(text) if not c.isascii() and unicodedata.category(c)[0] not in "LM"}
    return text.translate(others) if others else text


def _letters(texts: list[str]) -> tuple[np.ndarray, Words]:
    buffer, offsets = text_buffer(pa.array([_only_letters(t) for t in texts], pa.large_string()))
    return buffer, find_words(buffer, offsets, separators=NOT_LETTERS)


def _word_bytes(buffer: np.ndarray, words: Words, which: np.ndarray) -> list[bytes]:
    raw = buffer.tobytes()
    return [b" " + raw[a:b] for a, b in zip(words.starts[which].tolist(), words.ends[which].tolist(), strict=True)]


def fit(docs: DataFrame, vocabulary: str, text_col: str = "text", lang_col: str = "lang", fit_texts: int = 1500, rounds: int = 3) -> LanguageModel | None:
    """Fit on the rows of ``docs`` with a text and a language. Of each language about
    ``fit_texts`` texts are used (all, if it has fewer), chosen by the text's hash.
    Returns None if nothing can be learned."""
    spark = docs.sparkSession
    ship(spark)
    with open(vocabulary, "rb") as f:
        pieces = Pieces(read_ranks(f.read()))
    known = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).cast("string").alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return None
    languages = sorted(sizes)
    share = F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, fit_texts / sizes[lang]))])
    draw = F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < F.element_at(share, F.col("lang")) * (1 << 20)
    sample = known.where(draw)

    def count_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang in pc.unique(batch.column(0)).to_pylist():
                own = batch.filter(pc.equal(batch.column(0), lang))
                for _, texts in text_slices(own, 1, _BATCH):
                    buffer, words = _letters(texts)
                    _, at, n = np.unique(words.hashes, return_index=True, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(_word_bytes(buffer, words, at), pa.binary()), pa.array(n, pa.int64())], ["lang", "word", "n"])

    counted = sample.mapInArrow(count_words, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    words = counted.persist()
    place = {lang: i for i, lang in enumerate(languages)}
    chance = np.full((len(pieces), len(languages)), 1.0 / len(pieces))
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast((pieces, chance))  # pieces x languages: a fixed size

        def uses_of(batches: Iterable[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own, chance = shared.value
            uses = np.zeros_like(chance)
            for batch in batches:
                langs = [place[x] for x in batch.column(0).to_pylist()]
                parts = list(zip(batch.column(1).to_pylist(), langs, batch.column(2).to_pylist(), strict=True))
                for lang in set(langs):
                    column = chance[:, [lang]]
                    mine = [(p, n) for p, at, n in parts if at == lang]
                    n = np.array([c for _, c in mine], float)
                    for rows, matrix in by_length([p for p, _ in mine]):
                        uses[:, [lang]] += expected(own.spans(matrix), matrix.shape, column, n[rows][:, None], own.longest)
            piece, lang = np.nonzero(uses)
            yield pa.RecordBatch.from_arrays([pa.array(piece, pa.int64()), pa.array(lang, pa.int64()), pa.array(uses[piece, lang])], ["piece", "lang", "uses"])

        total = words.mapInArrow(uses_of, "piece long, lang long, uses double").groupBy("piece", "lang").agg(F.sum("uses").alias("uses")).toPandas()
        uses = np.full(chance.shape, 0.01)
        uses[total["piece"], total["lang"]] += total["uses"]
        chance = uses / uses.sum(0)
    words.unpersist()
    n = np.array([sizes[lang] for lang in languages], float)
    return LanguageModel(languages, pieces, chance, np.log(n / n.sum()))


def predict(docs: DataFrame, model: LanguageModel | None, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns of ``docs`` (or those in ``keep``), ``lang_pred`` (``und`` for a text that is null or has no
    letter, or without a model) and ``score``: the probability of that language among
    the learned ones (0 for ``und``). Every whole text is scored."""
    spark = docs.sparkSession
    ship(spark)
    rows, carried, at, schema = text_input(docs, text_col, ["lang_pred", "score"], keep)
    if model is None:
        return rows.select(*[F.col(f"`{c}`") for c in carried], F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = spark.sparkContext.broadcast(model)  # pieces x languages: a fixed size

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        kept = np.zeros(0, np.uint64)
        table = np.zeros((0, len(model.languages)))
        for batch in batches:
            for part, texts in text_slices(batch, at, _BATCH):
                buffer, words = _letters(texts)
                keys, first, place = np.unique(words.hashes, return_index=True, return_inverse=True)
                new = np.isin(keys, kept, assume_unique=True, invert=True)
                if len(kept) + new.sum() > KEPT_WORDS:
                    kept, table, new = kept[:0], table[:0], np.ones(len(keys), bool)
                scores = model.word_scores(_word_bytes(buffer, words, first[new]))
                kept, table = np.concatenate([kept, keys[new]]), np.concatenate([table, scores])
                order = np.argsort(kept)
                kept, table = kept[order], table[order]
                each = table[np.searchsorted(kept, keys)][place]
                total = np.tile(model.prior, (len(texts), 1))
                worded = np.flatnonzero(words.counts)
                if len(worded):  # one sum per text
                    total[worded] += np.add.reduceat(each, words.bounds[worded])
                best = total.argmax(1)
                score = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
                letters = [_LETTER.search(t) is not None for t in texts]
                named = [model.languages[b] if has else "und" for b, has in zip(best, letters, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(carried)], pa.array(named, pa.string()), pa.array(np.where(letters, score, 0.0))], names=[*carried, "lang_pred", "score"])
        give_back()

    return rows.mapInArrow(run, f"{schema}, lang_pred string, score double")
