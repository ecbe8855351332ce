"""Words of whole texts as numpy arrays: positions, 64-bit hashes, n-gram hashes.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D of the UTF-8 text,
i.e. ``[^\\x20\\x09-\\x0D]+``. These helpers run inside Arrow tasks; Spark partitions
and shuffles the rows around them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[9, 10, 11, 12, 13, 32]] = True

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
_FOLDED = _BYTE.copy()
_FOLDED[65:91] = _BYTE[97:123]
#: Odd multiplier of each position of a window.
_PLACE = _RNG.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)

_BASE = 0x9E3779B97F4A7C15
#: Text is hashed in pieces of about this many bytes, cut between words.
_PIECE = 1 << 20
_powers: tuple[np.ndarray, np.ndarray] | None = None


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every bit depends on every bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n, kept per worker."""
    global _powers
    if _powers is None or len(_powers[0]) < n:
        size = max(n, _PIECE)
        tables = []
        for base in (_BASE, pow(_BASE, -1, 2**64)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            tables.append(np.multiply.accumulate(table))
        _powers = (tables[0], tables[1])
    return _powers


@dataclass
class Words:
    """Words of a batch of texts. ``starts``/``ends``: byte positions in the joined
    buffer; ``bounds``: first word of each text (and the total); ``hashes``: one per word."""

    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    hashes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    @property
    def text_of(self) -> np.ndarray:
        """Index of the text of each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)


def text_buffer(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts one after another and their offsets; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
        if isinstance(texts, pa.ChunkedArray):
            texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.large_binary())
    texts = texts.cast(pa.large_string()) if pa.types.is_string(texts.type) else texts
    texts = texts.fill_null(b"" if pa.types.is_large_binary(texts.type) else "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = texts.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


#: Every ASCII byte but letters: separators where words are runs of letters.
NOT_LETTERS = np.zeros(256, bool)
NOT_LETTERS[:128] = True
NOT_LETTERS[65:91] = NOT_LETTERS[97:123] = False


def find_words(buffer: np.ndarray, offsets: np.ndarray, fold_case: bool = False, separators: np.ndarray = _SEPARATOR) -> Words:
    """Words of every text; ``fold_case`` hashes A-Z as a-z; ``separators`` marks the
    bytes between words."""
    solid = ~separators[buffer]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    opening = offsets[:-1][offsets[:-1] < len(buffer)]
    first[opening] = solid[opening]
    closing = offsets[1:][offsets[1:] > 0] - 1
    last[closing] = solid[closing]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return Words(starts, ends, np.searchsorted(starts, offsets), _hash_spans(buffer, starts, ends, _FOLDED if fold_case else _BYTE))


def _hash_spans(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray) -> np.ndarray:
    hashes = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + _PIECE, side="right")))
        low, high = int(starts[i]), int(ends[j - 1])
        powers, inverse = _power_tables(high - low)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(table[buffer[low:high]] * powers[: high - low], out=sums[1:])
        at = starts[i:j] - low
        hashes[i:j] = (sums[ends[i:j] - low] - sums[at]) * inverse[at]
        i = j
    return mix(hashes + (ends - starts).astype(np.uint64) * np.uint64(_BASE))


def place_factor(j: int) -> np.uint64:
    return _PLACE[j % len(_PLACE)] * np.uint64(2 * (j // len(_PLACE)) + 1)


def window_hashes(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the ``k`` words from each window start, and the start's word index.
    Windows do not leave their text."""
    n = len(words.hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total += words.hashes[j : j + n] * place_factor(j)
    text_of = words.text_of
    at = np.flatnonzero(text_of[:n] == text_of[k - 1 :])
    return mix(total[at] + np.uint64(k)), at
