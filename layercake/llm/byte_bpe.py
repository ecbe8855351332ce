"""Byte-level BPE encoding and decoding with the ``tokenizers`` library.

A rank file lists byte strings; byte-level BPE in ``tokenizers`` works on characters, so
that each byte is mapped to one printable character, and back for decoding. Every match
of the pattern is encoded by itself, so that a task encodes each distinct match once. Offsets come
from the ids alone: the bytes of the ids, in order, are the bytes of the text, and a byte
belongs to the character whose UTF-8 sequence holds it. Several ids may share a character
that the vocabulary splits; each then spans the whole character.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layercake.llm.arrow_rows import give_back, text_input, text_slices
from layercake.llm.shipping import ship

#: Text characters encoded at a time within a task; distinct matches that it keeps.
BATCH_CHARS = 1 << 20
KEPT_MATCHES = 200_000


@lru_cache(1)
def byte_characters() -> tuple[str, ...]:
    """The printable character of each byte in byte-level BPE: itself where it is
    printable Latin-1, else the next free one from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(0x100, 0x200))
    return tuple(chr(b) if b in printable else chr(next(free)) for b in range(256))


def read_ranks(file: bytes) -> list[bytes]:
    """Byte strings by id from the content of a rank file."""
    pairs = (line.split() for line in file.splitlines() if line.strip())
    ranks = {int(rank): base64.b64decode(token) for token, rank in pairs}
    return [ranks[i] for i in range(len(ranks))]


@lru_cache(1)
def codec(file: bytes):
    """The tokenizer of single matches for a rank file, its decoding table and the bytes
    of each id; kept per worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer, models, pre_tokenizers

    tokens = read_ranks(file)
    known = set(tokens)
    letters = byte_characters()
    spelled = {t: "".join(letters[b] for b in t) for t in tokens}
    # any two parts that join to a token may merge, at the rank of that token
    merges = [(spelled[t[:i]], spelled[t[i:]]) for t in tokens for i in range(1, len(t)) if t[:i] in known and t[i:] in known]
    model = models.BPE(vocab={spelled[t]: i for i, t in enumerate(tokens)}, merges=merges)
    tokenizer = Tokenizer(model)
    tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    lengths = np.array([len(t) for t in tokens], np.int64)
    return tokenizer, tokens, lengths


class Encoder:
    """Ids of texts; ``kept``: ids of the matches seen so far, as 32-bit integers."""

    def __init__(self, file: bytes, pattern: str):
        self.tokenizer, self.tokens, self.lengths = codec(file)
        self.find = regex.compile(pattern).findall
        self.kept: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        matches = [self.find(t) for t in texts]
        distinct = set().union(*matches)
        new = list(distinct - self.kept.keys())
        if len(self.kept) + len(new) > KEPT_MATCHES:
            self.kept, new = {}, list(distinct)
        for match, found in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False), strict=True):
            self.kept[match] = np.array(found.ids, "<u4").tobytes()
        return [np.frombuffer(b"".join(map(self.kept.__getitem__, m)), "<u4") for m in matches]


def decode(ids: np.ndarray, tokens: list[bytes]) -> bytes:
    """The bytes of ``ids``; whole characters or not."""
    return b"".join([tokens[i] for i in ids.tolist()])


def character_spans(ids: np.ndarray, text: bytes, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end character of each id in the text."""
    ends = np.cumsum(lengths[ids])
    leads = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80
    character = np.cumsum(leads) - 1
    return character[ends - lengths[ids]], character[ends - 1] + 1


def encode_texts(docs: DataFrame, vocabulary: str, pattern: str, text_col: str = "text", offsets: bool = False, decoded: bool = False, keep: list[str] | None = None) -> DataFrame:
    """The columns of ``docs`` (or those in ``keep``) and the tokens of every whole text, each match of
    ``pattern`` by itself, without special tokens:

    * ``n_tokens`` (long) and ``ids`` (binary: little-endian unsigned 32-bit integers);
    * with ``offsets``: ``firsts`` and ``ends`` (binary, as ids): characters of each id;
    * with ``decoded``: ``decoded`` (binary), the bytes that the ids give back.

    A null text counts as empty: no tokens, empty binaries. Columns of ``docs`` with one
    of these names are replaced. An empty table gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    with open(vocabulary, "rb") as f:
        shared = spark.sparkContext.broadcast(f.read())  # a fixed vocabulary, about 1 MB
    new = ["n_tokens", "ids", *(["firsts", "ends"] if offsets else []), *(["decoded"] if decoded else [])]
    rows, carried, at, schema = text_input(docs, text_col, new, keep)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value, pattern)
        for batch in batches:
            for part, texts in text_slices(batch, at, BATCH_CHARS):
                ids = encoder.encode(texts)
                out = [pa.array([len(x) for x in ids], pa.int64()), pa.array([x.tobytes() for x in ids], pa.binary())]
                if offsets:
                    spans = [character_spans(x, t.encode(), encoder.lengths) for x, t in zip(ids, texts, strict=True)]
                    out += [pa.array([s[i].astype(np.uint32).tobytes() for s in spans], pa.binary()) for i in (0, 1)]
                if decoded:
                    out.append(pa.array([decode(x, encoder.tokens) for x in ids], pa.binary()))
                yield pa.RecordBatch.from_arrays([*part.columns[: len(carried)], *out], names=[*carried, *new])
        del encoder
        give_back()

    fields = [f"{c} {'long' if c == 'n_tokens' else 'binary'}" for c in new]
    return rows.mapInArrow(run, ", ".join([schema, *fields]))


def decode_texts(encoded: DataFrame, vocabulary: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``text``: the ids' bytes as UTF-8. A character whose bytes the ids
    do not hold whole (a cut sequence of ids) becomes U+FFFD; null ids give a null text."""
    spark = encoded.sparkSession
    ship(spark)
    with open(vocabulary, "rb") as f:
        shared = spark.sparkContext.broadcast(f.read())
    carried = [c for c in encoded.columns if c != "text"]
    rows = encoded.select(*[F.col(f"`{c}`") for c in carried], F.col(ids_col).alias("__ids"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = read_ranks(shared.value)
        for batch in batches:
            ids = batch.column(batch.num_columns - 1).to_pylist()
            texts = [None if x is None else decode(np.frombuffer(x, np.uint32), tokens).decode("utf-8", "replace") for x in ids]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names=[*carried, "text"])

    kinds = dict(encoded.dtypes)
    return rows.mapInArrow(run, ", ".join([f"`{c}` {kinds[c]}" for c in carried] + ["text string"]))
