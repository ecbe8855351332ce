"""Packed hash exchange: sorted 64-bit keys of whole chunks of texts, sent to hash
buckets as compressed blocks, and answers sent back per chunk.

Joining every word position of a corpus row by row would shuffle tens of bytes a
position. Here a chunk (a few MB of texts, one Arrow group) sorts and de-duplicates its
keys first, so that a hot key is sent once per chunk, and sends to every bucket (a range
of hash values) one block of delta-coded keys: 3 to 5 bytes a key. A bucket sorts the
blocks of all chunks, decides, and answers each chunk in the order of its keys.

Chunks and buckets grow with the input (``Layout``). A key is sent once per chunk that has
it, so a bucket that holds a hot key gets one key more from every chunk: its share grows
with the number of chunks, not with the key's frequency in them. Blocks get smaller as both
grow, but there is never an empty one: at the far end a block is one key, as in a plain
shuffle.
A chunk is a function of the row alone, so that a task that is run again, after an
executor is lost, sends the same blocks.
"""

from __future__ import annotations

import math
from collections.abc import Container, Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layercake.llm.arrow_rows import give_back

#: Text bytes of a chunk and of a bucket's keys; both bound the memory of a task.
CHUNK_BYTES = 3 << 20
BUCKET_BYTES = 6 << 20

BLOCKS = "bucket int, chunk long, block binary"
ANSWERS = "chunk long, bucket int, block binary"

_ZSTD = pa.Codec("zstd", 1)


@dataclass(frozen=True)
class Layout:
    """Chunks, buckets and bits of the shortened keys for an input."""

    chunks: int
    buckets: int
    short_bits: int


def layout_of(docs: DataFrame, text_col: str) -> Layout:
    """Sizes from the total bytes of text (one aggregate over the column)."""
    total = docs.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return Layout(
        chunks=max(tasks, math.ceil(total / CHUNK_BYTES)),
        buckets=max(tasks, math.ceil(total / BUCKET_BYTES)),
        # one in 2**16 keys meets another one by chance; such hits are verified later
        short_bits=min(64, 16 + max(24, math.ceil(math.log2(total / 4 + 2)))),
    )


def chunk_of(layout: Layout, *cols: str) -> Column:
    return F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.lit(layout.chunks)).cast("long")


def task_count(docs: DataFrame, layout: Layout) -> int:
    """Tasks for data dealt by chunk: at most about 16 chunks each."""
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), layout.chunks // 16)


def dealt(docs: DataFrame, layout: Layout, keys: list[str]) -> DataFrame:
    """``docs`` with a ``chunk`` column, dealt by it: the one shuffle of the texts, which
    the passes of an operator share."""
    return docs.withColumn("chunk", chunk_of(layout, *keys)).repartition(task_count(docs, layout), "chunk")


def short(keys: np.ndarray, bits: int) -> np.ndarray:
    """The upper ``bits`` of 64-bit keys."""
    return keys >> np.uint64(64 - bits)


# -- blocks ------------------------------------------------------------------------


def _planes(values: np.ndarray) -> bytes:
    """Little-endian byte planes: equal upper bytes lie together and compress away."""
    return np.ascontiguousarray(np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.dtype.itemsize).T).tobytes()


def pack(values: Iterable[np.ndarray], keys: np.ndarray | None = None) -> bytes:
    """One block: the number of values, then sorted ``keys`` (delta-coded) and ``values``."""
    values = list(values)
    n = len(keys) if keys is not None else len(values[0])
    parts = [] if keys is None else [_planes(np.diff(keys, prepend=np.uint64(0)))]
    body = b"".join(parts + [_planes(v) for v in values])
    return n.to_bytes(8, "little") + (_ZSTD.compress(body, asbytes=True) if n else b"")


def unpack(block: bytes, dtypes: Iterable[str], with_keys: bool = True, without: Container[int] = ()) -> list[np.ndarray]:
    """The arrays of ``pack``: keys first, if any, then one array per dtype, but for those
    numbered ``without``."""
    kinds = [np.dtype(d) for d in ([np.uint64] if with_keys else []) + list(dtypes)]
    n = int.from_bytes(block[:8], "little")
    skipped = [i - with_keys in without for i in range(len(kinds))]
    if not n:
        return [np.zeros(0, k) for k, skip in zip(kinds, skipped, strict=True) if not skip]
    body = np.frombuffer(_ZSTD.decompress(block[8:], n * sum(k.itemsize for k in kinds)), np.uint8)
    out, at = [], 0
    for k, skip in zip(kinds, skipped, strict=True):
        planes = body[at : at + n * k.itemsize].reshape(k.itemsize, n)
        if not skip:
            out.append(np.ascontiguousarray(planes.T).view(k).reshape(n))
        at += n * k.itemsize
    if with_keys:
        out[0] = np.cumsum(out[0], dtype=np.uint64)
    return out


@lru_cache(4)
def _bucket_firsts(bits: int, buckets: int) -> np.ndarray:
    return np.array([min(((b << bits) + buckets - 1) // buckets, (1 << bits) - 1) for b in range(buckets)], np.uint64)


def bucket_cuts(keys: np.ndarray, bits: int, buckets: int) -> np.ndarray:
    """Where each bucket's range of hash values begins in sorted ``keys``."""
    return np.append(np.searchsorted(keys, _bucket_firsts(bits, buckets)), len(keys))


def blocks_table(chunk: int, keys: np.ndarray, values: list[np.ndarray], bits: int, buckets: int, to_all: bool = False) -> pa.Table:
    """Rows of ``BLOCKS`` for a chunk's sorted keys: one for each bucket that it has keys
    of, so that there are never more blocks than keys, however many buckets there are.
    ``to_all``: empty blocks too, where every bucket has to answer every chunk."""
    cuts = bucket_cuts(keys, bits, buckets)
    give_back()
    used = np.arange(buckets) if to_all else np.flatnonzero(np.diff(cuts))
    blocks = [pack([v[a:b] for v in values], keys[a:b]) for a, b in zip(cuts[used], cuts[used + 1], strict=True)]
    return pa.table({"bucket": pa.array(used.astype(np.int32)), "chunk": pa.array(np.full(len(used), chunk, np.int64)), "block": pa.array(blocks, pa.binary())})


@dataclass
class Gathered:
    """The blocks of all chunks in one bucket, by key: ``order`` sorts the joined rows,
    ``group`` numbers the equal keys in that order, ``firsts`` begins each group."""

    chunks: list[int]
    sizes: list[int]
    keys: np.ndarray
    values: list[np.ndarray]
    order: np.ndarray
    group: np.ndarray
    firsts: np.ndarray

    def back(self, per_group: np.ndarray) -> Iterator[np.ndarray]:
        """A value per group, as one array per chunk in the order of its keys."""
        out = np.empty(len(self.keys), per_group.dtype)
        out[self.order] = per_group[self.group]
        yield from np.split(out, np.cumsum(self.sizes)[:-1]) if self.sizes else ()


def gather(table: pa.Table, dtypes: list[str]) -> Gathered:
    """Sort the blocks of one bucket together; ties keep the order of the chunks."""
    table = table.sort_by("chunk")
    chunks = table["chunk"].to_pylist()
    parts = [unpack(b.as_py(), dtypes) for b in table["block"]]
    joined = [np.concatenate([p[i] for p in parts]) for i in range(1 + len(dtypes))]
    keys = joined[0]
    order = np.argsort(keys, kind="stable")
    new = np.ones(len(keys), bool)
    ordered = keys[order]
    new[1:] = ordered[1:] != ordered[:-1]
    return Gathered(chunks, [len(p[0]) for p in parts], keys, joined[1:], order, np.cumsum(new) - 1, np.flatnonzero(new))


def answers_table(found: Gathered, bucket: int, blocks: Iterable[bytes]) -> pa.Table:
    blocks = list(blocks)
    give_back()
    return pa.table({"chunk": pa.array(found.chunks, pa.int64()), "bucket": pa.array(np.full(len(blocks), bucket, np.int32)), "block": pa.array(blocks, pa.binary())})


def answered(table: pa.Table, dtypes: list[str], without: Container[int] = ()) -> list[np.ndarray]:
    """The answers of all buckets to one chunk, in the order of its sorted keys: an array per
    dtype, but for those numbered ``without``."""
    table = table.sort_by("bucket")
    parts = [unpack(b.as_py(), dtypes, with_keys=False, without=without) for b in table["block"]]
    kept = [d for i, d in enumerate(dtypes) if i not in without]
    return [np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, d) for i, d in enumerate(kept)]
