"""Helpers of operators that map Arrow batches of texts."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def text_input(docs: DataFrame, text_col: str, new: list[str], keep: list[str] | None) -> tuple[DataFrame, list[str], int, str]:
    """Input of an Arrow function: the frame, the names of the columns that it carries
    (``keep``, by default all; none named like a ``new`` one), the place of the text in a
    batch, and the carried columns' schema. A text is passed once."""
    kinds = dict(docs.dtypes)
    names = [c for c in (docs.columns if keep is None else keep) if c not in new]
    columns = [F.col(f"`{c}`") for c in names]
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in names)
    if text_col in names and kinds[text_col] == "string":
        return docs.select(*columns), names, names.index(text_col), schema
    return docs.select(*columns, F.col(f"`{text_col}`").cast("string").alias("__text")), names, len(names), schema


def text_slices(batch: pa.RecordBatch, at: int, chars: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Parts of a batch with about ``chars`` characters of text, and their texts; null is
    empty. A text is never cut."""
    texts, first, size = [], 0, 0
    for value in batch.column(at):
        texts.append(value.as_py() or "")
        size += len(texts[-1])
        if size >= chars:
            yield batch.slice(first, len(texts)), texts
            first, texts, size = first + len(texts), [], 0
    if texts:
        yield batch.slice(first, len(texts)), texts


@lru_cache(1)
def _libc():
    try:
        return ctypes.CDLL("libc.so.6")
    except OSError:
        return None


def give_back() -> None:
    """Return freed memory to the system. Python workers live on after a task, and two
    of them share an executor's memory with its JVM."""
    pa.default_memory_pool().release_unused()
    if _libc() is not None and hasattr(_libc(), "malloc_trim"):
        _libc().malloc_trim(0)
